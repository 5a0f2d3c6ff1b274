r"""Benchmark decontamination by winnowing.

Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII
characters.  Of every 7 consecutive 7-word hashes the smallest is a
fingerprint, so any shared span of 13 words has a fingerprint in common.  A
document's fingerprints are joined with the benchmark's; where they meet, the
13-word windows around are compared word by word and the hits extended to all
the words they cover.  An item of fewer than 13 words is one window of its
own length, with the hash of the whole as its fingerprint.

The benchmark is the stated query set.  While its texts, counted first, are at
most ``BLOCK_BYTES``, the tasks hold its fingerprints and windows, and the
documents take one pass without any shuffle.  A larger one is joined by
shuffles: the documents' distinct fingerprints with the benchmark's, then the
windows at those that met, as their words, with the benchmark's windows.  The
documents are read twice whatever the benchmark's size, a fingerprint or window
goes once per document, and Spark splits the skewed ones.  Long items are cut
into overlapping pieces first.

Defined results: null and empty texts have no words and are not contaminated;
items without words never occur; items of one id are one item, and a null id
reads ``null``; an empty benchmark hits nothing.  Repeated documents get
equal results.  Other columns pass through; output columns replace input
columns of their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlake.llm.common import fresh, ship, stored, utf8

SPAN, GRAM = 13, 7
GUARD = SPAN - GRAM + 1  # hashes per window
PIECE = 4096  # words of an item held together
BLOCK_BYTES = 4 << 20
MIX = np.array([pow(0xD6E8FEB86659FD93, 2 * i + 1, 1 << 64) for i in range(SPAN)], np.uint64)
TO_WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


def grams(ids: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive ids (uint64); the greatest value where an id is 0, as no item holds such a word."""
    n = len(ids) - k + 1
    if n < 1:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    known = np.ones(n, bool)
    for i in range(k):
        h += ids[i:i + n] * MIX[i]
        known &= ids[i:i + n] != 0
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h[~known] = np.uint64(0xFFFFFFFFFFFFFFFF)
    return h


def winnow(ids: np.ndarray) -> np.ndarray:
    """For every 13-word window the fingerprint that stands for it: the least of its 7-word hashes."""
    h = grams(ids, GRAM)
    n = len(h) - GUARD + 1
    if n < 1:
        return np.empty(0, np.uint64)
    pairs = np.minimum(h[:-1], h[1:])
    fours = np.minimum(pairs[:-2], pairs[2:])
    return np.minimum(fours[:n], fours[3:3 + n])


class Index:
    """Fingerprints and windows of a block of the benchmark: (item id, words) pieces."""

    def __init__(self, pieces: list[tuple[str, list[bytes]]]):
        self.vocab: dict[bytes, int] = {}
        self.windows: dict[int, dict[bytes, set[str]]] = {}
        marks: dict[int, set[int]] = {}
        for item, words in pieces:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words], np.uint64)
            size = min(SPAN, len(words))
            here = self.windows.setdefault(size, {})
            for i in range(len(words) - size + 1):
                here.setdefault(ids[i:i + size].tobytes(), set()).add(item)
            marks.setdefault(size, set()).update((winnow(ids) if size == SPAN else grams(ids, size)).tolist())
        self.marks = {size: np.array(sorted(m), np.uint64) for size, m in marks.items()}

    def find(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """(words of the text, hit spans [start, end) in words, item ids)."""
        words = words_of(text)
        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.uint64, len(words))
        spans, items = [], set()
        for size, marks in self.marks.items():
            prints = winnow(ids) if size == SPAN else grams(ids, size)
            if not len(prints):
                continue
            runs = np.concatenate(([0], np.flatnonzero(prints[1:] != prints[:-1]) + 1))
            at = np.minimum(np.searchsorted(marks, prints[runs]), len(marks) - 1)
            met = (marks[at] == prints[runs]) & (prints[runs] != np.uint64(0xFFFFFFFFFFFFFFFF))
            ends = np.append(runs[1:], len(prints))
            known = self.windows[size]
            for a, b in zip(runs[met].tolist(), ends[met].tolist()):
                for i in range(a, b):
                    if (of := known.get(ids[i:i + size].tobytes())) is not None:
                        items |= of
                        spans.append((i, i + size))
        return len(words), merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def pieces_of(item: str, text: bytes) -> list[tuple[str, list[bytes]]]:
    """Overlapping pieces that together hold every window of the item."""
    words = words_of(text)
    return [(item, words[i:i + PIECE + SPAN - 1]) for i in range(0, max(1, len(words) - SPAN + 1), PIECE)] if words else []


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
FOUND = "struct<n_words: bigint, spans: array<struct<start: int, stop: int>>, items: array<string>>"


def finder(index) -> Callable:
    """A column function over texts for a broadcast ``Index``'s pieces."""
    ship()

    @F.arrow_udf(FOUND)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = Index(index.value)
        for texts in batches:
            rows = []
            for t in texts:
                n, spans, items = block.find(t.as_py())
                rows.append({"n_words": n, "spans": [{"start": a, "stop": b} for a, b in spans], "items": sorted(items)})
            yield pa.array(rows, pa.struct([("n_words", pa.int64()), ("spans", SPANS), ("items", pa.list_(pa.string()))]))
    return run


def pieces_table(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """The benchmark as stored pieces: item id, words."""
    ship()
    body = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), utf8(F.col(text)).alias("body")).distinct()

    def cut(batches):
        for batch in batches:
            found = [(i, b" ".join(w)) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for i, w in pieces_of(i, t)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.string()), pa.array([w for _, w in found], pa.binary())], ["item", "words"])

    return stored(body.mapInArrow(cut, "item string, words binary"), "pieces")


def word_ids(words: list[bytes]) -> np.ndarray:
    """Ids that every task gives alike: 64-bit hashes, never 0."""
    return np.fromiter((xxhash.xxh64_intdigest(w) or 1 for w in words), np.uint64, len(words))


def prints_of(ids: np.ndarray, size: int) -> np.ndarray:
    """The fingerprint of every window of ``size`` words."""
    return winnow(ids) if size == SPAN else grams(ids, size)


def windows_of(pieces: DataFrame) -> DataFrame:
    """The benchmark's distinct windows: size, mark, window (its words), items."""
    def cut(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text.split()
                size = min(SPAN, len(words))
                marks = prints_of(word_ids(words), size).view(np.int64).tolist()
                rows += [{"item": item, "size": size, "mark": m, "window": b" ".join(words[i:i + size])} for i, m in enumerate(marks)]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("item", pa.string()), ("size", pa.int32()), ("mark", pa.int64()), ("window", pa.binary())]))

    found = pieces.mapInArrow(cut, "item string, size int, mark bigint, window binary")
    return stored(found.groupBy("size", "mark", "window").agg(F.collect_set("item").alias("items")), "windows")


def joined_hits(rows: DataFrame, row: str, body: str, pieces: DataFrame) -> DataFrame:
    """Spans and item lists per row of the texts ``body``, by joins with the benchmark's fingerprints and windows."""
    windows = windows_of(pieces)
    sizes = [r[0] for r in windows.select("size").distinct().collect()]  # at most SPAN

    def marks(batches):
        for batch in batches:
            for at, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = word_ids(words_of(text))
                for size in sizes:
                    found = np.unique(prints_of(ids, size)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), at), pa.int64()), pa.array(np.full(len(found), size), pa.int32()),
                                                      pa.array(found)], ["row", "size", "mark"])

    def spans(batches):
        for batch in batches:
            for at, text, met in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = words_of(text)
                ids = word_ids(words)
                places: dict[bytes, list[int]] = {}
                for size in {m["size"] for m in met}:
                    hit = np.isin(prints_of(ids, size).view(np.int64), [m["mark"] for m in met if m["size"] == size])
                    for i in np.flatnonzero(hit).tolist():
                        places.setdefault(b" ".join(words[i:i + size]), []).append(i)
                size_of = [w.count(b" ") + 1 for w in places]
                found = [[{"start": i, "stop": i + n} for i in at_] for n, at_ in zip(size_of, places.values())]
                yield pa.RecordBatch.from_arrays([pa.array([at] * len(found), pa.int64()), pa.array(list(places), pa.binary()), pa.array(found, SPANS)],
                                                 ["row", "window", "spans"])

    texts = rows.select(F.col(row).alias("row"), F.col(body).alias("body"))
    known = windows.select("size", "mark").distinct()
    met = texts.mapInArrow(marks, "row bigint, size int, mark bigint").join(known, ["size", "mark"], "left_semi")
    held = met.groupBy("row").agg(F.collect_list(F.struct("size", "mark")).alias("met"))
    near = texts.join(held, "row").mapInArrow(spans, "row bigint, window binary, spans array<struct<start: int, stop: int>>")
    return stored(near.join(windows.select("window", "items"), "window").select(F.col("row").alias(row), "spans", "items"), "hits")


RESULT = ("n_words", "spans", "items", "n_hit", "contaminated")


def find(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``df`` with ``n_words``, ``spans`` (hit word spans), ``items`` (ids that occur), ``n_hit`` and ``contaminated``."""
    pieces = pieces_table(benchmark, item, item_text)
    size = pieces.agg(F.sum(F.octet_length("words") + 1)).first()[0] or 0
    context = df.sparkSession.sparkContext
    taken = [c for c in df.columns if c.lower() not in RESULT]
    found = fresh(df, "found")
    if size <= block_bytes:
        held = context.broadcast([(r["item"], bytes(r["words"]).split()) for r in pieces.collect()])
        out = df.withColumn(found, finder(held)(utf8(F.col(text))))
    else:
        # Columns that the result replaces go before the join, under names that no other column has.
        row, body, words, spans, items = (fresh(df, c) for c in ("row", "body", "words", "hit_spans", "hit_items"))
        rows = stored(df.select(*taken, utf8(F.col(text)).alias(body)).withColumn(row, F.monotonically_increasing_id()), "rows")
        hits = joined_hits(rows, row, body, pieces).groupBy(row).agg(
            F.flatten(F.collect_list("spans")).alias(spans), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias(items))
        union = merger()
        none = context.broadcast([])
        out = (rows.withColumn(words, finder(none)(F.col(body))["n_words"]).join(hits, row, "left")
               .withColumn(found, F.struct(F.col(words).alias("n_words"), union(F.coalesce(spans, F.from_json(F.lit("[]"), "array<struct<start:int,stop:int>>"))).alias("spans"),
                                           F.coalesce(items, F.array().cast("array<string>")).alias("items"))))
    f = F.col(found)
    out = out.select(*taken, f["n_words"].alias("n_words"), f["spans"].alias("spans"), f["items"].alias("items"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"]).cast("long"))
    return out.withColumn("n_hit", hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def merger() -> Callable:
    @F.arrow_udf("array<struct<start: int, stop: int>>")
    def run(spans: pa.Array) -> pa.Array:
        rows = [[{"start": a, "stop": b} for a, b in merged([(s["start"], s["stop"]) for s in r])] for r in spans.to_pylist()]
        return pa.array(rows, SPANS)
    return run


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """The rows of ``df`` that are not contaminated, same columns."""
    held = {c: fresh(df, f"own_{c}") for c in df.columns if c.lower() in RESULT}
    mark = find(df.withColumnsRenamed(held), benchmark, held.get(text, text), **names)
    return mark.where(~F.col("contaminated")).select([F.col(held.get(c, c)).alias(c) for c in df.columns])
