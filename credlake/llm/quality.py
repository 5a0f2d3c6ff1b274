r"""Quality rules: text measures, and line frequency across the documents of a host.

Every line is normalised (A-Z lower-cased, runs of white space made one
space) and hashed.  Per host, the distinct documents of a line are counted; a
line in at least ``min_docs`` documents and in ``max_share`` of the host's
documents is above the limit.  Such lines are removed, and a document that
keeps less than ``min_kept`` of its words is depleted.

What counts as one document is ``unit``.  ``"texts"``: distinct whole texts,
so exact copies do not make a text look like boilerplate, while pages that
share most of their lines and differ in a word do.  ``"classes"``: classes of
near-duplicates, the SimHash components of ``simhash`` (3-word shingles, at
most 3 differing bits) over all documents, for a filter that runs before
near-dedup: copies and the near copies that near-dedup would thin out to one
are one document; pages that it would leave side by side are counted one by
one, however much boilerplate they share.

Words are runs of other characters than ASCII white space.  Defined results:
null and empty texts have no words (base rule failed); a null host is a host
of its own; a text without line breaks is one line; repeated rows are judged
alike; other columns pass through, and an output column replaces an input
column of its name.  Very long texts are measured whole in one task's memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlake.llm.common import fresh, ship, stored, utf8
from credlake.llm.simhash import fingerprint_of, print_classes

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
NOT_STARTS = bytes(range(0x80, 0xC0)) + SPACE
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WINDOW = 8
MIX = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(WINDOW)], np.uint64)
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in an 8-word window found twice or more, the first included.

    Windows with a hash of their own are unique; only the others are compared word by word.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        mixed += h[i:i + n] * MIX[i]
    order = np.argsort(mixed, kind="stable")
    twin = mixed[order[1:]] == mixed[order[:-1]]
    if not twin.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][twin]] = True
    hit[order[:-1][twin]] = True
    first, edge = {}, np.zeros(len(words) + 1, np.int64)
    for i in np.flatnonzero(hit).tolist():
        j = first.setdefault(tuple(words[i:i + WINDOW]), i)
        if j != i:
            for start in (j, i):
                edge[start] += 1
                edge[start + WINDOW] -= 1
    return int((np.cumsum(edge) > 0).sum())


def line_hash(line: bytes) -> int | None:
    """The hash of a line as a signed 64-bit number; None for a line without words."""
    from xxhash import xxh3_64_intdigest
    words = line.translate(LOWER).split()
    return xxh3_64_intdigest(b" ".join(words)) - (1 << 63) if words else None


def measure(text: bytes) -> tuple[list[int], list[tuple[int, int]]]:
    """The five measures, and (hash, words) of every distinct normalised line."""
    words = text.split()
    lines: dict[int, int] = {}
    seen, dup = set(), 0
    for line in text.split(b"\n"):
        h = line_hash(line)
        if h is None:
            continue
        dup += line in seen
        seen.add(line)
        lines[h] = lines.get(h, 0) + len(line.split())
    found = [len(words), len(text.translate(None, NOT_STARTS)), len(text) - len(text.translate(None, SYMBOLS)), dup,
             repeated_words(words)]
    return found, list(lines.items())


LINES = pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int64())]))


def measures(text: Column, unit: str = "classes") -> Column:
    """Struct of the measures, ``fp`` (what copies share: the SimHash fingerprint, or a hash of the text) and ``lines``, an array of (hash, words)."""
    from xxhash import xxh3_64_intdigest
    if unit not in ("texts", "classes"):
        raise ValueError(f"unknown unit {unit!r}")
    mark = fingerprint_of if unit == "classes" else xxh3_64_intdigest
    ship()
    kind = ", ".join(f"{m}: bigint" for m in MEASURES)

    @F.arrow_udf(f"struct<{kind}, fp: bigint, lines: array<struct<hash: bigint, words: bigint>>>")
    def run(texts: pa.Array) -> pa.Array:
        rows, prints, ends, hashes, sizes = [], [], [0], [], []
        for t in texts:
            found, lines = measure(t.as_py())
            rows.append(found)
            prints.append(mark(t.as_py()))
            hashes += [h for h, _ in lines]
            sizes += [n for _, n in lines]
            ends.append(len(hashes))
        grid = np.array(rows, np.int64).reshape(-1, len(MEASURES))
        pairs = pa.StructArray.from_arrays([pa.array(hashes, pa.int64()), pa.array(sizes, pa.int64())], ["hash", "words"])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
        fp = pa.array(np.array(prints, np.uint64).view(np.int64))
        return pa.StructArray.from_arrays([*(pa.array(grid[:, i]) for i in range(len(MEASURES))), fp, lists], [*MEASURES, "fp", "lines"])
    return run(utf8(text))


def frequent_lines(rows: DataFrame, min_docs: int, max_share: float, unit: str = "classes") -> DataFrame:
    """(host, hash, docs) of the lines above the limit, from (host, fp, lines) per document.

    Copies shrink to one row per line before their class is looked up.
    """
    full = rows.where(F.size("lines") > 0)
    lines = full.select("host", "fp", F.explode("lines.hash").alias("hash")).distinct()
    pages = full.select("host", "fp").distinct()
    if unit == "classes":
        classes = stored(print_classes(full.select("fp").distinct()), "print-classes")
        lines = lines.join(classes, "fp").select("host", "hash", "class").distinct()
        pages = pages.join(classes, "fp").select("host", "class").distinct()
    counts = lines.groupBy("host", "hash").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    hosts = pages.groupBy("host").agg(F.count("*").alias("of"))
    return counts.join(hosts, "host").where(F.col("docs") >= F.lit(max_share) * F.col("of")).select("host", "hash", "docs")


def judge(df: DataFrame, host: str = "source", text: str = "text", carry: list[str] | None = None, min_docs: int = 10,
          max_share: float = 0.02, min_kept: float = 0.5, min_words: int = 20, max_repeat_pct: int = 30,
          unit: str = "classes") -> DataFrame:
    """The ``carry`` columns (all by default), the measures, ``removed_words``, ``removed_lines`` (hashes, null if none),
    ``base_failed`` and ``kept`` for every row.

    Measured rows are written to the shared folder once; what is shuffled
    after that are the fingerprints' postings and a hash per line, then the
    lines above the limit only.
    """
    carry = [c for c in (df.columns if carry is None else carry) if c not in (*MEASURES, "removed_words", "removed_lines", "base_failed", "kept")]
    row, at, found = fresh(df, "row"), fresh(df, "host_key"), fresh(df, "found")
    rows = stored(df.select(*carry, F.coalesce(F.col(host).cast("string"), F.lit("")).alias(at), measures(F.col(text), unit).alias(found))
                  .withColumn(row, F.monotonically_increasing_id()), "measured")
    narrow = rows.select(row, F.col(at).alias("host"), F.col(f"{found}.fp").alias("fp"), F.col(f"{found}.lines").alias("lines"))
    limits = frequent_lines(narrow, min_docs, max_share, unit)
    hits = (narrow.select(row, "host", F.inline("lines")).join(limits, ["host", "hash"])
            .groupBy(row).agg(F.sum("words").alias("removed_words"), F.collect_list("hash").alias("removed_lines")))
    hits = stored(hits, "removed")
    n, removed = F.col(f"{found}.n_words"), F.coalesce("removed_words", F.lit(0))
    failed = (n < min_words) | (100 * F.col(f"{found}.n_repeat_words") > max_repeat_pct * n)
    return (rows.join(hits, row, "left")
            .select(*carry, *(F.col(f"{found}.{m}").alias(m) for m in MEASURES), removed.cast("long").alias("removed_words"), "removed_lines",
                    failed.alias("base_failed"), (~failed & ((n - removed) >= F.lit(min_kept) * n)).alias("kept")))


def without_lines(text: Column, removed: Column) -> Column:
    """The text less the lines whose hash is in ``removed`` (array of long); unchanged where that is null."""
    ship()

    @F.arrow_udf("string")
    def run(texts: pa.Array, hashes: pa.Array) -> pa.Array:
        out = []
        for t, gone in zip(texts, hashes):
            drop = set(gone.as_py())
            out.append(b"\n".join(x for x in t.as_py().split(b"\n") if line_hash(x) not in drop).decode())
        return pa.array(out, pa.string())
    return F.when(removed.isNull(), text).otherwise(run(utf8(text), F.coalesce(removed, F.array().cast("array<bigint>"))))


def clean(df: DataFrame, host: str = "source", text: str = "text", **limits) -> DataFrame:
    """The kept rows of ``df`` with their frequent lines removed, same columns."""
    kept = judge(df, host, text, **limits).where("kept")
    return kept.withColumn(text, without_lines(F.col(text), F.col("removed_lines"))).select(df.columns)
