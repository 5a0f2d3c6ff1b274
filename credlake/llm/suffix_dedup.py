r"""Exact-substring deduplication by blockwise suffix sorting with a difference cover.

Every byte is removed that a ``LENGTH``-byte string covers which also starts
earlier: in a document before this one, or earlier in this one.  Documents
are ordered by key and packed into blocks (see ``blocks``).

1. Whole copies of an earlier document are found by SHA-256; they go, and sit
   out what follows.
2. Cover sample.  Positions whose residue modulo ``PERIOD`` is in ``COVER``
   are sampled.  Every difference of two residues is one of two members of
   ``COVER``, so two equal strings of ``LENGTH`` bytes, wherever they start,
   have an offset below ``PERIOD`` at which both are sampled, and there
   ``SAMPLE`` equal bytes begin.  The sample suffixes are ranked to that depth,
   one bucket at a time, and the ranks that occur twice are the ties.
3. Suffixes.  A suffix without a tied sample in its first ``PERIOD`` bytes is
   unique to the depth that matters: the ranks settle it.  The others are dealt
   to buckets by the least hash of the ``SAMPLE``-byte strings in them, which
   neighbours share, so they travel as stretches of text (some thirty suffixes
   in little more than ``LENGTH`` bytes) and a bucket holds their bytes.  It
   sorts its suffixes by a 64-bit name, compares the bytes of neighbours of one
   name, and marks every suffix that is not the first of its equals; suffixes
   of one name and other bytes are told apart by their bytes.
4. The marked strings' bytes are cut out of every document.

A block sends equal stretches once, at their first place, whatever their count;
the buckets see blocks and places in document order, so the first of equals is
the first in the corpus.  What a bucket holds is planned from the text's size.

Suffixes are not put in letter order, as only equality to a depth is asked for:
the ranks say which suffixes have to be sorted at all, and the bytes decide.

Defined results: null texts are empty, empty and short texts lose nothing;
null keys come first; rows that repeat a key are separate documents ordered
by a hash of their texts; a text of any length is one document, whole in a
task's memory; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credlake.llm import blocks as bl
from credlake.llm.common import scratch, ship

LENGTH = 100
# A perfect difference set modulo 57 (every other residue is one difference of two members).
PERIOD, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
SAMPLE = LENGTH - PERIOD + 1
STRETCH = 256  # suffixes that travel together at most
PAIRS = 1 << 16  # neighbours compared at a time


class Depth:
    """Names of the strings of one depth."""

    def __init__(self, seed: int, depth: int):
        self.depth, self.values, self.names = depth, bl.randoms(seed, 256), bl.names(seed, depth)

    def at(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """A name (uint64) for each place (ascending), at which ``depth`` bytes must remain."""
        return self.names.at(lambda i, j: self.values[data[i:j]], len(data), places, places + self.depth)


_KEPT: dict = {}


def names(seed: int, depth: int) -> Depth:
    if (seed, depth) not in _KEPT:
        _KEPT[seed, depth] = Depth(seed, depth)
    return _KEPT[seed, depth]


def reached(places: np.ndarray, before: int, after: int, size: int) -> np.ndarray:
    """Which of ``size`` positions lie from ``before`` ahead of one of the (distinct) places to ``after`` behind it."""
    edge = np.zeros(size + before + after + 1, np.int32)
    edge[places] += 1
    edge[places + before + after + 1] -= 1
    return np.cumsum(edge)[before:before + size] > 0


class Block:
    """The documents of a block, less those that copy an earlier one."""

    def __init__(self, sizes: np.ndarray, body: bytes, later: np.ndarray):
        self.body, self.data, self.sizes = body, np.frombuffer(body, np.uint8), sizes
        self.starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        self.live = (sizes >= LENGTH) & ~later

    def sampled(self) -> np.ndarray:
        """The sample's places, those with ``SAMPLE`` bytes left in their document."""
        cover = np.array(COVER)
        out = [s + (np.arange(0, n - SAMPLE + 1, PERIOD)[:, None] + cover).ravel() for s, n in zip(self.starts[self.live], self.sizes[self.live])]
        out = [p[p <= s + n - SAMPLE] for p, s, n in zip(out, self.starts[self.live], self.sizes[self.live])]
        return np.concatenate(out) if out else np.empty(0, np.int64)

    def ranks(self, places: np.ndarray, buckets: int) -> np.ndarray:
        return bl.narrow(names(1, SAMPLE).at(self.data, places), buckets)

    def tied(self, answer: dict[int, bytes], buckets: int) -> np.ndarray:
        """The places of suffixes with a tied sample in their first ``PERIOD`` bytes and ``LENGTH`` bytes left."""
        places = self.sampled()
        open_ = reached(places[bl.narrow_chosen(self.ranks(places, buckets), answer)], PERIOD - 1, 0, len(self.data))
        for s, n, live in zip(self.starts, self.sizes, self.live):
            open_[s + n - LENGTH + 1 if live else s:s + n] = False
        return np.flatnonzero(open_)

    def least(self, places: np.ndarray) -> np.ndarray:
        """For each place the least name of the ``SAMPLE``-byte strings within its ``LENGTH`` bytes."""
        near = reached(places, 0, PERIOD - 1, len(self.data))
        low = names(3, SAMPLE).at(self.data, np.flatnonzero(near))
        at = np.cumsum(near)[places] - 1
        wide = 1
        while 2 * wide <= PERIOD:
            low = np.minimum(low[:-wide], low[wide:])
            wide *= 2
        return np.minimum(low[at], low[at + PERIOD - wide])

    def stretches(self, places: np.ndarray, buckets: int):
        """(first place, suffixes, number among the different ones) of every stretch; bucket and bytes of each different one."""
        low = self.least(places) if len(places) else np.empty(0, np.uint64)
        index = np.arange(len(places))
        new = np.ones(len(places), bool)
        new[1:] = (np.diff(places) != 1) | (low[1:] != low[:-1])
        new |= (index - np.maximum.accumulate(np.where(new, index, 0))) % STRETCH == 0
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(places)))
        known: dict[bytes, int] = {}
        number = [known.setdefault(self.body[p:p + c + LENGTH - 1], len(known)) for p, c in zip(places[first].tolist(), counts.tolist())]
        number = np.array(number, np.int64)
        origin = np.unique(number, return_index=True)[1]
        return places[first], counts, number, bl.mixed(low[first][origin]) % np.uint64(buckets), list(known)


def suffix_parts(bucket: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(bucket, data) of a block's different stretches, those of a bucket in order of their first places."""
    order = np.argsort(bucket, kind="stable")
    for k, at in bl.runs(bucket[order]):
        mine = [texts[i] for i in order[at]]
        yield k, struct.pack(f"<q{len(mine)}q", len(mine), *map(len, mine)) + b"".join(mine)


def repeated(names_: np.ndarray, text: bytes, places: np.ndarray) -> np.ndarray:
    """Which of the ``LENGTH``-byte strings at the places equals one at an earlier place of the list; names only bring equals together."""
    words = np.ndarray(max(0, len(text) - 7), "<u8", text, strides=(1,))  # the eight bytes from every place on
    offsets = [*range(0, LENGTH - 8, 8), LENGTH - 8]
    order = np.argsort(names_, kind="stable")
    same = names_[order[1:]] == names_[order[:-1]]
    pairs = np.stack((order[:-1][same], order[1:][same]))
    again, unlike = np.zeros(len(places), bool), []
    for i in range(0, pairs.shape[1], PAIRS):
        one, two = (places[p] for p in pairs[:, i:i + PAIRS])
        equal = np.ones(len(one), bool)
        for o in offsets:
            equal &= words[one + o] == words[two + o]
        again[pairs[1, i:i + PAIRS]] = equal
        unlike.append(names_[pairs[0, i:i + PAIRS][~equal]])
    unlike = np.unique(np.concatenate(unlike)) if unlike else names_[:0]
    seen: set[bytes] = set()
    for i in np.flatnonzero(bl.contained(names_, unlike)):
        string = text[places[i]:places[i] + LENGTH]
        again[i] = string in seen
        seen.add(string)
    return again


def first_places(sent: list[tuple[int, bytes]]) -> list[bytes | None]:
    """One bucket: for each block, bits of its suffixes that an earlier block or place has."""
    texts, ends, counts = [], [], []
    for _, raw in sent:
        (n,) = struct.unpack_from("<q", raw)
        sizes = np.frombuffer(raw, np.int64, n, 8)
        texts.append(raw[8 + 8 * n:])
        ends.append(sizes)
        counts.append(int((sizes - LENGTH + 1).sum()))
    text, sizes = b"".join(texts), np.concatenate(ends)
    inner = reached(np.cumsum(sizes) - LENGTH + 1, 0, LENGTH - 2, len(text))  # fewer than LENGTH bytes left in the stretch
    places = np.flatnonzero(~inner)
    again = repeated(names(2, LENGTH).at(np.frombuffer(text, np.uint8), places), text, places)
    return [np.packbits(b).tobytes() if b.any() else None for b in np.split(again, np.cumsum(counts)[:-1])]


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", block: int = bl.BLOCK, bucket: int = bl.BUCKET) -> DataFrame:
    """(key, n_bytes, spans, kept) per document: the removed runs [start, stop) in bytes and the remaining bytes."""
    ship()
    spark, folder = df.sparkSession, scratch(df.sparkSession, "suffixes")
    rows = bl.packed(df, key, text, block, f"{folder}/blocks", True)
    total = rows.select(F.sum(F.octet_length("body"))).first()[0] or 0
    whole_buckets = max(1, -(-total // (16 * bucket)))
    sample_buckets = max(1, -(-total * 4 * len(COVER) // PERIOD // bucket))
    suffix_buckets = max(1, -(-total // bucket))  # planned for a quarter of all suffixes, at four bytes each

    def bodies(sizes: np.ndarray, body: bytes) -> list[bytes]:
        stops = np.cumsum(sizes)
        return [body[e - n:e] for e, n in zip(stops.tolist(), sizes.tolist())]

    def sample(number, ids, sizes, body):
        later = bl.copies(bodies(sizes, body), bl.answers(f"{folder}/copies", number))[1]
        bl.save(f"{folder}/later", str(number), np.packbits(later).tobytes())
        b = Block(sizes, body, later)
        yield from bl.narrow_parts(b.ranks(b.sampled(), sample_buckets))

    def later_of(number: int, sizes: np.ndarray) -> np.ndarray:
        return bl.bits(bl.load(f"{folder}/later", str(number)), len(sizes)) & (sizes >= LENGTH)

    def suffixes(number, ids, sizes, body):
        b = Block(sizes, body, later_of(number, sizes))
        first, counts, which, home, texts = b.stretches(b.tied(bl.answers(f"{folder}/ties", number), sample_buckets), suffix_buckets)
        kept = b"".join(a.astype(np.uint32).tobytes() for a in (first, counts, which, home))
        bl.save(f"{folder}/tied", str(number), struct.pack("<qq", len(first), len(home)) + kept)
        yield from suffix_parts(home, texts)

    bl.ask(rows, lambda number, ids, sizes, body: bl.whole_parts([b for b in bodies(sizes, body) if len(b) >= LENGTH], whole_buckets),
           bl.whole_copies, whole_buckets, f"{folder}/copies")
    bl.ask(rows, sample, bl.narrow_ties, sample_buckets, f"{folder}/ties")
    bl.ask(rows, suffixes, first_places, suffix_buckets, f"{folder}/marks")

    def marked(number: int) -> np.ndarray:
        """Places of the block's suffixes that also start earlier."""
        raw = bl.load(f"{folder}/tied", str(number))
        n, m = struct.unpack_from("<qq", raw)
        values = np.frombuffer(raw, np.uint32, offset=16).astype(np.int64)
        first, counts, which, home = np.split(values, np.cumsum([n, n, n]))
        origin = np.unique(which, return_index=True)[1]  # the stretch that each different one is first found as
        sizes = counts[origin]
        begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        again = np.zeros(int(sizes.sum()), bool)
        order, answer = np.argsort(home, kind="stable"), bl.answers(f"{folder}/marks", number)
        for k, at in bl.runs(home[order]):
            if k in answer:
                mine = order[at]
                total_ = int(sizes[mine].sum())
                inside = np.arange(total_) - np.repeat(np.cumsum(sizes[mine]) - sizes[mine], sizes[mine])
                again[np.repeat(begin[mine], sizes[mine]) + inside] = bl.bits(answer[k], total_)
        inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        is_first = np.zeros(n, bool)
        is_first[origin] = True
        gone = ~np.repeat(is_first, counts) | again[np.repeat(begin[which], counts) + inside]
        return (np.repeat(first, counts) + inside)[gone]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, sizes, body in bl.rows_of(batches):
            later = later_of(number, sizes)
            b = Block(sizes, body, later)
            gone = reached(marked(number), 0, LENGTH - 1, len(b.data))
            spans, kept, ends = [], [], [0]
            for s, n, copy in zip(b.starts, b.sizes, later):
                mine = gone[s:s + n] | copy
                turn = np.flatnonzero(np.diff(np.concatenate(([False], mine, [False]))))
                spans.append(turn.reshape(-1, 2))
                kept.append(b.data[s:s + n][~mine].tobytes())
                ends.append(ends[-1] + len(spans[-1]))
            flat = np.concatenate(spans)
            listed = pa.StructArray.from_arrays([pa.array(flat[:, 0], pa.int64()), pa.array(flat[:, 1], pa.int64())], ["start", "stop"])
            yield pa.RecordBatch.from_arrays([ids, pa.array(b.sizes), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed),
                                              pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    kind = df.schema[key].dataType.simpleString()
    out = rows.mapInArrow(cut, f"id {kind}, n_bytes bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary")
    return out.withColumnRenamed("id", key)
