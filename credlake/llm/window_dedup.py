r"""Substring deduplication by level-wise doubling.

Words are runs of characters other than space, tab, line feed, vertical tab,
form feed and carriage return.  Every word is removed that a window of
``length`` consecutive words of one document covers whose words also start
anywhere else, in this document or another.

The first level asks which windows of about a quarter of that length occur
twice.  Only a place whose window is repeated, and whose window right after it
is, can start a repeated window of twice the length: so each level extends what
was repeated at the one before, asks about those alone, and stops at ``length``
or when no candidate survives.  (The last level may overlap its two halves.)

Texts are packed into blocks with single spaces between words; a block asks
about each distinct name once (see ``blocks``).  Before the last level a name is
a filter of 32 bits and its bucket, where a chance tie only adds a candidate.
On the last level a name is the window's 128-bit BLAKE2 digest, made from its
bytes.  Whole copies are found by SHA-256 first: all of them go, and the first
alone takes part in the levels.  A block keeps a bit per word between levels.

Defined results: null texts have no words; texts of fewer than ``length`` words
lose nothing; rows that repeat a key are separate documents; a text of any
length is one document, whole in a task's memory; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credlake.llm import blocks as bl
from credlake.llm.common import scratch, ship

FIRST = 12  # the first level has at most so many words
LONG = 1024  # bytes of a word that its polynomial name covers; longer ones get a digest
WIDTH = 16
BLOCK = 4 << 20  # a word's arrays take some ten times its bytes


def levels(length: int) -> list[int]:
    """Window lengths, each at most twice the one before."""
    out = [length]
    while out[0] > FIRST:
        out.insert(0, -(-out[0] // 2))
    return out


def words(body: bytes) -> bytes:
    """The words, joined by one space."""
    return b" ".join(body.split())


class Block:
    """A block's documents as words."""

    def __init__(self, sizes: np.ndarray, body: bytes):
        self.body, self.data, self.sizes = body, np.frombuffer(body, np.uint8), sizes
        self.ends = np.cumsum(sizes)
        spaces = np.flatnonzero(self.data == 32)
        some = sizes > 0
        self.first = np.sort(np.concatenate(((self.ends - sizes)[some], spaces + 1)))
        self.last = np.sort(np.concatenate((spaces, self.ends[some])))
        self.counts = np.diff(np.searchsorted(self.first, np.concatenate(([0], self.ends))))
        self.tops = np.cumsum(self.counts)
        self.left = np.repeat(self.tops, self.counts) - np.arange(len(self.first))

    def texts(self, length: int) -> list[bytes]:
        """The documents of ``length`` words or more."""
        return [self.body[e - n:e] for e, n, c in zip(self.ends, self.sizes, self.counts) if c >= length]

    def copied(self, length: int, answer: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each document whether it has copies, and whether it is not the first of them."""
        out = np.zeros((2, len(self.counts)), bool)
        long = np.flatnonzero(self.counts >= length)
        out[:, long] = bl.copies(self.texts(length), answer)
        return out[0], out[1]

    def hashes(self) -> np.ndarray:
        """A 64-bit value for every word."""
        table = bl.randoms(7, 256)
        sizes = self.last - self.first
        out = bl.names(8, LONG).at(lambda i, j: table[self.data[i:j]], len(self.data), self.first, np.minimum(self.last, self.first + LONG))
        for i in np.flatnonzero(sizes > LONG):
            out[i] = int.from_bytes(hashlib.blake2b(self.body[self.first[i]:self.last[i]], digest_size=8).digest(), "little")
        return out

    def ranks(self, hashes: np.ndarray, places: np.ndarray, length: int, buckets: int) -> np.ndarray:
        h = bl.names(length, length).at(lambda i, j: hashes[i:j], len(hashes), places, places + length)
        return bl.narrow(h, buckets)

    def digests(self, places: np.ndarray, length: int) -> np.ndarray:
        """Two uint64 for every window."""
        body, make = memoryview(self.body), hashlib.blake2b
        spans = zip(self.first[places].tolist(), self.last[places + length - 1].tolist())
        raw = b"".join([make(body[i:j], digest_size=WIDTH).digest() for i, j in spans])
        return np.frombuffer(raw, np.uint64).reshape(-1, 2)

    def candidates(self, length: int, live: np.ndarray, alive: np.ndarray | None, before: int) -> np.ndarray:
        """Places where a window of ``length`` words can be repeated, given where those of ``before`` words are."""
        out = (self.left >= length) & live
        if alive is not None:
            out &= alive
            shift = length - before
            out[:len(out) - shift] &= alive[shift:]
        return np.flatnonzero(out)


def exact_parts(digests: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, slice]], np.ndarray, np.ndarray]:
    """(distinct digests, their buckets' runs, which are there twice, the place of each digest among the distinct ones)."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    sorted_ = digests[order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_[1:] != sorted_[:-1]).any(axis=1)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    distinct = sorted_[new]
    # Buckets ascend with the digests.
    return distinct, bl.runs((distinct[:, 0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)), np.bincount(place, minlength=len(distinct)) > 1, place


def exact_ties(sent: list[tuple[int, bytes]]) -> list[bytes | None]:
    """For each block's digests (and bits of those it has twice), bits of those with two places or more in all."""
    parts, often = [], []
    for _, raw in sent:
        count = len(raw) * 8 // (8 * WIDTH + 1)
        parts.append(np.frombuffer(raw, np.uint64, count * WIDTH // 8).reshape(-1, 2))
        often.append(bl.bits(raw, count, count * WIDTH))
    every, tie = np.concatenate(parts), np.concatenate(often)
    order = np.lexsort((every[:, 1], every[:, 0]))
    same = (every[order[1:]] == every[order[:-1]]).all(axis=1)
    tie[order[1:][same]] = True
    tie[order[:-1][same]] = True
    return [np.packbits(b).tobytes() if b.any() else None for b in np.split(tie, np.cumsum([len(p) for p in parts])[:-1])]


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = 35, block: int = BLOCK, bucket: int = bl.BUCKET) -> DataFrame:
    """(key, n_words, spans, kept) per document: the removed runs [start, stop) of words, and the other words joined by one space (UTF-8)."""
    ship()
    folder, steps = scratch(df.sparkSession, "windows"), levels(length)
    rows = bl.packed(df, key, text, block, f"{folder}/blocks", False, words)
    total = rows.select(F.sum(F.octet_length("body"))).first()[0] or 0
    # Planned for a word per 6 bytes; a bucket's share only shrinks from level to level.
    buckets = [max(1, -(-total * (WIDTH if n == length else 4) // 6 // bucket)) for n in steps]

    bl.ask(rows, lambda number, ids, sizes, body: bl.whole_parts(Block(sizes, body).texts(length), buckets[0]), bl.whole_copies, buckets[0], f"{folder}/copies")

    def living(b: Block, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that have copies, and words that take part."""
        again, later = b.copied(length, bl.answers(f"{folder}/copies", number))
        return again, np.repeat(~later, b.counts)

    def alive(b: Block, number: int, at: int, hashes: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Words at which a window of level ``at`` (not the last) is repeated; kept for the next level."""
        held = bl.bits(bl.load(f"{folder}/alive{at - 1}", str(number)), len(b.first)) if at else None
        places = b.candidates(steps[at], live, held, steps[at - 1] if at else 0)
        out = np.zeros(len(b.first), bool)
        out[places[bl.narrow_chosen(b.ranks(hashes, places, steps[at], buckets[at]), bl.answers(f"{folder}/level{at}", number))]] = True
        bl.save(f"{folder}/alive{at}", str(number), np.packbits(out).tobytes())
        return out

    def send(at: int):
        def run(number, ids, sizes, body):
            b = Block(sizes, body)
            hashes = b.hashes() if len(steps) > 1 else None
            live = living(b, number)[1]
            held = alive(b, number, at - 1, hashes, live) if at else None
            places = b.candidates(steps[at], live, held, steps[at - 1] if at else 0)
            if steps[at] < length:
                yield from bl.narrow_parts(b.ranks(hashes, places, steps[at], buckets[at]))
                return
            distinct, parts, often, place = exact_parts(b.digests(places, length), buckets[at])
            asked = [x for k, where in parts for x in (k, where.stop)]
            bl.save(f"{folder}/last", str(number), struct.pack(f"<q{len(asked)}q", len(parts), *asked) + places.astype(np.uint32).tobytes() + place.astype(np.uint32).tobytes())
            for k, where in parts:
                yield k, distinct[where].tobytes() + np.packbits(often[where]).tobytes()
        return run

    survive = True
    for at, n in enumerate(steps):
        survive = survive and bl.ask(rows, send(at), bl.narrow_ties if n < length else exact_ties, buckets[at], f"{folder}/level{at}") > 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, sizes, body in bl.rows_of(batches):
            b = Block(sizes, body)
            edge = np.zeros(len(b.first) + 1, np.int64)
            raw = bl.load(f"{folder}/last", str(number)) if survive else None
            if raw:
                (count,) = struct.unpack_from("<q", raw)
                asked = struct.unpack_from(f"<{2 * count}q", raw, 8)
                places, place = np.frombuffer(raw, np.uint32, offset=8 + 16 * count).reshape(2, -1).astype(np.int64)
                answer, digests, start = bl.answers(f"{folder}/level{len(steps) - 1}", number), np.zeros(asked[-1] if asked else 0, bool), 0
                for k, stop in zip(asked[::2], asked[1::2]):
                    if k in answer:
                        digests[start:stop] = bl.bits(answer[k], stop - start)
                    start = stop
                hit = places[digests[place]]
                edge += np.bincount(hit, minlength=len(edge))
                edge -= np.bincount(hit + length, minlength=len(edge))
            gone = (np.cumsum(edge[:-1]) > 0) | np.repeat(living(b, number)[0], b.counts)
            # A word goes with the space before it, if it has one.
            opening = np.zeros(len(b.data) + 1, np.int32)
            opening[b.first[gone]] += 1
            opening[b.last[gone]] -= 1
            drop = np.cumsum(opening[:-1]) > 0
            lead = b.first[gone & (b.left != np.repeat(b.counts, b.counts))] - 1
            drop[lead] = True
            spans, kept, ends = [], [], [0]
            for e, n, top, count in zip(b.ends, b.sizes, b.tops, b.counts):
                turn = np.flatnonzero(np.diff(np.concatenate(([False], gone[top - count:top], [False]))))
                spans.append(turn.reshape(-1, 2))
                kept.append(b.data[e - n:e][~drop[e - n:e]].tobytes().lstrip(b" "))
                ends.append(ends[-1] + len(spans[-1]))
            flat = np.concatenate(spans)
            listed = pa.StructArray.from_arrays([pa.array(flat[:, 0], pa.int64()), pa.array(flat[:, 1], pa.int64())], ["start", "stop"])
            yield pa.RecordBatch.from_arrays([ids, pa.array(b.counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed),
                                              pa.array(kept, pa.binary())], ["id", "n_words", "spans", "kept"])

    kind = df.schema[key].dataType.simpleString()
    out = rows.mapInArrow(cut, f"id {kind}, n_words bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary")
    return out.withColumnRenamed("id", key)
