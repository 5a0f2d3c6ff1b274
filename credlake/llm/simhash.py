"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A text's words are its runs of bytes other than ASCII white space, A-Z
lower-cased; every k-word shingle (space-joined, repeats included) votes with
its XXH64 (seed 42), and a fingerprint bit is 1 if it is set in over half of
the votes.  Fingerprints of 64 bits that differ in at most 3 bits differ in
at most 3 bytes, so they share 5 of their 8 positional bytes.  Postings are
kept per 4 positions with their 4 bytes: the 14 position sets below hit every
5 positions, so two linked fingerprints meet in a posting list of 32-bit keys.
Within a list the shared positional bytes of a pair are tallied, pairs with
fewer than 5 go, and the rest are verified on their bits.

A list of m fingerprints yields at most m - 1 links (a spanning forest of its
links, found by breadth-first search), or that of each of 4 splits where it is
wide, never its pairs.  Only distinct
fingerprints are indexed, so copies of a text cost one entry.

Defined results: null and empty texts have no shingles and fingerprint 0,
linked like any other; with fewer words than k the whole sequence is the one
shingle.  Rows with a null key get their group's component, whose id is the
smallest non-null key of the group (null if none).  Repeated rows give
repeated results.  Other columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlake.llm.common import fresh, ship, stored, utf8
from credlake.llm.components import components

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SEED = 42
VOTES = 1 << 14  # hashes unpacked at a time
WIDE = 4096  # a longer posting list is searched through parts of the bits that vary in it


def position_sets() -> list[tuple[int, ...]]:
    """14 sets of 4 of the 8 byte positions, one inside every set of 5.

    Both halves, and every union of a pair from each half whose pairs stand
    in the same one of the 3 perfect matchings: of any 3 positions of a half
    exactly one pair is in a given matching.
    """
    matchings = [((0, 1), (2, 3)), ((0, 2), (1, 3)), ((0, 3), (1, 2))]
    crossed = [(*a, *(4 + x for x in b)) for m in matchings for a in m for b in m]
    return [(0, 1, 2, 3), (4, 5, 6, 7), *crossed]


def votes(text: bytes, k: int) -> np.ndarray:
    from xxhash import xxh64_intdigest
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= k:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    return np.fromiter((xxh64_intdigest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[k - 1:])),
                       np.uint64, len(words) - k + 1)


def fingerprint_of(text: bytes, k: int = 3) -> int:
    """The fingerprint as an unsigned integer."""
    h = votes(text, k)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), VOTES):
        block = h[at:at + VOTES].byteswap().view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprint(text: Column, k: int = 3) -> Column:
    """The fingerprint as a long (its 64 bits)."""
    ship()

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        prints = np.fromiter((fingerprint_of(t.as_py(), k) for t in texts), np.uint64, len(texts))
        return pa.array(prints.view(np.int64))
    return run(utf8(text))


def postings(prints: DataFrame) -> DataFrame:
    """(posting, fp): a fingerprint under each of its 14 keys; the set's number is in the key's upper half."""
    def key(number: int, positions: tuple[int, ...]) -> Column:
        out = F.lit(number).cast("long")
        for p in positions:
            out = F.shiftleft(out, 8).bitwiseOR(F.shiftrightunsigned(F.col("fp"), 56 - 8 * p).bitwiseAND(F.lit(255).cast("long")))
        return out
    return prints.select(F.explode(F.array(*[key(n, s) for n, s in enumerate(position_sets())])).alias("posting"), "fp")


def near(one: np.uint64, others: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of the others share enough positional bytes with ``one`` and differ in at most ``max_bits`` bits."""
    x = others ^ one
    tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    held = tally >= 8 - max_bits
    held[held] = np.bitwise_count(x[held]) <= max_bits
    return held


def forest(points: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what the links among distinct ``points`` (uint64) connect."""
    left, out = points, []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            one = todo.pop()
            hit = near(one, left, max_bits)
            if hit.any():
                found, left = left[hit], left[~hit]
                out += [(int(one), int(f)) for f in found]
                todo += list(found)
    return out


def list_links(points: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """The links of one posting list.

    A wide one deals the bits that vary in it over ``max_bits`` + 1 parts: a
    link's differing bits leave one part untouched, so its ends meet among the
    points that are equal in that part, whichever bytes the list has in common.
    """
    if len(points) <= WIDE:
        return forest(points, max_bits)
    varying = int(np.bitwise_or.reduce(points ^ points[0]))
    bits = [1 << b for b in range(64) if varying >> b & 1]
    out = []
    for part in range(max_bits + 1):
        cells = points & np.uint64(sum(bits[part::max_bits + 1]))
        order = np.argsort(cells, kind="stable")
        cuts = np.flatnonzero(np.diff(cells[order])) + 1
        for group in np.split(order, cuts):
            out += forest(points[group], max_bits)
    return out


def links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (u, v) that connect the fingerprints (column ``fp``, distinct) at ``max_bits`` or fewer differing bits."""
    if max_bits > 3:
        raise ValueError("the position sets guarantee a meeting up to 3 differing bits")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []  # the posting list that the last batch ended in

        def told(found):
            a = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["u", "v"])

        for batch in batches:
            keys = batch.column(0).to_numpy()
            fps = batch.column(1).to_numpy().view(np.uint64)
            if not len(keys):
                continue
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
            sizes = np.diff(cuts)
            found = []
            for g in np.flatnonzero((sizes > 1) | (np.arange(len(sizes)) == 0) | (np.arange(len(sizes)) == len(sizes) - 1)):
                part, k = fps[cuts[g]:cuts[g + 1]], keys[cuts[g]]
                if g == 0 and k == key:
                    held.append(part)
                    if len(sizes) > 1:
                        found += list_links(np.concatenate(held), max_bits)
                        key, held = None, []
                    continue
                if held:
                    found += list_links(np.concatenate(held), max_bits)
                    key, held = None, []
                if g == len(sizes) - 1:
                    key, held = k, [part]
                else:
                    found += list_links(part, max_bits)
            if found:
                yield told(found)
        if held and (found := list_links(np.concatenate(held), max_bits)):
            yield told(found)

    ship()
    dealt = postings(prints).repartition("posting").sortWithinPartitions("posting")
    return dealt.mapInArrow(search, "u long, v long").distinct()


def print_classes(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """(fp, class) of distinct fingerprints (column ``fp``): the smallest fingerprint that links reach."""
    found = components(links(prints, max_bits)).withColumnRenamed("node", "fp")
    return prints.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("class"))


def _classes(df: DataFrame, key: str, text: str, k: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(key, fp) per row, and (fp, root, component_id) per fingerprint."""
    rows = stored(df.select(F.col(key), fingerprint(F.col(text), k).alias("fp")), "prints")
    groups = rows.groupBy("fp").agg(F.min(key).alias("least"))
    found = components(links(rows.select("fp").distinct(), max_bits))
    rooted = groups.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows, stored(rooted.select("fp", "root").join(ids, "root").select("fp", "root", "component_id"), "classes")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3, max_bits: int = 3) -> DataFrame:
    """(key, fp, component_id) per row; the component id is the smallest key of all that links reach."""
    rows, named = _classes(df, key, text, k, max_bits)
    return rows.join(named.drop("root"), "fp").select(key, "fp", "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the row with the smallest key.

    Rows that repeat a key, or have none, are documents of their own: each
    component keeps one row, also where two components' rows share the key.
    Of a component's rows of that key the one with the least hash of all its
    columns stays, so a repeated run keeps the same.
    """
    rows, named = _classes(df, key, text, k, max_bits)
    best = rows.join(named, "fp").where(F.col(key).eqNullSafe(F.col("component_id"))).select(F.col(key).alias("best"), "fp", "root")
    often = stored(rows.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()).select(F.col(key).alias("best")), "repeated")
    once = best.where("best is not null").join(often, "best", "left_anti").select(F.col("best").alias(key))
    kept = df.join(once, key, "left_semi")
    if often.isEmpty():
        return kept
    fp, tie, root, named_key = (fresh(df, c) for c in ("fp", "tie", "root", "best"))
    again = often.withColumnRenamed("best", named_key)
    shared = df.join(again, F.col(key).eqNullSafe(F.col(named_key)), "left_semi").withColumn(fp, fingerprint(F.col(text), k)).withColumn(tie, F.xxhash64(*df.columns))
    won = best.distinct().select(F.col("best").alias(named_key), F.col("fp").alias(f"{fp}_"), F.col("root").alias(root))
    met = shared.join(won, F.col(key).eqNullSafe(F.col(named_key)) & (F.col(fp) == F.col(f"{fp}_"))).drop(named_key, f"{fp}_")
    least = met.groupBy(root).agg(F.min(tie).alias(tie))
    return kept.unionByName(met.join(least, [root, tie]).dropDuplicates([root]).select(df.columns))
