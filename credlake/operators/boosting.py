"""Boosted trees of several classes, grown side by side over counted cells (M2, M3).

The model is that of ``GBTClassifier``, one per class against the rest: 32
bins a feature, regression trees by variance on the residuals of the
logarithmic loss, mean leaves, a row sample a round and a feature sample a
node.  The work is laid out so that it stays small as the rows grow:

* A row matters only by its bins and its class, so equal rows are one cell
  with a count; Spark bins, groups and shuffles them once.
* A partition holds its cells as a few blocks of arrays, with the scores of
  all classes.  Each level of a round's trees is one pass for all classes:
  every partition sums counts and residuals by node, feature and bin, and only
  these sums, whose size depends on the classes and features, reach the driver.
* The row sample is drawn for each row of a cell from a hash of cell, row
  number and round, and residuals are summed as whole multiples of 2^-20, so
  a model does not depend on how the rows are dealt to partitions (given the
  same bin limits).
* Scores move on in the first pass of the next round.  The chain of rounds is
  cut by a checkpoint every ``KEEP`` rounds; the former one is deleted.
"""

from __future__ import annotations

import math
import operator
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.session import ensure_checkpoint_dir, send_package

BINS = 32
NEVER = 255  # no bin lies above it: a node that is not split
ONE = 1 << 20  # residuals are summed in these parts: exact in a double up to 2^31 rows
BLOCK = 1 << 17  # cells of a block
DRAWN = 1 << 20  # row draws held at once
SINGLY = 4096  # cells of more rows draw their number at once
KEEP = 25
QUANTILE_ERROR = 0.001
COLLECTED = 64  # partitions whose sums are added on the driver


@dataclass(frozen=True)
class Params:
    rounds: int
    depth: int = 4
    step: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    seed: int = 42


@dataclass
class Trees:
    """Complete trees, by round and class; node ``j`` has the children ``2j + 1`` and ``2j + 2``."""

    limits: list[list[float]]  # by feature: bin i ends with limits[i]
    feature: np.ndarray
    last: np.ndarray  # the last bin that goes left
    leaf: np.ndarray  # what a leaf adds to the score
    gain: np.ndarray  # by class and feature

    def to_dict(self) -> dict:
        return {"limits": self.limits} | {k: getattr(self, k).tolist() for k in ("feature", "last", "leaf", "gain")}

    @classmethod
    def from_dict(cls, d: dict) -> Trees:
        return cls(d["limits"], np.array(d["feature"], "int32"), np.array(d["last"], "uint8"),
                   np.array(d["leaf"], "float64"), np.array(d["gain"], "float64"))

    def probabilities(self, features: list[str]) -> Column:
        """P(class) of every class against the rest, as an array."""
        _send(SparkSession.active())
        limits, feature, last, leaf = self.limits, self.feature, self.last, self.leaf

        @F.arrow_udf("array<double>")
        def scored(*columns: pa.Array) -> pa.Array:
            bins = _bins(columns, limits)
            score = np.zeros((bins.shape[1], leaf.shape[1]))
            for m in range(len(leaf)):
                for k in range(leaf.shape[1]):
                    score[:, k] += leaf[m, k][_places(bins, feature[m, k], last[m, k])]
            with np.errstate(over="ignore"):
                p = 1 / (1 + np.exp(-2 * score))
            return pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype="int32") * leaf.shape[1], p.ravel())

        return scored(*[F.col(f).cast("double") for f in features])

    def importances(self) -> np.ndarray:
        """By class and feature: the share of the gain of all splits."""
        total = self.gain.sum(axis=1, keepdims=True)
        return np.divide(self.gain, total, out=np.zeros_like(self.gain), where=total > 0)


@dataclass
class Block:
    """Kept narrow: every level of every round reads it."""

    bins: np.ndarray  # feature x cell
    label: np.ndarray  # index of the class
    rows: np.ndarray
    score: np.ndarray  # class x cell
    taken: np.ndarray  # rows of the round's sample


def _send(spark: SparkSession) -> None:
    send_package(spark, f"{ensure_checkpoint_dir(spark)}/modules-{uuid.uuid4().hex}")


def _bins(columns, limits: list[list[float]]) -> np.ndarray:
    """Feature x row; a missing value lies above every limit."""
    return np.stack([np.searchsorted(np.asarray(at, "float64"), c.cast(pa.float64()).to_numpy(zero_copy_only=False)).astype("uint8")
                     for c, at in zip(columns, limits)])


def _places(bins: np.ndarray, feature: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The node of each cell among those below the given levels, from left to right."""
    right: list[np.ndarray] = []
    place = np.zeros(bins.shape[1], "uint8")
    while (1 << len(right)) - 1 < len(feature):
        level = range((1 << len(right)) - 1, (2 << len(right)) - 1)
        goes = [bins[feature[j]] > last[j] for j in level]
        for bit in reversed(right):
            goes = [a ^ (bit & (a ^ b)) for a, b in zip(goes[::2], goes[1::2])]
        right.append(goes[0])
        place = (place << np.uint8(1)) | goes[0]
    return place


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finisher of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _steps(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, "uint64") * np.uint64(0x9E3779B97F4A7C15)


def _drawn(bins: np.ndarray, label: np.ndarray, rows: np.ndarray, m: int, p: Params) -> np.ndarray:
    """Rows of each cell in the sample of round ``m``: every row by a draw of its own."""
    if p.subsample >= 1:
        return rows.copy()
    taken, below = np.zeros(len(rows), rows.dtype), np.uint64(int(p.subsample * 2**64))
    key = _steps(label + 1)
    for b in bins:
        key = _mixed(key + _steps(b + np.uint64(1)))
    first = _mixed(key + _steps(np.array([p.seed * 1_000_003 + m + 1])))
    single = np.flatnonzero(rows <= SINGLY)
    ends = np.cumsum(rows[single], dtype="int64")
    at = 0
    while at < len(single):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + DRAWN, "right")))
        some = single[at:to]
        n, starts = rows[some], ends[at:to] - rows[some] - done
        number = np.arange(ends[to - 1] - done) - np.repeat(starts, n)
        hit = _mixed(np.repeat(first[some], n) + _steps(number)) < below
        taken[some] = np.add.reduceat(hit, starts, dtype="int64")
        at = to
    for i in np.flatnonzero(rows > SINGLY):
        taken[i] = np.random.default_rng([p.seed, m, int(key[i])]).binomial(rows[i], p.subsample)
    return taken


def _residuals(block: Block, k: int, m: int) -> np.ndarray:
    """What class ``k``'s tree of round ``m`` fits (the first: the sides themselves), in parts of 1 / ONE."""
    side = (block.label == k) * np.float32(2) - np.float32(1)
    if m == 0:
        return side * np.float32(ONE)
    with np.errstate(over="ignore"):
        return np.rint(np.float32(4 * ONE) * side / (1 + np.exp(2 * side * block.score[k])))


def _sums(block: Block, m: int, feature: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Class x node x feature x bin x (rows, residuals) at the level below the given ones.

    Two features share a table, whose margins are the sums of each."""
    classes, nodes, width = len(block.score), feature.shape[1] + 1, len(block.bins)
    out = np.zeros((classes, nodes, width, BINS, 2))
    wide = block.bins.astype("uint16")
    codes = [(wide[i] << np.uint16(5)) | (wide[i + 1] if i + 1 < width else np.uint16(0)) for i in range(0, width, 2)]
    taken = block.taken.astype("float64")
    for k in range(classes):
        node = _places(block.bins, feature[k], last[k]).astype("uint32") << np.uint32(10)
        weights = taken, taken * _residuals(block, k, m)
        for i, code in enumerate(codes):
            cell = (node | code).astype("intp")
            for j, w in enumerate(weights):
                table = np.bincount(cell, w, nodes * BINS * BINS).reshape(nodes, BINS, BINS)
                out[k, :, 2 * i, :, j] = table.sum(axis=2)
                if 2 * i + 1 < width:
                    out[k, :, 2 * i + 1, :, j] = table.sum(axis=1)
    return out


def _moved(block: Block, feature: np.ndarray, last: np.ndarray, leaf: np.ndarray, m: int, p: Params) -> Block:
    """The block after a round, with the sample of round ``m``."""
    add = np.stack([np.take(leaf[k].astype("float32"), _places(block.bins, feature[k], last[k]).astype("intp")) for k in range(len(leaf))])
    return replace(block, score=block.score + add, taken=_drawn(block.bins, block.label, block.rows, m, p))


def _limits(df: DataFrame, features: list[str]) -> list[list[float]]:
    """Bin limits: between all values of a feature that has at most ``BINS``, else quantiles of all rows."""
    rows = df.select(*[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])
    named = rows.columns
    distinct = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in named]).first()
    at = rows.approxQuantile(named, [i / BINS for i in range(1, BINS)], QUANTILE_ERROR)
    out = []
    for c, quantiles in zip(named, at):
        if distinct[c] <= 2 * BINS:
            some = rows.where(F.col(c).isNotNull() & ~F.isnan(c)).select(c).distinct().limit(BINS + 1).collect()
            if len(some) <= BINS:
                values = sorted(r[0] for r in some)
                quantiles = [(a + b) / 2 for a, b in zip(values, values[1:])]
        out.append(sorted(set(quantiles)))
    return out


def _blocks(df: DataFrame, features: list[str], label: Column, classes: int, limits: list[list[float]], parts: int, p: Params) -> RDD:
    """The cells of all rows, in blocks with the sample of round 0."""
    width = len(features)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = np.ascontiguousarray(_bins(b.columns[:-1], limits).T)
            ends = np.arange(b.num_rows + 1, dtype="int32") * width
            cells = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([cells, b.columns[-1]], ["bins", "label"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            bins = np.frombuffer(b"".join(t["bins"].to_pylist()), "uint8").reshape(-1, width).T.copy()
            named, rows = t["label"].to_numpy().astype("int16"), t["n"].to_numpy()
            rows = rows.astype("uint32" if rows.max() < 1 << 32 else "int64")
            whole = Block(bins, named, rows, np.zeros((classes, len(rows)), "float32"), _drawn(bins, named, rows, 0, p))
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(whole, 5)], pa.binary())], ["block"])

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= BLOCK:
                yield block()
                held = []
        if sum(x.num_rows for x in held):
            yield block()

    rows = df.select(*[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)], label.cast("int").alias("label"))
    cells = rows.mapInArrow(binned, "bins binary, label int").groupBy("bins", "label").agg(F.count(F.lit(1)).alias("n"))
    dealt = cells.repartition(parts, "bins", "label").sortWithinPartitions("bins", "label")
    return dealt.mapInArrow(packed, "block binary").rdd.map(lambda r: pickle.loads(r[0]))


def _split(sums: np.ndarray, allowed: np.ndarray) -> tuple[float, int, int, np.ndarray, np.ndarray] | None:
    """The best split of a node: gain, feature, last bin to the left, (rows, residuals) of both sides; None without gain."""
    left = np.cumsum(sums, axis=1)[:, :-1]
    whole = sums[0].sum(axis=0)
    right = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        least = whole[1] ** 2 / whole[0]
        gain = left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0] - least
    gain[(left[..., 0] <= 0) | (right[..., 0] <= 0) | ~allowed[:, None]] = -np.inf
    f, b = np.unravel_index(np.argmax(gain), gain.shape)
    if not gain[f, b] > 1e-12 * least:
        return None
    return float(gain[f, b]) / ONE**2, int(f), int(b), left[f, b], right[f, b]


def _delete(df: DataFrame, path: str | None) -> None:
    if path:
        spark = df.sparkSession
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def fit(df: DataFrame, features: list[str], label: Column, classes: int, p: Params) -> Trees:
    """Trees of ``classes`` models, ``label`` being the class's index (anything else: the rest of all classes).

    ``df`` is read a few times for its bin limits and cells, not in the rounds."""
    spark = df.sparkSession
    _send(spark)
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.count(label).alias("known")).first()
    if not seen["n"] or seen["known"] < seen["n"]:
        raise ValueError(f"{seen['n']} rows, {seen['n'] - seen['known']} without a label: every row needs one")
    limits = _limits(df, features)
    cores = spark.sparkContext.defaultParallelism
    parts = max(1, min(cores, seen["n"] >> 15), seen["n"] >> 23)
    state = _blocks(df, features, label, classes, limits, parts, p).persist(StorageLevel.MEMORY_AND_DISK)
    inner, width = (1 << p.depth) - 1, len(features)
    feature, last = np.zeros((p.rounds, classes, inner), "int32"), np.full((p.rounds, classes, inner), NEVER, "uint8")
    leaf, gain = np.zeros((p.rounds, classes, inner + 1)), np.zeros((classes, width))
    some = max(1, math.ceil(p.colsample * width))
    old = kept = None
    try:
        for m in range(p.rounds):
            ends = np.zeros((classes, 2 * inner + 1, 2))
            is_open = np.zeros((classes, 2 * inner + 1), bool)
            is_open[:, 0] = True
            for d in range(p.depth):
                from_, to = (1 << d) - 1, (2 << d) - 1

                def summed(blocks, m=m, f=feature[m, :, :from_].copy(), at=last[m, :, :from_].copy()):
                    total = None
                    for b in blocks:
                        one = _sums(b, m, f, at)
                        total = one if total is None else total + one
                    return [] if total is None else [total]

                found = state.mapPartitions(summed)
                sums = found.treeReduce(operator.add) if parts > COLLECTED else sum(found.collect())
                if d == 0:
                    ends[:, 0] = sums[:, 0, 0].sum(axis=1)
                    if old is not None:
                        old.unpersist()
                    if state.isCheckpointed():
                        _delete(df, kept)
                        kept = state.getCheckpointFile()
                for k in range(classes):
                    for j in range(from_, to):
                        allowed = np.zeros(width, bool)
                        allowed[np.random.default_rng([p.seed, m, k, j]).permutation(width)[:some]] = True
                        best = _split(sums[k, j - from_], allowed) if is_open[k, j] else None
                        if best is None:
                            ends[k, 2 * j + 1] = ends[k, j]
                            continue
                        more, feature[m, k, j], last[m, k, j], ends[k, 2 * j + 1], ends[k, 2 * j + 2] = best
                        gain[k, feature[m, k, j]] += more
                        is_open[k, 2 * j + 1] = is_open[k, 2 * j + 2] = True
            n, s = ends[:, inner:, 0], ends[:, inner:, 1]
            leaf[m] = np.divide(s, n * ONE, out=np.zeros_like(s), where=n > 0) * (p.step if m else 1.0)
            if m + 1 < p.rounds:
                old = state
                state = old.map(lambda b, f=feature[m], at=last[m], v=leaf[m], m=m: _moved(b, f, at, v, m + 1, p))
                state.persist(StorageLevel.MEMORY_AND_DISK)
                if (m + 1) % KEEP == 0:
                    state.checkpoint()
    finally:
        state.unpersist()
        if old is not None:
            old.unpersist()
        _delete(df, kept)
    return Trees(limits, feature, last, leaf, gain)
