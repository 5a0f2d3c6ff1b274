"""Centroid clustering in whole numbers by Shallot search.

Every component x becomes floor(scale * x); centroids, sums and squared
distances are whole numbers throughout, so the result does not depend on how
the rows are dealt out.  A vector remembers its centroid, the centroid that
was second nearest, an upper bound of the distance to the first and a lower
bound of the distance to all others.  In a round

1. the bounds are widened by how far the centroids moved; a vector whose upper
   bound stays below its lower bound, or below half the way from its centroid
   to the next one, keeps its centroid;
2. of the others, the two remembered centroids are measured, and the search
   starts at the closer one, c: its neighbours are taken in order of their
   distance from c while that is within d(x, c) plus the distance to the second
   nearest so far, a ball that shrinks as nearer centroids turn up;
3. all that survives is compared as whole numbers, ties to the smaller number.

Bounds are floats with a margin that exceeds their rounding, so they only ever
spare a comparison.

Vectors are packed into rows of ``BLOCK`` once.  A round is one narrow pass
that writes vectors and bounds anew to the shared folder (the round before is
then deleted) together with one row of sums per task; the sums of a centroid
meet in one aggregate, and only ``k`` centroids reach the driver.

Defined results: vectors that are null, of another length, or hold a null, NaN
or infinite component are left out; a null key is kept (its seed text is
``<seed>:``); rows that repeat a key are vectors of their own, as seeds in
the order of their components; with fewer than ``k`` vectors there are so many
centroids; an empty table gives an empty result; other columns are ignored.  A
squared distance or a sum of them that does not fit a long raises.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.llm.common import scratch, ship

BLOCK = 1 << 15
# What bounds must differ by before they decide anything; far above their rounding.
RELATIVE, ABSOLUTE = 1e-9, 1e-6
STATE = "near binary, second binary, upper binary, lower binary"
SUMS = "sums array<struct<cluster: int, rows: bigint, total: array<decimal(38,0)>>>"


class Clusters(NamedTuple):
    assigned: DataFrame  # (key, cluster int, distance long), in the shared folder
    centroids: list[list[int]]


class Centroids:
    """The centroids of a round with each one's neighbours in order of distance."""

    def __init__(self, rows: list[list[int]], before: list[list[int]] | None):
        self.count, self.largest = len(rows), max((abs(v) for r in rows for v in r), default=0)
        self.exact = np.array(rows, np.int64 if self.largest < 1 << 62 else object)
        gaps = np.array([[math.dist(a, b) for b in rows] for a in rows])
        self.order = np.argsort(gaps, axis=1, kind="stable")
        self.ring = np.take_along_axis(gaps, self.order, 1)
        self.half = self.ring[:, 1] / 2 if self.count > 1 else np.full(self.count, np.inf)
        self.drift = np.array([math.dist(a, b) for a, b in zip(rows, before or rows)])
        top = np.argsort(self.drift)
        self.others = np.full(self.count, self.drift[top[-1]])  # the longest way that another centroid moved
        if self.count > 1:
            self.others[top[-1]] = self.drift[top[-2]]

    def squared(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Exact squared distances of rows of ``x`` (int64 or Python integers) to the centroids ``which``."""
        gap = x - self.exact[which]
        return (gap * gap).sum(axis=1)


def whole(stored: np.ndarray, largest: int) -> np.ndarray:
    """Components as int64 where no squared distance can overflow, else as Python integers."""
    most = max(int(np.abs(stored.astype(np.float64)).max(initial=0)), largest)
    if stored.shape[1] * (2 * most) ** 2 < 1 << 63:
        return stored.astype(np.int64)
    return np.array([[int(v) for v in r] for r in stored], object).reshape(stored.shape)


def packed_ints(x: np.ndarray, scale: int) -> tuple[str, bytes]:
    """floor(scale * x) in the narrowest type that holds it; float64 holds every such floor exactly."""
    v = np.floor(scale * x)
    most = np.abs(v).max(initial=0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
    return kind, v.astype(kind).tobytes()


def below(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    """Where a bound is under another one, rounding aside."""
    return small * (1 + RELATIVE) + ABSOLUTE < large


def search(c: Centroids, x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
    """Bring the four arrays of a block up to date; returns how many distances were measured."""
    if c.count == 1:
        near[:], second[:] = 0, 0
        return 0
    upper += c.drift[near]
    lower -= c.others[near]
    todo = np.flatnonzero(~below(upper, np.maximum(lower, c.half[near])))
    measured = len(todo)
    d = c.squared(x[todo], near[todo])
    upper[todo] = np.sqrt(d.astype(np.float64))
    still = ~below(upper[todo], np.maximum(lower[todo], c.half[near[todo]]))
    todo, d1 = todo[still], d[still]
    a, b = near[todo], second[todo]
    d2 = c.squared(x[todo], b)
    measured += len(todo)
    swap = (d2 < d1) | ((d2 == d1) & (b < a))
    a, b, d1, d2 = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, d2, d1), np.where(swap, d1, d2)
    start, reach = a.copy(), np.sqrt(d1.astype(np.float64))
    live = np.arange(len(todo))
    for step in range(c.count):
        ball = reach[live] + np.sqrt(d2[live].astype(np.float64))
        live = live[~below(ball, c.ring[start[live], step])]
        if not len(live):
            break
        j = c.order[start[live], step]
        new = (j != a[live]) & (j != b[live])
        at, j = live[new], j[new]
        d = c.squared(x[todo[at]], j)
        measured += len(at)
        first = (d < d1[at]) | ((d == d1[at]) & (j < a[at]))
        later = ~first & ((d < d2[at]) | ((d == d2[at]) & (j < b[at])))
        won, next_ = at[first], at[later]
        b[won], d2[won] = a[won], d1[won]
        a[won], d1[won] = j[first], d[first]
        b[next_], d2[next_] = j[later], d[later]
    near[todo], second[todo] = a, b
    upper[todo], lower[todo] = np.sqrt(d1.astype(np.float64)), np.sqrt(d2.astype(np.float64))
    return measured


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, centroids: Centroids):
    """(ids, kind, bytes, components, near, second, upper, lower) of every stored block."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids = batch.column("ids")[i].values
            if ids is None or not len(ids):
                continue  # a row of sums
            kind, raw = batch.column("kind")[i].as_py(), batch.column("ints")[i].as_py()
            x = whole(np.frombuffer(raw, kind).reshape(-1, dims), centroids.largest)
            n, held = len(x), [batch.column(c)[i].as_py() for c in ("near", "second", "upper", "lower")]
            if held[0]:
                state = [np.frombuffer(h, t).copy() for h, t in zip(held, (np.int32, np.int32, np.float64, np.float64))]
            else:
                state = [np.zeros(n, np.int32), np.full(n, min(1, centroids.count - 1), np.int32), np.full(n, np.inf), np.full(n, -np.inf)]
            yield ids, kind, raw, x, state


def _read(spark: SparkSession, rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch(spark, name)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def kept(df: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """(id, vector array<double>) of the rows with ``dims`` finite components."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.where((F.size(vector) == dims) & finite).select(F.col(key).alias("id"), v.alias("vector"))


def seeds(rows: DataFrame, k: int, scale: int, seed: str) -> list[list[int]]:
    """The ``k`` vectors whose ``seed:key`` has the smallest SHA-256; at most ``k`` rows per task are compared."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = rows.select(mark.alias("mark"), "vector").orderBy("mark", "vector").limit(k).collect()
    return [[math.floor(scale * x) for x in r.vector] for r in first]


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 40, rounds: int = 5,
            scale: int = 256, seed: str = "2") -> Clusters:
    """Centroids after ``rounds`` rounds of assignment and exact means, and every vector's nearest one."""
    ship()
    spark, kind_of_key = df.sparkSession, df.schema[key].dataType.simpleString()
    rows = kept(df, key, vector, dims)
    now, before = seeds(rows, k, scale, seed), None
    result = f"id {kind_of_key}, cluster int, distance bigint"
    if not now:
        return Clusters(spark.createDataFrame([], result).withColumnRenamed("id", key), [])
    block_schema = f"ids array<{kind_of_key}>, kind string, ints binary, {STATE}"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0

        def row():
            code, raw = packed_ints(np.concatenate(parts), scale)
            whole_ids = pa.concat_arrays(ids)
            listed = pa.ListArray.from_arrays(pa.array([0, len(whole_ids)], pa.int32()), whole_ids)
            return pa.RecordBatch.from_arrays([listed, pa.array([code]), pa.array([raw], pa.binary()), *[pa.array([b""], pa.binary())] * 4],
                                              ["ids", "kind", "ints", "near", "second", "upper", "lower"])
        for batch in batches:
            ids.append(batch.column("id"))
            parts.append(batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
            held += batch.num_rows
            if held >= BLOCK:
                yield row()
                ids, parts, held = [], [], 0
        if held:
            yield row()

    def assign(centroids: Centroids):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, total = np.zeros(centroids.count, np.int64), np.zeros((centroids.count, dims), object)
            names = ["ids", "kind", "ints", "near", "second", "upper", "lower", "sums"]
            empty = pa.array([[]], pa.list_(SUM_TYPE))
            for ids, code, raw, x, state in _blocks(batches, dims, centroids):
                search(centroids, x, *state)
                near = state[0]
                count += np.bincount(near, minlength=centroids.count)
                order = np.argsort(near, kind="stable")
                found, at = np.unique(near[order], return_index=True)
                total[found] += np.add.reduceat(x[order], at, axis=0).astype(object)
                listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([listed, pa.array([code]), *(pa.array([b], pa.binary()) for b in (raw, *(s.tobytes() for s in state))), empty], names)
                kind_of_ids = ids.type
            if count.any():
                sums = [{"cluster": int(j), "rows": int(count[j]), "total": [int(v) for v in total[j]]} for j in np.flatnonzero(count)]
                yield pa.RecordBatch.from_arrays([pa.array([[]], pa.list_(kind_of_ids)), pa.array([""]), *[pa.array([b""], pa.binary())] * 5,
                                                  pa.array([sums], pa.list_(SUM_TYPE))], names)
        return run

    def finish(centroids: Centroids):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, _, _, x, state in _blocks(batches, dims, centroids):
                search(centroids, x, *state)
                distance = centroids.squared(x, state[0])
                yield pa.RecordBatch.from_arrays([ids, pa.array(state[0]), pa.array(distance.tolist(), pa.int64())], ["id", "cluster", "distance"])
        return run

    blocks, path = _read(spark, rows.mapInArrow(pack, block_schema), "vectors")
    for _ in range(rounds):
        moved, folder = _read(spark, blocks.mapInArrow(assign(Centroids(now, before)), f"{block_schema}, {SUMS}"), "vectors")
        _delete(spark, path)
        one = moved.where(F.size("sums") > 0).select(F.explode("sums").alias("s")).select("s.cluster", "s.rows", F.posexplode("s.total").alias("at", "part"))
        means = one.groupBy("cluster", "at").agg(F.sum("rows").alias("rows"), F.sum("part").alias("total")).collect()  # at most k * dims rows
        before, now = now, [list(c) for c in now]
        for r in means:
            now[r.cluster][r.at] = int(r.total) // r.rows
        blocks, path = moved.drop("sums"), folder
    assigned, _ = _read(spark, blocks.mapInArrow(finish(Centroids(now, before)), result), "assigned")
    _delete(spark, path)
    return Clusters(assigned.withColumnRenamed("id", key), now)


SUM_TYPE = pa.struct([("cluster", pa.int32()), ("rows", pa.int64()), ("total", pa.list_(pa.decimal128(38, 0)))])
