"""Rendezvous hashing of record keys over weighted shards.

Every (key, shard) pair gets a pseudo-random u in (0, 1) from the MD5 of
``key:shard``; the key goes to the shard with the greatest ``-weight/ln(u)``.
A shard's share is proportional to its weight, and since the scores of the
old shards do not change, a new shard only takes keys into itself.

Defined results: a null key counts as the text ``null``; a null text has no
bytes.  Ties between shards (equal scores) go to the smaller shard number.
Repeated rows get the same shard and separate slots.  An empty table gives an
empty result.  Other columns pass through; an output column replaces an input
column of its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credlake.llm.common import fresh, stored

LOCAL = (1 << 33) - 1  # the low bits of monotonically_increasing_id: the row's place in its partition


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard (int) that the key belongs to; one weight per shard, each over 0."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight over 0")
    text = F.coalesce(key.cast("string"), F.lit("null"))

    def score(shard: int, weight: float) -> Column:
        head = F.conv(F.substring(F.md5(F.concat(text, F.lit(f":{shard}")).cast("binary")), 1, 13), 16, 10)
        u = (head.cast("long").cast("double") + 0.5) / float(1 << 52)
        return F.struct((F.lit(-float(weight)) / F.ln(u)).alias("score"), F.lit(-shard).alias("shard"))

    best = F.array_max(F.array(*[score(i, w) for i, w in enumerate(weights)]))
    return (-best["shard"]).cast("int")


def with_slots(df: DataFrame, shard: str, order: list[str], slot: str = "slot") -> DataFrame:
    """Number the rows of every shard from 0 without gaps, in ``order``.

    The rows are range-partitioned by (shard, order), so a shard spreads over
    many tasks; a row's slot is its place in its partition plus what earlier
    partitions hold of the shard.  Those offsets are one row per partition
    and shard that meet (at most partitions + shards, as the ranges are
    disjoint), which bounds the broadcast.
    """
    part, place, before = fresh(df, "part"), fresh(df, "place"), fresh(df, "before")
    rows = (df.repartitionByRange(shard, *order).sortWithinPartitions(shard, *order)
            .withColumn(part, F.spark_partition_id())
            .withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit(LOCAL))))
    rows = stored(rows, "slots")
    counts = rows.groupBy(shard, part).agg(F.count("*").alias("rows"), F.min(place).alias("first"))
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, part, (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias(before))
    return (rows.join(F.broadcast(offsets), [shard, part])
            .withColumn(slot, (F.col(place) + F.col(before)).cast("long")).drop(part, place, before))


def assign(df: DataFrame, key: str, weights: list[float], grown: list[float] | None = None) -> DataFrame:
    """Add ``shard`` and, with the weights of a changed shard list, ``grown_shard``."""
    out = df.withColumn("shard", shard_of(F.col(key), weights))
    return out.withColumn("grown_shard", shard_of(F.col(key), grown)) if grown else out


def write_shards(df: DataFrame, path: str, key: str, weights: list[float], files_per_shard: int = 1) -> None:
    """Write the rows to ``path/shard=N/``; ``files_per_shard`` spreads one shard over so many tasks."""
    salt = fresh(df, "salt")
    out = assign(df, key, weights).withColumn(salt, F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_shard)))
    out.repartition(len(weights) * files_per_shard, "shard", salt).drop(salt).write.partitionBy("shard").parquet(path)
