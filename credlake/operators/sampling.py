"""Deterministic sampling and splits.

Membership is a pure function of the key, so the sample and the remainder
are disjoint and complete, and a lost executor recomputes the same rows.
The key hash is integer arithmetic that DuckDB computes identically:

    h(id) = ((id mod P) * 2654435761 + seed) mod P,   P = 1 000 003

(``id mod P`` first, so the product never overflows a 64-bit integer.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credlake.session import cut_lineage

# Fixed values of the split hash (shared with the oracle SQL).
HASH_MOD = 1_000_003
HASH_MULT = 2_654_435_761
MAX_BROADCAST_CLASSES = 100_000


def split_hash(key: Column, seed: int = 42) -> Column:
    return F.pmod(F.pmod(key.cast("long"), F.lit(HASH_MOD)) * F.lit(HASH_MULT) + F.lit(seed), F.lit(HASH_MOD))


def sample_cut(fraction: float) -> int:
    return int(round(fraction * HASH_MOD))


def in_sample(key: Column, fraction: float, seed: int = 42) -> Column:
    """J4 membership as a column: one pass labels sample and remainder."""
    return split_hash(key, seed) < F.lit(sample_cut(fraction))


def write_split(df: DataFrame, fraction: float, path: str, seed: int = 42, key: str = "id") -> None:
    """J4 as one write: ``part=sample`` and ``part=rest`` folders from a
    single pass over ``df`` (the remainder replaces the original)."""
    part = F.when(in_sample(F.col(key), fraction, seed), F.lit("sample")).otherwise(F.lit("rest"))
    df.withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(path)


def extract_sample(df: DataFrame, fraction: float, seed: int = 42, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(sample, remainder).  The remainder is the complement predicate,
    which equals ``df.join(sample, key, "left_anti")`` without a shuffle."""
    h = split_hash(F.col(key), seed)
    cut = F.lit(sample_cut(fraction))
    return df.where(h < cut), df.where(h >= cut)


def _ranked(hist: DataFrame, bucket: str) -> DataFrame:
    """Per class, the histogram row that holds rank ``need`` (1-based), and the rank that is left inside it.

    A class has at most about a thousand rows in a histogram here (keys of one
    hash: a millionth of the class), and a window spills."""
    below = F.coalesce(F.sum("n").over(Window.partitionBy("c").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (hist.withColumn("_below", below).where((F.col("_below") < F.col("need")) & (F.col("need") <= F.col("_below") + F.col("n")))
            .withColumn("need", F.col("need") - F.col("_below")).drop("n", "_below"))


def stratified_split(df: DataFrame, label: str, test_fraction: float = 0.2, seed: int = 42,
                     key: str = "id") -> DataFrame:
    """Adds ``is_test``; per class exactly ``round(test_fraction * n_class)``
    rows (half up) go to the test side: the rows with the smallest
    ``(split_hash(key), key)``; rows that share a key stay together.  NULL is a
    class of its own.

    All classes are cut together by three histograms of the source, each
    combined before its shuffle and ranked per class: of blocks of 1,024 hash
    values, of the values of each class's chosen block, and of the keys that
    share the chosen value (a millionth of the class).  No result of a class
    comes to the driver and no job or condition is made per class.  The cuts,
    a row per class, are stored; they are broadcast while there are at most
    ``MAX_BROADCAST_CLASSES`` and otherwise left to a shuffled join.
    """
    h = split_hash(F.col(key), seed)
    rows = df.select(F.col(label).alias("c"), h.alias("h"), F.col(key).alias("k"))
    block = F.floor(F.col("h") / 1024).cast("long")
    coarse = rows.groupBy("c", block.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    need = F.floor(F.sum("n").over(Window.partitionBy("c")) * F.lit(test_fraction) + F.lit(0.5)).cast("long")
    blocks = cut_lineage(_ranked(coarse.withColumn("need", need), "b"))
    classes = blocks.count()

    def held(cuts: DataFrame) -> DataFrame:
        return F.broadcast(cuts) if classes <= MAX_BROADCAST_CLASSES else cuts

    def narrowed(cuts: DataFrame, mine: Column, cut: str, out: str) -> DataFrame:
        """The histogram of ``out`` over the rows whose ``mine`` is their class's ``cut``."""
        at = cuts.withColumnsRenamed({"c": "_c"})
        near = rows.join(held(at), F.col("c").eqNullSafe(F.col("_c")) & (mine == F.col(cut)))
        group = list(dict.fromkeys(["c", "h", out, "need"]))
        return near.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))

    values = _ranked(narrowed(blocks, block, "b", "h"), "h").select("c", F.col("h").alias("_h"), "need")
    keys = _ranked(narrowed(values, F.col("h"), "_h", "k"), "k")
    cuts = cut_lineage(keys.select(F.col("c").alias("_split_c"), F.col("h").alias("_split_h"), F.col("k").alias("_split_k")))
    test = (h < F.col("_split_h")) | ((h == F.col("_split_h")) & (F.col(key) <= F.col("_split_k")))
    kept = [c for c in df.columns if c != "is_test"]
    return (df.join(held(cuts), F.col(label).eqNullSafe(F.col("_split_c")), "left")
            .select(*kept, F.coalesce(test, F.lit(False)).alias("is_test")))
