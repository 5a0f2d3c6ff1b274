"""Ranks of many columns in shared passes, splits without a job per class, rows numbered across partitions."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from credlake.operators import generic, stats
from credlake.operators.ranking import with_rank
from credlake.operators.sampling import HASH_MOD, HASH_MULT, stratified_split


def jobs_of(spark, group, act):
    """Spark jobs that ``act`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        act()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_columns_of_all_types_share_the_passes(spark):
    rng = np.random.default_rng(5)
    big = [int(x) for x in (1 << 62) + rng.integers(0, 500, 700)]
    reals = [float(x) for x in rng.normal(0, 1e6, 699)] + [float("nan")]
    cents = [Decimal(int(x)) / 100 for x in rng.integers(-9999, 9999, 700)]
    df = spark.createDataFrame(list(zip(big, reals, cents)), "a long, b double, c decimal(12,2)")
    ks = [0, 1, 349, 350, 698, 699]
    a, b, c = stats.Ranks(df, ["a", "b", "c"]).at([ks, ks, ks])
    assert a == {k: sorted(big)[k] for k in ks}
    assert b == {k: sorted(reals[:-1])[k] for k in ks if k < 699}
    assert c == {k: sorted(cents)[k] for k in ks}


def test_describe_has_as_many_jobs_for_twenty_columns_as_for_one(spark):
    wide = spark.range(0, 4000, 1, 4).select(*[((F.col("id") * (2 * i + 3)) % 977 + F.col("id") / 7).alias(f"c{i}") for i in range(20)])
    one = jobs_of(spark, "describe-1", lambda: stats.describe(wide, ["c0"]))
    many = jobs_of(spark, "describe-20", lambda: stats.describe(wide, wide.columns))
    assert many <= one + 2  # a pass more where some column ends later
    got = {r["column"]: r for r in stats.describe(wide, wide.columns).collect()}
    values = wide.toPandas()
    for c in wide.columns:
        assert got[c]["p50"] == pytest.approx(round(float(values[c].quantile(0.5)), 2), abs=0.011)


def test_describe_of_nothing(spark):
    empty = spark.createDataFrame([], "a double, b long")
    assert [(r["column"], r["count"], r["p50"]) for r in stats.describe(empty, ["a", "b"]).collect()] == [("a", 0, None), ("b", 0, None)]
    assert stats.describe(empty, []).count() == 0


def expected_split(rows, fraction, seed=42):
    """Ids on the test side, class by class, for distinct ids."""
    h = lambda i: ((i % HASH_MOD) * HASH_MULT + seed) % HASH_MOD
    out = set()
    for c in {y for _, y in rows}:
        mine = sorted((h(i), i) for i, y in rows if y == c)
        out |= {i for _, i in mine[:int(len(mine) * fraction + 0.5)]}
    return out


def test_split_of_a_thousand_classes(spark):
    rows = [(i, None if i % 1001 == 0 else f"c{i % 1001}") for i in range(20_020)]
    df = spark.createDataFrame(rows, "id long, y string")
    got = stratified_split(df, "y", 0.2)
    assert {r.id for r in got.where("is_test").collect()} == expected_split(rows, 0.2)
    few = df.where("id % 1001 < 2")
    assert jobs_of(spark, "split-many", lambda: stratified_split(df, "y")) <= jobs_of(spark, "split-few", lambda: stratified_split(few, "y")) + 2


def test_split_where_keys_share_a_hash_and_where_all_rows_share_a_key(spark):
    rows = [(7 + HASH_MOD * i, "a") for i in range(50)] + [(i, "b") for i in range(30)]
    got = stratified_split(spark.createDataFrame(rows, "id long, y string"), "y", 0.3)
    assert {r.id for r in got.where("is_test").collect()} == expected_split(rows, 0.3)
    same = spark.range(40).select(F.lit(3).cast("long").alias("id"), F.lit("x").alias("y"))
    assert {r.is_test for r in stratified_split(same, "y").collect()} == {True}  # rows of a key stay together


def test_split_of_nothing_and_of_clashing_columns(spark):
    empty = spark.createDataFrame([], "id long, y string")
    assert stratified_split(empty, "y").count() == 0
    df = spark.range(100).select("id", (F.col("id") % 2).alias("c"), F.lit("k").alias("k"), F.lit(1).alias("h"), F.lit("was").alias("is_test"))
    out = stratified_split(df, "c", 0.1)
    assert out.columns == ["id", "c", "k", "h", "is_test"] and out.where("is_test").count() == 10


def test_rows_are_numbered_across_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select("id", (F.col("id") % 3 == 0).alias("hot"), F.when(F.col("id") % 5 > 0, F.col("id") * 37 % 101).alias("v"))
    got = {r.id: r["rank"] for r in with_rank(df, [F.desc_nulls_last("v"), F.asc("id")]).collect()}
    rows = sorted(((r.v is None, -(r.v or 0), r.id) for r in df.collect()))
    assert got == {i: n for n, (_, _, i) in enumerate(rows, 1)}
    assert with_rank(df.where("id < 0"), [F.asc("id")]).count() == 0


def test_a_lookup_reaches_the_scan(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("role")).write.parquet(str(tmp_path / "t"))
    found = generic.keyed_lookup(spark.read.parquet(str(tmp_path / "t")), "role", "1")
    assert found.count() == 33 and "EqualTo(role,1)" in found._jdf.queryExecution().executedPlan().toString()
