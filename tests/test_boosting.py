"""Boosted trees over counted cells: passes, layout, row draws, a plain model in Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from credlake.operators import boosting, ml


def _rows(spark, n=3000):
    h = F.pmod(F.xxhash64("id"), F.lit(1 << 20)).cast("int")
    t = spark.range(n).select("id", (h % 29).alias("a"), F.floor(h / 29 % 7).cast("double").alias("b"), (h % 3).alias("noise"))
    t = t.withColumn("a", F.when(F.col("a") != 5, F.col("a")))  # a missing value
    return t.withColumn("label", F.when(F.coalesce("a", F.lit(30)) + F.col("b") > 25, 2).when(F.col("b") > 3, 1).otherwise(0))


def test_a_level_is_one_job_for_all_classes(spark):
    t = _rows(spark, 600).cache()
    t.count()
    tracker, jobs = spark.sparkContext.statusTracker(), []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for rounds in (2, 6):
            spark.sparkContext.setJobGroup(f"boost-{rounds}", "fit")
            ml.fit_multiclass(t, ["a", "b", "noise"], "label", [0, 1, 2], rounds)
            jobs.append(len(tracker.getJobIdsForGroup(f"boost-{rounds}")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] - jobs[0] == 4 * ml.DEPTH


def test_a_model_does_not_depend_on_the_partitions(spark):
    t = _rows(spark).cache()
    asked = t.select("id", "a", "b", "noise")
    one, two = (ml.fit_multiclass(t.repartition(n), ["a", "b", "noise"], "label", [0, 1, 2], 30) for n in (1, 7))
    columns = ["id", "p_0", "p_1", "p_2", "prediction"]
    assert sorted(one.predict(asked).select(columns).collect()) == sorted(two.predict(asked).select(columns).collect())
    hit = one.predict(t).where(F.col("prediction") == F.col("label")).count()
    assert hit > 0.95 * t.count()


def _plain(rows, sides, rounds, depth, step):
    """Scores of unsampled boosting, straight from the definition."""
    values = [sorted({r[f] for r in rows}) for f in range(len(rows[0]))]
    score = [0.0] * len(rows)

    def grow(some, target, d):
        mean = sum(target[i] for i in some) / len(some)
        best = None
        for f in range(len(values)):
            for a, b in zip(values[f], values[f][1:]):
                left = [i for i in some if rows[i][f] <= (a + b) / 2]
                right = [i for i in some if rows[i][f] > (a + b) / 2]
                if left and right:
                    gain = sum(sum(target[i] for i in x) ** 2 / len(x) for x in (left, right)) - len(some) * mean**2
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, left, right
        if d == depth or best is None:
            return {i: mean for i in some}
        return grow(best[1], target, d + 1) | grow(best[2], target, d + 1)

    for m in range(rounds):
        target = [4 * y / (1 + math.exp(2 * y * s)) if m else float(y) for y, s in zip(sides, score)]
        leaves = grow(list(range(len(rows))), target, 0)
        score = [s + (step if m else 1.0) * leaves[i] for i, s in enumerate(score)]
    return score


def test_unsampled_trees_equal_a_plain_model(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b)) for a, b in rng.integers(0, 9, (300, 2))]
    sides = [1 if (a * 1.7 + b + e > 12) else -1 for (a, b), e in zip(rows, rng.normal(0, 3, 300))]
    t = spark.createDataFrame([(i, a, b, int(y < 0)) for i, ((a, b), y) in enumerate(zip(rows, sides))], "id int, a double, b double, y int")
    trees = boosting.fit(t, ["a", "b"], F.col("y"), 1, boosting.Params(6, 3, 0.1, 1.0, 1.0, 42))
    found = t.select("id", trees.probabilities(["a", "b"])[0].alias("p")).orderBy("id").collect()
    want = [1 / (1 + math.exp(-2 * s)) for s in _plain(rows, sides, 6, 3, 0.1)]
    assert max(abs(r.p - w) for r, w in zip(found, want)) < 1e-5


def test_every_row_of_a_cell_is_drawn_by_itself():
    p = boosting.Params(2)
    rows = np.array([1, 3, 100_000, 2] * 500, "uint32")
    bins = np.stack([np.arange(2000) % 32, np.arange(2000) // 32]).astype("uint8")
    label = np.zeros(2000, "int16")
    one, two = (boosting._drawn(bins, label, rows, m, p) for m in (0, 1))
    assert (one <= rows).all() and (one != two).any()
    for n in (1, 2, 3, 100_000):
        share = one[rows == n].sum() / rows[rows == n].sum()
        assert abs(share - 0.8) < 0.06
    assert len(set(one[rows == 3])) >= 3  # not all or nothing
    back = boosting._drawn(bins[:, ::-1], label, rows[::-1], 0, p)
    assert (back[::-1] == one).all()  # wherever a cell lies


def test_checkpoints_are_deleted_and_missing_labels_refused(spark, tmp_path):
    import os
    t = _rows(spark, 300)
    keep, boosting.KEEP = boosting.KEEP, 2
    at = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        short = ml.fit_multiclass(t, ["a", "b"], "label", [0, 1, 2], 7)
        assert not [f for _, _, names in os.walk(tmp_path) for f in names if f.startswith("part-")]
        boosting.KEEP = 100
        assert (ml.fit_multiclass(t, ["a", "b"], "label", [0, 1, 2], 7).trees.leaf == short.trees.leaf).all()
    finally:
        boosting.KEEP = keep
        spark.sparkContext.setCheckpointDir(at if at else str(tmp_path))
    for bad in (t.where("false"), t.withColumn("label", F.when(F.col("id") > 3, F.col("label")))):
        with pytest.raises(ValueError):
            ml.fit_multiclass(bad, ["a", "b"], "label", [0, 1, 2], 2)
