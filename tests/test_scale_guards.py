"""Scale invariants: hot keys, plan shapes without auto-broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from credlake.operators import flat_rules, lsh
from credlake.plans import QUERIES
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_bucket_is_pre_aggregated(spark):
    # One signature holds a third of all rows.
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("1111000011110000")).otherwise(F.format_string("%016d", F.col("id") % 97))
        .alias("firma_lsh"), (F.col("id") % 7 == 0).cast("int").alias("es_fraude"))
    stats = lsh.bucket_stats(df)
    plan = _plan(stats)
    assert re.search(r"HashAggregate\(keys=\[firma_lsh.*partial_count", plan), plan
    hot = stats.where(F.col("firma_lsh") == "1111000011110000").first()
    brute = [i for i in range(n) if i % 3 == 0]
    assert hot.total_solicitudes == len(brute)
    assert hot.fraudes_detectados == sum(1 for i in brute if i % 7 == 0)


def test_flat_flow_with_a_hot_request(spark):
    # Request 1 holds a third of all applicants; the flat path aggregates it exactly.
    apps = [(1 if i % 3 == 0 else 10000 + i, i, "TITULAR" if i in (0, 1, 2) else "AVAL", "DEPENDENT", i == 3, 1, 100.0)
            for i in range(3000)]
    app_df = spark.createDataFrame(apps, "request_id long, pos int, role string, income_type string, "
                                         "is_hard_debt boolean, n_pay long, s_pay double") \
        .withColumn("s_pay", F.col("s_pay").cast("decimal(38,2)"))
    req = spark.createDataFrame([(1, 30.0), (10002, 1.0), (4, 1e9)], "id long, monthly_rent double")
    out = {r.id: r for r in flat_rules.p0_flat(req, app_df).collect()}
    # Request 1: titular pos 0 (avg 100 > 0), one hard-debt applicant (pos 3), rent 30*3 = 90 <= 100.
    assert out["1"].final_decision_code == "REJECTED" and out["1"].blocking_rule_codes == "RL_DICOM_HARD"
    assert out["1"].n_observations == 1000 + 1   # one income observation per dependent applicant + one rejection
    assert out["10002"].final_decision_code == "APPROVED"      # pos 2 is its own titular, 100 >= 3
    assert out["4"].blocking_rule_codes == "RL_NO_TITULAR"     # no applicants


NO_PLAN_CHECK = {n for n in QUERIES if n.startswith("ml_") or n.startswith("stream_")}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_PLAN_CHECK))
def test_no_cartesian_or_nested_loop_joins(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES[name](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_applicant_index_across_blocks(spark, monkeypatch):
    # One request with 10 000 applicants spans several rank blocks; indexes stay exact.
    monkeypatch.setattr(flat_rules, "POS_BLOCK", 512)
    rows = [(1, p) for p in range(3, 30003, 3)] + [(2, 7), (2, 1)]
    df = spark.createDataFrame(rows, "request_id long, pos int")
    got = {(r.request_id, r.pos): r.idx for r in flat_rules.with_applicant_index(df).collect()}
    assert all(got[(1, p)] == i for i, p in enumerate(range(3, 30003, 3)))
    assert got[(2, 1)] == 0 and got[(2, 7)] == 1
