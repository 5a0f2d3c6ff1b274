"""Sinks and sources round trips, the silver job, exact quantiles, splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from credlake.operators import generic, lsh, stats
from credlake.operators.sampling import extract_sample, stratified_split
from credlake.plans import jobs
from credlake.sinks import writers
from credlake.sources import files, views
from credlake.sources.views import FEATURES
from tests.conftest import SF_CHECK, SF_SMALL


def test_csv_to_silver_job_round_trip(spark, tmp_path):
    apps = views.applications(spark, SF_SMALL).drop("id")
    csv = str(tmp_path / "bronze")
    assert writers.write_csv(apps, csv) == apps.count()                  # K5
    back = files.read_applications(spark, csv)                             # S1
    assert back.count() == apps.count()
    out = jobs.silver_job(spark, csv, str(tmp_path / "gold"), str(tmp_path / "model"))   # L1, K1, K3
    assert out["rows"] == apps.count() == out["written"]
    assert len(out["top"]) <= 5 and all(t["fraudes_detectados"] > 0 for t in out["top"])
    model = files.load_lsh_model(spark, str(tmp_path / "model"), FEATURES)  # S4
    assert model.bits == 16 and len(model.mean) == 5
    gold = spark.read.parquet(str(tmp_path / "gold"))
    assert "firma_lsh" in gold.columns and gold.count() == out["rows"]
    # Idempotent: a rerun overwrites instead of appending.
    jobs.silver_job(spark, csv, str(tmp_path / "gold"), str(tmp_path / "model"))
    assert spark.read.parquet(str(tmp_path / "gold")).count() == out["rows"]


def test_missing_model_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.load_lsh_model(spark, str(tmp_path / "none"), FEATURES)


def test_scored_append_insights_and_delete(spark, tmp_path):
    risk = views.risk_input(spark, SF_SMALL)
    path = str(tmp_path / "scored")
    n = jobs.score_to_documents(spark, risk, path, str(tmp_path / "invalid"))   # L2, K2
    assert n > 0
    report = jobs.insights_report(spark, path)                                     # S3, L3
    k = report["kpis"].first()
    assert k.n_solicitudes == n == k.n_aprobadas + k.n_rechazadas
    ids = spark.read.parquet(path).select(F.col("_id").alias("id")).limit(3)
    flat = spark.read.parquet(path).withColumnRenamed("_id", "id")
    flat_path = str(tmp_path / "flat")
    flat.write.parquet(flat_path)
    assert writers.delete_from(spark, flat_path, ids) is True                     # K7
    assert spark.read.parquet(flat_path).count() == n - 3
    assert writers.save_record(flat, ["id", "resultado_final"], str(tmp_path / "rec")) == n   # K6


def test_exact_quantiles_match_numpy(spark):
    df = spark.read.parquet(f"{SF_CHECK}/orders.parquet").select("o_totalprice")
    vals = np.array([r[0] for r in df.collect()])
    for p in (0.0, 0.25, 0.5, 0.75, 1.0):
        assert stats.exact_quantile(df, "o_totalprice", p) == pytest.approx(np.quantile(vals, p), rel=1e-12)


def test_hot_value_quantile(spark):
    df = spark.range(10000).select(F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("v"))
    vals = np.array([r[0] for r in df.collect()])
    assert stats.exact_quantile(df, "v", 0.5) == pytest.approx(np.quantile(vals, 0.5))


def test_sample_is_disjoint_and_complete(spark):
    apps = views.applications(spark, SF_CHECK)
    s, r = extract_sample(apps, 0.2)
    ns, nr, n = s.count(), r.count(), apps.count()
    assert ns + nr == n and s.join(r, "id").count() == 0
    assert abs(ns / n - 0.2) < 0.02


def test_stratified_split_shares(spark):
    df = views.applications(spark, SF_CHECK).select("id", "es_fraude")
    sp = stratified_split(df, "es_fraude", 0.2)
    got = {(r.es_fraude, r.is_test): r.n for r in sp.groupBy("es_fraude", "is_test").agg(F.count("*").alias("n")).collect()}
    for c in (0, 1):
        total = got[(c, True)] + got[(c, False)]
        assert got[(c, True)] == int(np.floor(total * 0.2 + 0.5))
    assert sp.count() == df.count() == sp.select("id").distinct().count()


def test_catalog_and_templates(spark):
    flows_df = spark.createDataFrame([("P1", "f1", "Alpha", "active"), ("P1", "f2", "Beta", "draft"),
                                      ("P2", "f3", "Gamma", "active")], "product_id string, flow_id string, flow_name string, flow_status string")
    names = spark.createDataFrame([("f1",), ("Gamma",), ("f1",)], "name string")
    vis = generic.catalog_rollup(flows_df, names)
    assert sorted(r.flow_id for r in vis.collect()) == ["f1", "f3"]
    found = generic.catalog_search(flows_df, "%", ("flow_name",))
    assert found.count() == 0   # '%' is literal, not a wildcard
    agg = generic.aggregate_data(spark.createDataFrame([(1.0,), (None,)], "x double"), {"x": "avg", "y": "sum"}).first()
    assert agg.x == 0.5 and agg.y == 0.0


def test_keyed_append_is_idempotent(spark, tmp_path):
    df = spark.range(10).withColumnRenamed("id", "_id")
    path = str(tmp_path / "docs")
    assert writers.append_scored(df, path, key="_id") == 10
    assert writers.append_scored(df, path, key="_id") == 0
    assert spark.read.parquet(path).count() == 10


def test_cluster_conf_sizes_partitions():
    from credlake.session import cluster_conf
    conf = cluster_conf(100 << 40, executors=1000, cores_per_executor=4)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert cluster_conf(1 << 30, 10, 4)["spark.sql.shuffle.partitions"] == "80"


def test_rank_selection_is_exact_for_64bit_keys(spark):
    big = 2 ** 62
    df = spark.range(5000).select((F.lit(big) + F.col("id") * 3).alias("k"))
    got = stats.values_at_ranks(df, "k", [0, 1234, 4999])
    assert got == {0: big, 1234: big + 1234 * 3, 4999: big + 4999 * 3}


def test_keyed_lookup_and_projection_reach_the_scan(spark):
    from credlake.operators.validate import project_features
    from credlake.sources.tables import read_table
    orders = read_table(spark, SF_SMALL, "orders")
    one = generic.keyed_lookup(orders, "o_orderkey", 7)                                   # P12
    cols = project_features(one, ["o_totalprice"], keep=["o_orderkey"])                  # P1
    plan = cols._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderkey,7)" in plan                         # filter pushed into the Parquet scan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan          # columns pruned
    assert cols.count() == 1


def test_lsh_evaluation_job_round_trip(spark, tmp_path):
    apps = views.applications(spark, SF_SMALL)
    csv = str(tmp_path / "bronze")
    writers.write_csv(apps.drop("id"), csv)
    jobs.silver_job(spark, csv, str(tmp_path / "gold"), str(tmp_path / "model"))
    new = apps.limit(20).drop("es_fraude")
    n = jobs.lsh_evaluation_job(spark, new, str(tmp_path / "model"), str(tmp_path / "gold"), str(tmp_path / "eval"))
    assert n == 20
    reports = spark.read.json(str(tmp_path / "eval"))
    # Every application came from the history, so every bucket is found.
    assert reports.where(F.col("historial").isNull()).count() == 0
    assert set(r.decision for r in reports.collect()) <= {"APROBADA", "REVISION_EXHAUSTIVA", "RECHAZADA"}


def test_confusion_matrix_of_any_number_of_classes(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("y"), ((F.col("id") * 3) % 5).alias("yhat"))
    got = {(r.y, r.yhat): r.n for r in stats.confusion_matrix(df).collect()}
    rows = [(i % 7, i * 3 % 5) for i in range(3000)]
    assert got == {(a, b): rows.count((a, b)) for a in range(7) for b in range(7)}
    many = spark.range(5000).select((F.col("id") % 90).alias("y"), (F.col("id") % 45).alias("yhat"))
    assert stats.confusion_matrix(many).count() == 8100
    listed = stats.confusion_matrix(df, classes=[1, 99]).collect()
    assert {(r.y, r.yhat): r.n for r in listed} == {(1, 1): rows.count((1, 1)), (1, 99): 0, (99, 1): 0, (99, 99): 0}


def test_classification_report_against_plain_counts(spark):
    pairs = [(i % 40 if i % 11 else None, (i * 3 + i % 7) % 40) for i in range(3000)]
    df = spark.createDataFrame(pairs, "y long, yhat long")
    got = {r.label: r for r in stats.classification_report(df).collect()}
    for c in range(40):
        tp = sum(a == b == c for a, b in pairs)
        said, are = sum(b == c for _, b in pairs), sum(a == c for a, _ in pairs)
        assert got[str(c)].support == are
        assert got[str(c)].precision == pytest.approx(tp / said if said else 0) and got[str(c)].recall == pytest.approx(tp / are if are else 0)
    assert got["accuracy"].support == 3000 and got["accuracy"].f1 == pytest.approx(sum(a == b for a, b in pairs) / 3000)
    assert got["macro avg"].recall == pytest.approx(np.mean([got[str(c)].recall for c in range(40)]))
    empty = stats.classification_report(df.limit(0)).collect()
    assert [r.label for r in empty] == ["accuracy", "macro avg", "weighted avg"]


@pytest.mark.parametrize("odd", [[float("inf")], [1.7e308, -1.7e308], [float("-inf"), float("inf"), 5e-324]])
def test_quantiles_with_extreme_values_over_many_rows(spark, odd):
    plain = [float(i % 977) for i in range(60_000)]
    df = spark.range(60_000).select((F.col("id") % 977).cast("double").alias("v")).unionByName(spark.createDataFrame([(x,) for x in odd], "v double"))
    ranked = sorted(plain + odd)
    ks = [0, 1, 2, 30_000, len(ranked) - 3, len(ranked) - 1]
    assert stats.values_at_ranks(df, "v", ks) == {k: ranked[k] for k in ks}


def test_describe_leaves_nan_out(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(float("nan"),), (None,)], "v double")
    r = stats.describe(df, ["v"]).first()
    assert (r["count"], r["mean"], r.p50, r["max"]) == (10, 4.5, 4.5, 9.0)


def test_latest_has_one_rule_for_null_keys(spark):
    from credlake.operators import p0
    keys = [(i,) for i in range(5)] + [(None,)] * 10
    df = spark.createDataFrame(keys, "id long")
    for n in (3, 5, 8, 2000):
        want = ([4, 3, 2, 1, 0] + [None] * 10)[:n]
        rows, count = p0.latest_with_count(df, n)
        assert [r.id for r in rows.collect()] == want and count == len(want)


def test_command_line_runs_a_query(spark, tmp_path, capsys):
    from credlake.__main__ import main
    assert main(["list"]) == 0
    assert "lsh_top_risk_buckets\tsql" in capsys.readouterr().out
    out = str(tmp_path / "q")
    assert main(["run", "p0_validate", "--sf", SF_SMALL, "--out", out]) == 0
    assert spark.read.parquet(out).count() == views.applications(spark, SF_SMALL).count()


def test_write_split_one_pass(spark, tmp_path):
    from credlake.operators.sampling import write_split
    apps = views.applications(spark, SF_SMALL)
    path = str(tmp_path / "split")
    write_split(apps, 0.1, path)
    back = spark.read.parquet(path)
    parts = {r.part: r.n for r in back.groupBy("part").agg(F.count("*").alias("n")).collect()}
    s, r = extract_sample(apps, 0.1)
    assert parts == {"sample": s.count(), "rest": r.count()}
    assert back.select("id").distinct().count() == apps.count()


def test_report_ids_are_the_same_on_every_read(spark):
    scored = spark.range(50).selectExpr("id", "'01' as firma_lsh", "cast(4 as bigint) as total_balde", "cast(1 as bigint) as fraudes_balde",
                                        "25.0 as pct_fraude", "'APROBADA' as decision", "true as encontrado", "1.0 as a")
    reports = lsh.evaluation_documents(scored.withColumn("pct_fraude", F.col("pct_fraude").cast("double")), ["a"])
    one, two = (sorted((r.id, r.id_solicitud, r.fecha) for r in reports.repartition(n).collect()) for n in (1, 5))
    assert one == two and len({r[1] for r in one}) == 50
    other = lsh.evaluation_documents(scored.withColumn("pct_fraude", F.col("pct_fraude").cast("double")), ["a"]).collect()
    assert not {r.id_solicitud for r in other} & {r[1] for r in one}
