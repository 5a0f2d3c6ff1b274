"""Structured Streaming scorers equal their batch twins; restarts add nothing."""

import os

from pyspark.sql import functions as F

from credlake.operators import lsh, p0
from credlake.operators.sampling import extract_sample
from credlake.sources import views
from credlake.streaming import scoring
from tests.conftest import SF_SMALL


def _same(a, b) -> bool:
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_p0_equals_batch_and_restarts_are_idempotent(spark, tmp_path):
    out = str(tmp_path / "p0")
    risk = F.col("ingreso_mensual"), F.col("deuda_actual"), F.col("score_crediticio")

    def stream():
        return scoring.application_stream(spark, SF_SMALL).withColumn("p_riesgo", views.closed_form_risk(*risk))

    scored, invalid = scoring.stream_p0_scores(spark, stream(), out)
    b_scored, b_invalid = p0.bulk_score(views.risk_input(spark, SF_SMALL))
    assert _same(scored.select(b_scored.columns), b_scored)
    assert invalid.count() == b_invalid.count()
    # Same checkpoint: nothing new to read, so the sinks do not change.
    scored2, _ = scoring.stream_p0_scores(spark, stream(), out)
    assert scored2.count() == scored.count()
    assert os.path.isdir(os.path.join(out, "checkpoint"))


def test_stream_lsh_equals_batch(spark, tmp_path):
    apps = views.applications(spark, SF_SMALL)
    model = lsh.fit_lsh(apps, views.FEATURES)
    new, history = extract_sample(apps, 0.2)
    stats = lsh.bucket_history(model.transform(history))
    stream = scoring.holdout_filter(scoring.application_stream(spark, SF_SMALL), 0.2)
    got = scoring.stream_lsh_scores(spark, stream, model, stats, str(tmp_path / "lsh"))
    batch = lsh.score_against_history(new, model, stats).select(
        "id", "firma_lsh", "total_balde", "fraudes_balde",
        F.when(F.col("encontrado"), F.col("pct_fraude")).alias("pct_fraude"), "decision")
    assert _same(got.select(batch.columns), batch)


def test_streams_read_tables_of_many_part_files(spark, tmp_path):
    root = str(tmp_path / "sf")
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").repartition(3).write.parquet(f"{root}/orders.parquet")
    spark.read.parquet(f"{SF_SMALL}/customer.parquet").write.parquet(f"{root}/customer.parquet")
    risk = F.col("ingreso_mensual"), F.col("deuda_actual"), F.col("score_crediticio")
    stream = scoring.application_stream(spark, root, max_files=1).withColumn("p_riesgo", views.closed_form_risk(*risk))
    scored, invalid = scoring.stream_p0_scores(spark, stream, str(tmp_path / "out"))
    b_scored, b_invalid = p0.bulk_score(views.risk_input(spark, SF_SMALL))
    assert len(os.listdir(str(tmp_path / "out" / "scored"))) == 3          # a micro-batch per part file
    assert _same(scored.select(b_scored.columns), b_scored) and invalid.count() == b_invalid.count()

    from credlake.plans.stream_queries import stream_lsh_scoring
    assert _same(stream_lsh_scoring(spark, root), stream_lsh_scoring(spark, SF_SMALL))
