"""Registered streaming queries (X1, X2).  Their results must equal the
batch queries', so they carry the batch queries' oracle SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.operators import lsh
from credlake.operators.sampling import extract_sample
from credlake.plans import lsh_queries, p0_queries  # noqa: F401  (their oracles are reused below)
from credlake.plans.registry import ORACLES, query
from credlake.sources import views
from credlake.streaming import scoring


@query("stream_lsh_scoring", ORACLES["lsh_score_holdout"])
def stream_lsh_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out applications scored as a stream against the batch history."""
    apps = views.applications(spark, sf_dir)
    _, history = extract_sample(apps, lsh_queries.HOLDOUT_FRACTION)
    model = lsh.fit_lsh(history, views.FEATURES)
    # The history is aggregated once and stored; every micro-batch joins the stored table.
    gold = os.path.join(scoring.stream_dir(spark, "lsh-history"), "gold")
    lsh.bucket_history(model.transform(history)).write.parquet(gold)
    stats = spark.read.parquet(gold)
    new = scoring.holdout_filter(scoring.application_stream(spark, sf_dir), lsh_queries.HOLDOUT_FRACTION)
    return scoring.stream_lsh_scores(spark, new, model, stats, scoring.stream_dir(spark, "lsh"))


@query("stream_p0_scoring", ORACLES["p0_bulk_scoring"])
def stream_p0_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications scored per micro-batch; invalid rows go to a second sink."""
    stream = scoring.application_stream(spark, sf_dir)
    stream = stream.withColumn("p_riesgo", views.closed_form_risk(
        F.col("ingreso_mensual"), F.col("deuda_actual"), F.col("score_crediticio")))
    scored, _ = scoring.stream_p0_scores(spark, stream, scoring.stream_dir(spark, "p0"))
    from credlake.operators import p0
    return scored.select("id", *p0.LABELS, "pct_riesgo", "prediccion_xgboost", "resultado_final", "flujo_estado")


@query("stream_p0_keyed", ORACLES["p0_bulk_scoring"])
def stream_p0_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 + K2: the stream read twice into one store, the second time without
    the first one's checkpoint; every application is stored once."""
    out = scoring.stream_dir(spark, "p0-keyed")
    for run in ("first", "second"):
        stream = scoring.application_stream(spark, sf_dir)
        stream = stream.withColumn("p_riesgo", views.closed_form_risk(
            F.col("ingreso_mensual"), F.col("deuda_actual"), F.col("score_crediticio")))
        scored, _ = scoring.stream_p0_scores(spark, stream, out, key="id", checkpoint=f"checkpoint-{run}")
    from credlake.operators import p0
    return scored.select("id", *p0.LABELS, "pct_riesgo", "prediccion_xgboost", "resultado_final", "flujo_estado")
