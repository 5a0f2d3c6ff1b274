"""LSH bucket operators.

Scale notes
-----------
* ``fit_scaler`` is one global aggregate (partial aggregation in every task,
  one row to the driver: a mean and a std per feature).
* ``bucket_stats`` groups on the signature.  A hot bucket holding a third
  of all rows costs nothing extra: the partial hash aggregate collapses it
  to one row per task before the shuffle.
* ``lookup_bucket`` broadcasts the bucket table only when its row count has
  a proven bound: K hyperplanes through the origin cut d-dimensional space
  into at most ``2 * sum(C(K-1, i), i < d)`` cells (Cover, 1965), i.e.
  3 882 cells for K = 16, d = 5.  Above the threshold Spark keeps its own
  join choice (sort-merge, with AQE skew handling).
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlake.functions.lsh import DEFAULT_BITS, DEFAULT_SEED, LshModel, projection_matrix
from credlake.functions.scoring import request_id
from credlake.functions.text import fill, fixed2

# Hint a broadcast of the bucket table only where the most buckets there can be, at
# about 128 bytes each in memory, stay within 16 MB; else Spark picks the join.
MAX_BROADCAST_BUCKETS = (16 << 20) // 128

# Fixed values of the reference decision rule.
RATE_REJECT = 50.0
RATE_REVIEW = 2.0
DECISION_MISS = "REVISION"
DECISION_REJECT = "RECHAZADA"
DECISION_REVIEW = "REVISION_EXHAUSTIVA"
DECISION_APPROVE = "APROBADA"
REASON_MISS = "Balde sin historial. Riesgo desconocido."
PCT_UNKNOWN = "Desconocida"
REASON_REJECT = "Alta probabilidad de fraude ({pct}%) en su segmento."
REASON_REVIEW = "Riesgo moderado de fraude detectado ({pct}%)."
REASON_APPROVE = "Bajo riesgo de fraude ({pct}%). Comportamiento confiable."


def max_cells(bits: int, dims: int) -> int:
    """Upper bound on non-empty buckets of ``bits`` centred hyperplanes in ``dims`` dimensions."""
    return min(2**bits, 2 * sum(comb(bits - 1, i) for i in range(dims)))


def fit_scaler(df: DataFrame, features: list[str]) -> tuple[list[float], list[float]]:
    """Mean and sample standard deviation per feature, in one job."""
    aggs = []
    for c in features:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"), F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    mean = [float(row[f"m_{c}"]) for c in features]
    # A zero or undefined spread would divide by zero; use 1 as the scaler does.
    std = [float(row[f"s_{c}"]) if row[f"s_{c}"] else 1.0 for c in features]
    return mean, std


def fit_lsh(df: DataFrame, features: list[str], bits: int = DEFAULT_BITS, seed: int = DEFAULT_SEED) -> LshModel:
    mean, std = fit_scaler(df, features)
    return LshModel(list(features), mean, std, projection_matrix(bits, len(features), seed))


def bucket_stats(signed: DataFrame, sig: str = "firma_lsh", label: str = "es_fraude") -> DataFrame:
    """A1: per bucket ``count(label)`` (non-null only), ``sum(label)`` and the rate in %."""
    agg = signed.groupBy(sig).agg(
        F.count(label).alias("total_solicitudes"),
        F.sum(F.col(label).cast("long")).alias("fraudes_detectados"),
    )
    return agg.withColumn(
        "probabilidad_fraude_pct",
        F.try_divide(F.col("fraudes_detectados").cast("double"), F.col("total_solicitudes")) * 100.0,
    )


def top_risk_buckets(stats: DataFrame, k: int = 5, sig: str = "firma_lsh") -> DataFrame:
    """Buckets with fraud, highest rate first; ties by size then signature."""
    return (
        stats.where(F.col("fraudes_detectados") > 0)
        .orderBy(F.desc("probabilidad_fraude_pct"), F.desc("total_solicitudes"), F.asc(sig))
        .limit(k)
    )


def totals(signed: DataFrame, sig: str = "firma_lsh") -> DataFrame:
    """Rows processed and distinct buckets, in one job."""
    return signed.agg(F.count(F.lit(1)).alias("total_filas"), F.count_distinct(sig).alias("total_baldes"))


def bucket_history(history: DataFrame, signatures: list[str] | None = None, sig: str = "firma_lsh",
                   label: str = "es_fraude") -> DataFrame:
    """A2: match (optional keyed lookup, P12) then group; counts rows, not flags."""
    if signatures is not None:
        history = history.where(F.col(sig).isin(list(signatures)))
    agg = history.groupBy(sig).agg(
        F.count(F.lit(1)).alias("total_balde"),
        F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0).cast("long")).alias("fraudes_balde"),
    )
    pct = F.when(F.col("total_balde") > 0, F.col("fraudes_balde") / F.col("total_balde") * 100.0).otherwise(F.lit(0.0))
    return agg.withColumn("pct_fraude", pct)


def lookup_bucket(apps: DataFrame, history_stats: DataFrame, bits: int = DEFAULT_BITS, dims: int = 5,
                  sig: str = "firma_lsh") -> DataFrame:
    """Left outer equi-join on the signature; a miss keeps the row."""
    right = history_stats
    if max_cells(bits, dims) <= MAX_BROADCAST_BUCKETS:
        right = F.broadcast(history_stats)
    return apps.join(right, sig, "left")


def lsh_decision(pct: Column, found: Column) -> Column:
    """miss -> REVISION; >= 50 reject; >= 2 exhaustive review; else approve."""
    return (
        F.when(~found, F.lit(DECISION_MISS))
        .when(pct >= RATE_REJECT, F.lit(DECISION_REJECT))
        .when(pct >= RATE_REVIEW, F.lit(DECISION_REVIEW))
        .otherwise(F.lit(DECISION_APPROVE))
    )


def _two_decimals(pct: Column) -> Column:
    """``%.2f`` text as Python writes it (exact half-even rounding)."""
    return fixed2(pct)


def pct_text(pct: Column) -> Column:
    """``"xx.xx%"``."""
    return F.concat(_two_decimals(pct), F.lit("%"))


def lsh_reason(pct: Column, found: Column) -> Column:
    """the reason text that goes with ``lsh_decision``."""
    p = _two_decimals(pct)
    return (
        F.when(~found, F.lit(REASON_MISS))
        .when(pct >= RATE_REJECT, fill(REASON_REJECT, pct=p))
        .when(pct >= RATE_REVIEW, fill(REASON_REVIEW, pct=p))
        .otherwise(fill(REASON_APPROVE, pct=p))
    )


def score_against_history(apps: DataFrame, model: LshModel, history_stats: DataFrame,
                          features: list[str] | None = None) -> DataFrame:
    """B / X1 core: signature -> bucket lookup -> decision, for many applications at once."""
    signed = model.transform(apps)
    joined = lookup_bucket(signed, history_stats, bits=model.bits, dims=len(model.features))
    found = F.col("total_balde").isNotNull()
    return joined.withColumns({
        "encontrado": found,
        "decision": lsh_decision(F.col("pct_fraude"), found),
    })


def evaluation_documents(scored: DataFrame, features: list[str], run: str | None = None, at: Column | None = None) -> DataFrame:
    """Evaluation report rows (schema in FIXTURES.md 1.4).

    ``historial`` is NULL on a bucket miss; ``probabilidad_fraude`` is only
    set on a miss.  The report's id follows from ``run`` (a new one
    per call by default) and the application's id, and the time is ``at`` (by
    default when this is called), so a retried task or a second read of the
    result gives the same reports.
    """
    found = F.col("encontrado")
    hist = F.when(found, F.struct(
        F.col("total_balde"), F.col("fraudes_balde"), pct_text(F.col("pct_fraude")).alias("probabilidad_fraude")))
    return scored.select(
        F.col("id"),
        request_id(run or uuid.uuid4().hex, F.col("id")).alias("id_solicitud"),
        (F.lit(datetime.now(timezone.utc)) if at is None else at).alias("fecha"),
        F.struct(*[F.col(c) for c in features]).alias("datos_cliente"),
        F.col("firma_lsh"),
        hist.alias("historial"),
        F.when(~found, F.lit(PCT_UNKNOWN)).alias("probabilidad_fraude"),
        F.col("decision"),
        lsh_reason(F.col("pct_fraude"), found).alias("razon"),
    )
