"""Registered LSH queries (parts A and B of the reference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.functions.lsh import LshModel
from credlake.operators import lsh
from credlake.operators.sampling import extract_sample, sample_cut
from credlake.plans.registry import query
from credlake.plans.sql_views import default_R, signature_sql, with_views
from credlake.sources import views
from credlake.sources.tables import read_table

FEATURES = views.FEATURES
HOLDOUT_FRACTION = 0.2


def signed_applications(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, LshModel]:
    apps = views.applications(spark, sf_dir)
    model = lsh.fit_lsh(apps, FEATURES)
    return model.transform(apps), model


# ---------------------------------------------------------------- oracle text
_Z = [f"(a.{c} - st.m{i})/st.s{i}" for i, c in enumerate(FEATURES)]
_STATS = ", ".join(f"avg({c}) as m{i}, stddev_samp({c}) as s{i}" for i, c in enumerate(FEATURES))
_SIGNED = f"""signed as (
  select a.*, {signature_sql(_Z, default_R())} as firma_lsh
  from applications a, (select {_STATS} from applications) st
)"""


def _signed_sql(body: str, extra_ctes: str = "") -> str:
    """``with <views>, signed as (...)[, extra] body``."""
    head = with_views(["applications"], "").rstrip()
    extra = f",\n{extra_ctes.strip()}" if extra_ctes else ""
    return f"{head},\n{_SIGNED}{extra}\n{body.strip()}"


_BUCKET_COLS = """firma_lsh, count(es_fraude) as total_solicitudes, cast(sum(es_fraude) as bigint) as fraudes_detectados,
  cast(sum(es_fraude) as double)/count(es_fraude)*100e0 as probabilidad_fraude_pct"""


# ---------------------------------------------------------------- queries
@query("lsh_top_risk_buckets", _signed_sql(f"""
select {_BUCKET_COLS} from signed group by firma_lsh having sum(es_fraude) > 0
order by probabilidad_fraude_pct desc, total_solicitudes desc, firma_lsh limit 5"""))
def lsh_top_risk_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 core: A17 -> F1 -> F2 -> A1 -> T1 ("which behaviour buckets are riskiest?")."""
    signed, _ = signed_applications(spark, sf_dir)
    return lsh.top_risk_buckets(lsh.bucket_stats(signed), k=5)


@query("lsh_bucket_stats", _signed_sql(f"select {_BUCKET_COLS} from signed group by firma_lsh"))
def lsh_bucket_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 over every bucket."""
    signed, _ = signed_applications(spark, sf_dir)
    return lsh.bucket_stats(signed)


@query("lsh_signatures", _signed_sql("select id, firma_lsh from signed"))
def lsh_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + F2 for every application."""
    signed, _ = signed_applications(spark, sf_dir)
    return signed.select("id", "firma_lsh")


@query("lsh_totals", _signed_sql(
    "select count(*) as total_filas, count(distinct firma_lsh) as total_baldes from signed"))
def lsh_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows processed and distinct buckets in one job."""
    signed, _ = signed_applications(spark, sf_dir)
    return lsh.totals(signed)


# Mean and std depend on summation order in their last bits; both sides
# report them rounded half-even to 6 decimals.
_SCALER_SQL = with_views(["applications"], " union all ".join(
    f"select '{c}' as feature, {i} as pos, round_even(avg({c}), 6) as mean, "
    f"round_even(stddev_samp({c}), 6) as scale from applications"
    for i, c in enumerate(FEATURES)))


@query("lsh_scaler", _SCALER_SQL)
def lsh_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted scaler (mean, sample std) as a small table."""
    apps = views.applications(spark, sf_dir)
    aggs = []
    for i, c in enumerate(FEATURES):
        aggs.append(F.struct(F.lit(c).alias("feature"), F.lit(i).alias("pos"),
                             F.avg(F.col(c).cast("double")).alias("mean"),
                             F.stddev_samp(F.col(c).cast("double")).alias("scale")))
    r6 = lambda c: F.rint(F.col(c) * 1e6) / 1e6
    return apps.agg(F.array(*aggs).alias("a")).select(F.inline("a")).select(
        "feature", "pos", r6("mean").alias("mean"), r6("scale").alias("scale"))


_CUT = sample_cut(HOLDOUT_FRACTION)
_H = "((id % 1000003) * 2654435761 + 42) % 1000003"
# The model is fitted on the history only (the held-out applications are new).
_SIGNED_HISTORY_FIT = f"""signed as (
  select a.*, {signature_sql(_Z, default_R())} as firma_lsh
  from applications a, (select {_STATS} from applications where {_H} >= {_CUT}) st
)"""
_HOLDOUT_SQL = with_views(["applications"], """
select id, firma_lsh, total_balde, fraudes_balde,
  case when encontrado then pct_fraude end as pct_fraude,
  case when not encontrado then 'REVISION' when pct_fraude >= 50 then 'RECHAZADA'
       when pct_fraude >= 2 then 'REVISION_EXHAUSTIVA' else 'APROBADA' end as decision
from scored""", f"""{_SIGNED_HISTORY_FIT},
hist as (
  select firma_lsh, count(*) as total_balde, cast(coalesce(sum(es_fraude), 0) as bigint) as fraudes_balde
  from signed where {_H} >= {_CUT} group by firma_lsh
), scored as (
  select s.id, s.firma_lsh, h.total_balde, h.fraudes_balde,
    case when h.total_balde > 0 then h.fraudes_balde/h.total_balde*100e0 else 0e0 end as pct_fraude,
    h.firma_lsh is not null as encontrado
  from signed s left join hist h on s.firma_lsh = h.firma_lsh
  where {_H} < {_CUT}
)""")


@query("lsh_score_holdout", _HOLDOUT_SQL)
def lsh_score_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 + A2 + J1 + F11: hold out 20 % of applications, score them against
    the bucket history of the other 80 % (misses become REVISION)."""
    apps = views.applications(spark, sf_dir)
    new, history = extract_sample(apps, HOLDOUT_FRACTION)
    model = lsh.fit_lsh(history, FEATURES)        # fitted on the history, as the saved model is
    stats = lsh.bucket_history(model.transform(history))
    scored = lsh.score_against_history(new, model, stats)
    return scored.select(
        "id", "firma_lsh", "total_balde", "fraudes_balde",
        F.when(F.col("encontrado"), F.col("pct_fraude")).alias("pct_fraude"), "decision")


# ---------------------------------------------------------------- embeddings variant
EMB_BITS = 8
EMB_DIMS = 64
EMB_TARGET = 0


def _emb_signature_sql() -> str:
    from credlake.plans.sql_views import dbl
    from credlake.functions.lsh import projection_matrix
    bits = []
    for row in projection_matrix(EMB_BITS, EMB_DIMS):
        dot = " + ".join(f"embedding[{j + 1}]*{dbl(w)}" for j, w in enumerate(row))
        bits.append(f"case when {dot} >= 0 then '1' else '0' end")
    return "concat(" + ", ".join(bits) + ")"


@query("lsh_embedding_buckets", f"""
with signed as (
  select vec_id, {_emb_signature_sql()} as firma_lsh, case when label = {EMB_TARGET} then 1 else 0 end as target
  from embeddings
)
select firma_lsh, count(target) as total_solicitudes, cast(sum(target) as bigint) as fraudes_detectados,
  cast(sum(target) as double)/count(target)*100e0 as probabilidad_fraude_pct
from signed group by firma_lsh""")
def lsh_embedding_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 + A1 over 64-dim float embeddings: 8 planes, target class share per bucket."""
    from credlake.functions.lsh import projection_matrix, signature_from_array
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    signed = e.select(
        signature_from_array(F.col("embedding"), projection_matrix(EMB_BITS, EMB_DIMS)).alias("firma_lsh"),
        F.when(F.col("label") == EMB_TARGET, 1).otherwise(0).alias("target"))
    return lsh.bucket_stats(signed, label="target")


RUN, RUN_AT = "holdout", "2024-01-01 00:00:00"  # what the registered run is called, and when it takes place


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    apps = views.applications(spark, sf_dir)
    new, history = extract_sample(apps, HOLDOUT_FRACTION)
    model = lsh.fit_lsh(history, FEATURES)
    scored = lsh.score_against_history(new, model, lsh.bucket_history(model.transform(history)))
    return lsh.evaluation_documents(scored, FEATURES, RUN, F.to_timestamp(F.lit(RUN_AT)))


def _filled(template: str) -> str:
    """A reason template as an SQL ``printf`` of the percentage."""
    return "printf('" + template.replace("%", "%%").replace("{pct}", "%.2f") + "', pct_fraude)"


_HEX = f"sha256('{RUN}|' || id)"
_TEXTS_SQL = f"""firma_lsh, total_balde, fraudes_balde, case when total_balde is not null then printf('%.2f%%', pct_fraude) end as probabilidad_historial,
  case when total_balde is null then '{lsh.PCT_UNKNOWN}' end as probabilidad_fraude, decision,
  case when total_balde is null then '{lsh.REASON_MISS}' when pct_fraude >= {lsh.RATE_REJECT}e0 then {_filled(lsh.REASON_REJECT)}
       when pct_fraude >= {lsh.RATE_REVIEW}e0 then {_filled(lsh.REASON_REVIEW)} else {_filled(lsh.REASON_APPROVE)} end as razon"""


def _texts() -> list:
    return ["firma_lsh", "historial.total_balde", "historial.fraudes_balde", F.col("historial.probabilidad_fraude").alias("probabilidad_historial"),
            "probabilidad_fraude", "decision", "razon"]


@query("lsh_evaluation_reports", with_views(["applications"], f"""
select id, substr({_HEX}, 1, 8) || '-' || substr({_HEX}, 9, 4) || '-' || substr({_HEX}, 13, 4) || '-' || substr({_HEX}, 17, 4) || '-' || substr({_HEX}, 21, 12) as id_solicitud,
  '{RUN_AT}' as fecha, {", ".join(FEATURES)}, {_TEXTS_SQL}
from ({_HOLDOUT_SQL}) scored join (select id, {", ".join(FEATURES)} from applications) asked using (id)"""))
def lsh_evaluation_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12 + F21 (+ K4 shape): one evaluation report per held-out application, with
    request id, time, reason text and the history (NULL on a miss), its structs spread out."""
    return _reports(spark, sf_dir).select("id", "id_solicitud", F.col("fecha").cast("string").alias("fecha"), "datos_cliente.*", *_texts())


@query("lsh_evaluation_texts", f"select id, {_TEXTS_SQL} from ({_HOLDOUT_SQL}) scored")
def lsh_evaluation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12's texts: the evaluation reports without their ids and times."""
    return _reports(spark, sf_dir).select("id", *_texts())


@query("lsh_embedding_top_buckets", f"""
with signed as (
  select vec_id, {_emb_signature_sql()} as firma_lsh, case when label = {EMB_TARGET} then 1 else 0 end as target
  from embeddings
)
select firma_lsh, count(target) as total_solicitudes, cast(sum(target) as bigint) as fraudes_detectados,
  cast(sum(target) as double)/count(target)*100e0 as probabilidad_fraude_pct
from signed group by firma_lsh having sum(target) > 0
order by probabilidad_fraude_pct desc, total_solicitudes desc, firma_lsh limit 5""")
def lsh_embedding_top_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 on the embeddings variant: the five buckets richest in the target class."""
    return lsh.top_risk_buckets(lsh_embedding_buckets(spark, sf_dir), k=5)
