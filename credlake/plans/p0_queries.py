"""Registered P0 scoring and insights queries (parts C and E)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.functions import labels as L
from credlake.functions.parsing import parse_decimal, parse_pct, valid_amount
from credlake.functions.scoring import affordability_pct, weighted_score
from credlake.operators import insights, p0
from credlake.operators.validate import validate_applications
from credlake.plans.registry import query
from credlake.functions.rounding import python_round_sql
from credlake.plans.sql_views import dbl, with_views
from credlake.sources import views
from credlake.sources.tables import read_table

# ----------------------------------------------------------------- Spark side


def scored_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 -> documents -> P3: the flat table the insights read."""
    scored, _ = p0.bulk_score(views.risk_input(spark, sf_dir))
    return p0.flatten_scored(p0.to_documents(scored))


# ----------------------------------------------------------------- oracle side
_VALID = ("ingreso_mensual > 0 and score_crediticio >= 300 and score_crediticio <= 850 and monto_solicitado > 0 "
          "and antiguedad_laboral_meses >= 0 and deuda_actual >= 0")
_LABEL_CTES = f"""
s1 as (
  select *, case when ingreso_mensual > 0 then deuda_actual/ingreso_mensual else 0e0 end as ratio_raw,
    cast(round_even(p_riesgo*100e0, 0) as int) as pct
  from risk_input where {_VALID}
), s2 as (
  select *, case when ratio_raw > 0.45e0 then 'Sobreendeudado' when ratio_raw > 0.30e0 then 'Ajustada' else 'Saludable' end as capacidad_pago,
    case when antiguedad_laboral_meses >= 12 then 'Alta' when antiguedad_laboral_meses >= 6 then 'Media' else 'Inestable' end as estabilidad_laboral
  from s1
), s3 as (
  select *, case when estabilidad_laboral = 'Alta' and capacidad_pago = 'Saludable' then 'Consolidado'
      when estabilidad_laboral in ('Alta', 'Media') and capacidad_pago <> 'Sobreendeudado' then 'Estable'
      when capacidad_pago = 'Sobreendeudado' then 'Critico' else 'Vulnerable' end as score_estabilidad_financiera
  from s2
), scored as (
  select *, case score_estabilidad_financiera when 'Critico' then 'Mal prospecto'
      when 'Consolidado' then 'Prospecto consolidado' else 'Prospecto indefinido' end as decision_preliminar,
    {python_round_sql("ratio_raw", 2)} as ratio_endeudamiento_actual,
    concat(cast(pct as varchar), '%') as prediccion_xgboost,
    case when pct >= 40 then 'RECHAZADO' else 'APROBADO' end as resultado_final,
    cast(pct as double) as pct_riesgo, pct < 40 as is_aprobado
  from s3
)"""


def _p0_sql(body: str, extra: str = "") -> str:
    head = with_views(["risk_input"], "").rstrip()
    more = f",\n{extra.strip()}" if extra else ""
    return f"{head},{_LABEL_CTES}{more}\n{body.strip()}"


def _money(expr: str) -> str:
    return f"coalesce(sum(cast({expr} as decimal(38,6))), cast(0 as decimal(38,6)))"


def _cnt(cond: str) -> str:
    return f"cast(coalesce(sum(case when {cond} then 1 else 0 end), 0) as bigint)"


def _values(rows: list[tuple]) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, float):
            return "1e308" if v == float("inf") else dbl(v)
        return str(v)
    return "(values " + ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows) + ")"


# ----------------------------------------------------------------- P0 queries
_VALIDATE_SQL = with_views(["applications"], """
select id, reasons = '' as es_valida, reasons as motivos from (
  select id, concat_ws('; ',
    case when not coalesce(ingreso_mensual > 0, false) then 'ingreso_mensual must be > 0' end,
    case when not coalesce(score_crediticio >= 300 and score_crediticio <= 850, false) then 'score_crediticio must be in [300, 850]' end,
    case when not coalesce(monto_solicitado > 0, false) then 'monto_solicitado must be > 0' end,
    case when not coalesce(antiguedad_laboral_meses >= 0, false) then 'antiguedad_laboral_meses must be an integer >= 0' end,
    case when not coalesce(deuda_actual >= 0, false) then 'deuda_actual must be >= 0' end) as reasons
  from applications) t""")


@query("p0_validate", _VALIDATE_SQL)
def p0_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every application with its validity and the reasons it fails."""
    v = validate_applications(views.applications(spark, sf_dir))
    return v.select("id", "es_valida", F.array_join("motivos", "; ").alias("motivos"))


@query("p0_labels", _p0_sql("""
select id, ratio_endeudamiento_actual, capacidad_pago, estabilidad_laboral, score_estabilidad_financiera,
  decision_preliminar from scored"""))
def p0_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3-F7 on the valid applications."""
    valid, _ = p0.split_valid(views.applications(spark, sf_dir))
    return p0.label_applications(valid).select("id", *p0.LABELS)


@query("p0_bulk_scoring", _p0_sql("""
select id, ratio_endeudamiento_actual, capacidad_pago, estabilidad_laboral, score_estabilidad_financiera,
  decision_preliminar, pct as pct_riesgo, prediccion_xgboost, resultado_final, 'p0_completado' as flujo_estado
from scored"""))
def p0_bulk_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: P7 -> F3-F7 -> risk (closed-form stand-in for M3) -> F8 -> F9."""
    scored, _ = p0.bulk_score(views.risk_input(spark, sf_dir))
    return scored.select("id", *p0.LABELS, "pct_riesgo", "prediccion_xgboost", "resultado_final", "flujo_estado")


@query("p0_latest", _p0_sql("""
select cast(id as varchar) as _id, id, resultado_final from scored order by id desc limit 10000"""))
def p0_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 10 000 scored documents (the listing default)."""
    scored, _ = p0.bulk_score(views.risk_input(spark, sf_dir))
    docs = p0.to_documents(scored).withColumn("id", F.col("_id").cast("long"))
    return p0.latest(docs, 10000).select("_id", "id", "resultado_final")


# Form-like texts derived from order rows: percents, comma decimals, junk.
def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    s = lambda x: x.cast("string")
    txt = (F.when(k % 8 == 0, F.concat(s(k % 100), F.lit("%")))
           .when(k % 8 == 1, F.concat(F.lit(" "), s(c % 100), F.lit(" %")))
           .when(k % 8 == 2, F.concat(s(k % 1000), F.lit(","), s(c % 10)))
           .when(k % 8 == 3, F.lit("abc"))
           .when(k % 8 == 4, F.lit(""))
           .when(k % 8 == 5, F.concat(s(k % 10), F.lit(","), s(c % 10), F.lit(",2")))
           .when(k % 8 == 6, F.concat(F.lit("-"), s(c % 50))))
    return o.select(k.alias("id"), txt.alias("txt"))


_TEXTS_SQL = """texts as (
  select o_orderkey as id, case o_orderkey % 8
    when 0 then concat(cast(o_orderkey % 100 as varchar), '%')
    when 1 then concat(' ', cast(o_custkey % 100 as varchar), ' %')
    when 2 then concat(cast(o_orderkey % 1000 as varchar), ',', cast(o_custkey % 10 as varchar))
    when 3 then 'abc' when 4 then ''
    when 5 then concat(cast(o_orderkey % 10 as varchar), ',', cast(o_custkey % 10 as varchar), ',2')
    when 6 then concat('-', cast(o_custkey % 50 as varchar)) end as txt
  from orders
)"""
_NUM_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_LEAD_RE = r"^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)"
_PARSE_SQL = f"""with {_TEXTS_SQL}, t2 as (
  select id, txt, trim(replace(txt, '%', '')) as stripped,
    regexp_replace(regexp_replace(txt, '^([^,]*),', '\\1.'), '^\\s+|\\s+$', '', 'g') as dec
  from texts
), t3 as (
  select *, case when regexp_matches(stripped, '^[+-]?[0-9]+$') then try_cast(stripped as bigint) end as n,
    case when dec = '' then 0e0 when regexp_matches(dec, '{_NUM_RE}') then try_cast(dec as double) end as decimal_value
  from t2
)
select id, txt,
  case when n >= 40 then 'RECHAZADO' when n is not null then 'APROBADO'
       when txt is null then 'ERROR_EVALUACION: ''NoneType'' object has no attribute ''replace'''
       else concat('ERROR_EVALUACION: invalid literal for int() with base 10: ''', stripped, '''') end as resultado,
  case when txt is null then 0e0
       else try_cast(regexp_extract(regexp_replace(txt, '^([^%]*)%', '\\1'), '{_LEAD_RE}', 1) as double) end as pct,
  decimal_value,
  coalesce(decimal_value >= 0, false) as valido
from t3"""


@query("p0_text_parsing", _PARSE_SQL)
def p0_text_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 approval from a percent text, F10 dashboard percent, F18 form decimal."""
    t = _texts(spark, sf_dir)
    dec = parse_decimal(F.col("txt"))
    return t.select("id", "txt", L.approval(F.col("txt")).alias("resultado"),
                    parse_pct(F.col("txt")).alias("pct"), dec.alias("decimal_value"),
                    valid_amount(dec).alias("valido"))


@query("p0_decision_labels", _p0_sql("""
select id, resultado_final,
  case resultado_final when 'APROBADO' then 'Aprobada' when 'RECHAZADO' then 'Rechazada'
       when 'ERROR_EVALUACION' then 'Error de evaluación' else 'Pendiente' end as etiqueta_decision,
  case resultado_final when 'APROBADO' then 'Confiable' when 'RECHAZADO' then 'Moroso'
       else 'Comportamiento crediticio variable' end as etiqueta_modelo
from scored"""))
def p0_decision_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """display label and model label per decision code."""
    scored, _ = p0.bulk_score(views.risk_input(spark, sf_dir))
    code = F.col("resultado_final")
    return scored.select("id", code, L.decision_label(code).alias("etiqueta_decision"),
                         L.model_label(code).alias("etiqueta_modelo"))


@query("p0_affordability", with_views(["applications"], """
select id, case when greatest(ingreso_mensual, 0e0) > 0 then
  (case when deuda_actual >= 0 then deuda_actual else 0e0 end + case when monto_solicitado >= 0 then monto_solicitado else 0e0 end)
  / ingreso_mensual * 100e0 else 0e0 end as carga_pct
from applications"""))
def p0_affordability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(debt + amount) / income in %."""
    a = views.applications(spark, sf_dir)
    return a.select("id", affordability_pct(F.col("ingreso_mensual"), F.col("deuda_actual"),
                                            F.col("monto_solicitado")).alias("carga_pct"))


SCORE_WEIGHTS = {"score_crediticio": 0.1, "antiguedad_laboral_meses": 0.2, "es_fraude": -50.0}


@query("p0_weighted_score", with_views(["applications"], f"""
select id, least(greatest(0e0 + coalesce(score_crediticio*{dbl(0.1)}, 0e0) + coalesce(antiguedad_laboral_meses*{dbl(0.2)}, 0e0)
  + coalesce(es_fraude*{dbl(-50.0)}, 0e0), 0e0), 100e0) as score
from applications"""))
def p0_weighted_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """weighted sum of present factors, clamped to [0, 100]."""
    a = views.applications(spark, sf_dir)
    return a.select("id", weighted_score(SCORE_WEIGHTS).alias("score"))


# ----------------------------------------------------------------- insights
@query("insights_kpis", _p0_sql(f"""
select count(*) as n_solicitudes, {_cnt('is_aprobado')} as n_aprobadas, {_cnt('not is_aprobado')} as n_rechazadas,
  case when count(*) > 0 then {_cnt('is_aprobado')}/count(*)*100e0 else 0e0 end as tasa_aprobacion,
  coalesce(avg(case when is_aprobado then pct_riesgo end), 0e0) as riesgo_prom_aprobadas,
  coalesce(avg(case when not is_aprobado then pct_riesgo end), 0e0) as riesgo_prom_rechazadas,
  {_money('case when is_aprobado then monto_solicitado end')} as monto_aprobado,
  {_money('case when not is_aprobado then monto_solicitado end')} as monto_rechazado,
  {_money('case when not is_aprobado then monto_solicitado * (pct_riesgo / 100e0) end')} as monto_evitado
from scored"""))
def insights_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3."""
    return insights.kpis(scored_flat(spark, sf_dir))


def _band_sql(bands, col):
    spine = _values([(i, lab, lo, hi) for i, (lab, lo, hi) in enumerate(bands)])
    return _p0_sql(f"""
select b.orden, b.rango, {_cnt('s.id is not null and s.is_aprobado')} as aprobadas,
  {_cnt('s.id is not null and not s.is_aprobado')} as rechazadas
from {spine} b(orden, rango, lo, hi)
left join scored s on s.{col} >= b.lo and s.{col} < b.hi
group by b.orden, b.rango""")


@query("insights_income_bands", _band_sql(insights.INCOME_BANDS, "ingreso_mensual"))
def insights_income_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 by income band."""
    return insights.segment_distribution(scored_flat(spark, sf_dir), "ingreso")


@query("insights_score_bands", _band_sql(insights.SCORE_BANDS, "score_crediticio"))
def insights_score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 by score band."""
    return insights.segment_distribution(scored_flat(spark, sf_dir), "score")


@query("insights_risk_histogram", _p0_sql(f"""
select cast(b.lo as int) as lo, concat(cast(b.lo as varchar), '-', cast(b.lo + 10 as varchar), '%') as rango,
  {_cnt('s.id is not null')} as cantidad
from (select unnest(range(0, 100, 10)) as lo) b
left join scored s on s.pct_riesgo >= b.lo and s.pct_riesgo < b.lo + 10
group by b.lo"""))
def insights_risk_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 (a risk of 100 % lands in no bin, as in the dashboard)."""
    return insights.risk_histogram(scored_flat(spark, sf_dir))


_HEAT_SPINE = _values([(e, c) for e in insights.JOB_ORDER for c in insights.CAPACITY_ORDER])


@query("insights_heatmap", _p0_sql(f"""
select estabilidad_laboral, capacidad_pago, n, tasa_rechazo,
  case when tasa_rechazo is null then null when tasa_rechazo >= 66 then 'alto'
       when tasa_rechazo >= 33 then 'medio' else 'bajo' end as nivel
from (
  select g.e as estabilidad_laboral, g.c as capacidad_pago, count(s.id) as n,
    case when count(s.id) > 0 then {_cnt('s.id is not null and not s.is_aprobado')}/count(s.id)*100e0 end as tasa_rechazo
  from {_HEAT_SPINE} g(e, c)
  left join scored s on s.estabilidad_laboral = g.e and s.capacidad_pago = g.c
  group by g.e, g.c) t"""))
def insights_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6."""
    return insights.rejection_heatmap(scored_flat(spark, sf_dir))


@query("insights_preliminary_vs_final", _p0_sql(f"""
select g.orden, g.decision, {_cnt('s.id is not null and s.is_aprobado')} as aprobadas,
  {_cnt('s.id is not null and not s.is_aprobado')} as rechazadas
from {_values(list(enumerate(insights.PRELIM_ORDER)))} g(orden, decision)
left join scored s on s.decision_preliminar = g.decision
group by g.orden, g.decision"""))
def insights_preliminary_vs_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7."""
    return insights.preliminary_vs_final(scored_flat(spark, sf_dir))


@query("insights_discrepancies", _p0_sql(f"""
select {_cnt("(decision_preliminar = 'Prospecto consolidado' and not is_aprobado) or (decision_preliminar = 'Mal prospecto' and is_aprobado)")}
  as discrepancias from scored"""))
def insights_discrepancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8."""
    return insights.discrepancies(scored_flat(spark, sf_dir))


@query("insights_avoided_loss", _p0_sql(f"""
select g.orden, g.categoria, {_money('s.monto_solicitado * (s.pct_riesgo / 100e0)')} as evitado,
  count(s.id) as n
from {_values(list(enumerate(insights.FIN_ORDER)))} g(orden, categoria)
left join scored s on s.score_estabilidad_financiera = g.categoria and not s.is_aprobado
group by g.orden, g.categoria"""))
def insights_avoided_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9."""
    return insights.avoided_loss_by_stability(scored_flat(spark, sf_dir))


# P3 with the drift seen in stored documents: wrapped documents, a missing
# final result, and a model output that is not a percent.
def _drifted_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = p0.bulk_score(views.risk_input(spark, sf_dir))
    k = F.col("id")
    drifted = scored.withColumns({
        "resultado_final": F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("resultado_final")),
        "prediccion_xgboost": F.when(k % 13 == 0, F.lit("Alto_Potencial (Prob: 1.0)"))
                               .otherwise(F.col("prediccion_xgboost")),
    })
    docs = p0.to_documents(drifted)
    doc = F.struct(*[F.col(c) for c in docs.columns])
    wrap = F.col("_id").cast("long") % 7 == 0
    return docs.select(
        F.when(wrap, doc).alias("documento"),
        *[F.when(~wrap, F.col(c)).alias(c) for c in docs.columns if c != "_id"],
        F.col("_id"),
    )


@query("insights_flatten", _p0_sql("""
select cast(id as varchar) as id, ingreso_mensual, score_crediticio, monto_solicitado,
  cast(antiguedad_laboral_meses as double) as antiguedad_laboral_meses, deuda_actual, ratio_endeudamiento_actual,
  capacidad_pago, estabilidad_laboral, score_estabilidad_financiera, decision_preliminar,
  case when id % 13 = 0 then null else pct_riesgo end as pct_riesgo,
  case when id % 11 = 0 then false else is_aprobado end as is_aprobado
from scored"""))
def insights_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 over drifted documents (wrapper, missing result, non-percent output)."""
    return p0.flatten_scored(_drifted_docs(spark, sf_dir))


@query("insights_flatten_json", _p0_sql("""
select cast(id as varchar) as id, ingreso_mensual, score_crediticio,
  case when id % 17 = 4 then 0e0 else monto_solicitado end as monto_solicitado,
  cast(antiguedad_laboral_meses as double) as antiguedad_laboral_meses, deuda_actual, ratio_endeudamiento_actual,
  capacidad_pago, case when id % 19 = 5 then 'Sin dato' else estabilidad_laboral end as estabilidad_laboral,
  score_estabilidad_financiera, decision_preliminar,
  case when id % 13 = 0 then null when id % 13 = 1 then 0e0 else pct_riesgo end as pct_riesgo,
  case when id % 11 = 0 then false else is_aprobado end as is_aprobado
from scored where id % 23 <> 7"""))
def insights_flatten_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 over JSON texts of all stored shapes: wrapped or bare, numbers as
    numbers or texts, the risk as a percentage, a label, a number or under
    another key, results and labels missing, texts cut short."""
    return p0.flatten_json(_json_docs(spark, sf_dir), "value")


def _json_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = p0.bulk_score(views.risk_input(spark, sf_dir))
    k = F.col("id")
    none = F.lit(None).cast("string")
    drifted = scored.withColumn("resultado_final", F.when(k % 11 == 0, none).otherwise(F.col("resultado_final")))
    drifted = drifted.withColumn("estabilidad_laboral", F.when(k % 19 == 5, none).otherwise(F.col("estabilidad_laboral")))
    drifted = drifted.withColumn("prediccion_xgboost", F.when(k % 13 == 0, F.lit("Alto_Potencial (Prob: 1.0)")).otherwise(F.col("prediccion_xgboost")))
    text = F.to_json(F.struct(*[F.col(c) for c in p0.to_documents(drifted).columns]))
    docs = p0.to_documents(drifted).select(F.col("_id").cast("long").alias("k"), text.alias("t"))
    k, t = F.col("k"), F.col("t")
    shapes = [
        (k % 13 == 1, F.regexp_replace(t, '"prediccion_xgboost":', '"prediccion_xgboost%riesgo":')),
        (k % 13 == 2, F.regexp_replace(t, '"prediccion_xgboost":"([0-9]+)%"', '"prediccion_xgboost":$1')),
        (k % 5 == 3, F.regexp_replace(t, '"(deuda_actual|ingreso_mensual|ratio_endeudamiento_actual)":([-0-9.E]+)', '"$1":"$2"')),
        (k % 17 == 4, F.regexp_replace(t, '"monto_solicitado":[-0-9.E]+', '"monto_solicitado":null')),
        (k % 7 == 0, F.concat(F.lit('{"documento":'), t, F.lit("}"))),
        (k % 23 == 7, F.substring(t, 1, 40))]
    for cond, changed in shapes:
        docs = docs.withColumn("t", F.when(cond, changed).otherwise(t))
    return docs.select(t.alias("value"))


# F13 on closed-form class probabilities (binomial split of the stand-in
# risk): p0 = (1-p)^2, p1 = 2p(1-p), p2 = p^2, so they sum to 1 and the
# threshold labels are checkable by SQL.
@query("p0_client_labels", with_views(["risk_input"], """
select id, round_even(p0, 4) as p_confiable, round_even(p1, 4) as p_variable, round_even(p2, 4) as p_moroso,
  case when p0 >= 0.7e0 then 'Confiable' when p2 >= 0.7e0 then 'Moroso'
       else 'Comportamiento crediticio variable' end as etiqueta,
  case when p0 >= 0.7e0 then 'Aprobar solicitud. Cliente de bajo riesgo.'
       when p2 >= 0.7e0 then 'Rechazar solicitud. Alto riesgo de no pago.'
       else 'Revisar manualmente. Considerar garantías adicionales.' end as recomendacion
from (select id, (1e0 - p_riesgo) * (1e0 - p_riesgo) as p0, 2e0 * p_riesgo * (1e0 - p_riesgo) as p1,
             p_riesgo * p_riesgo as p2 from risk_input) t"""))
def p0_client_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F13 + F14 texts: threshold label and recommendation per client."""
    r = views.risk_input(spark, sf_dir)
    p = F.col("p_riesgo")
    probs = r.select("id", ((F.lit(1.0) - p) * (F.lit(1.0) - p)).alias("p0"),
                     (F.lit(2.0) * p * (F.lit(1.0) - p)).alias("p1"), (p * p).alias("p2"))
    lab = L.client_label(F.col("p0"), F.col("p2"))
    return probs.select("id", L.round_half_even(F.col("p0"), 4).alias("p_confiable"),
                        L.round_half_even(F.col("p1"), 4).alias("p_variable"),
                        L.round_half_even(F.col("p2"), 4).alias("p_moroso"),
                        lab.alias("etiqueta"), L.recommendation(lab).alias("recomendacion"))
