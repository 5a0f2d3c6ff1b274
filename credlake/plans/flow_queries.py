"""Registered rule-flow queries (part D)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.operators import flat_flow, flat_rules, flows, rules
from credlake.operators.requests import build_requests, titular
from credlake.plans.registry import query
from credlake.plans.sql_views import with_views
from credlake.sources import views


def nested_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_requests(views.requests(spark, sf_dir), views.request_applicants(spark, sf_dir))


def run_flow(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return flows.apply_flow(nested_requests(spark, sf_dir), flows.load_flows()[name])


# ------------------------------------------------------------------ oracle text
_BASE = """
pay as (select request_id, pos, count(*) as n, avg(net_income) as avg_inc,
              sum(cast(net_income as decimal(38,2))) as total from payslips group by request_id, pos),
app as (
  select a.request_id, a.pos, a.role, a.income_type, a.is_hard_debt,
    row_number() over (partition by a.request_id order by a.pos) - 1 as idx,
    case when a.income_type = 'DEPENDENT' then coalesce(p.avg_inc, 0e0) else 0e0 end as avg6,
    a.income_type = 'DEPENDENT' and coalesce(p.n, 0) > 0 as has_obs,
    case when a.income_type = 'DEPENDENT' then coalesce(p.total, cast(0 as decimal(38,2)))
         else cast(0 as decimal(38,2)) end as total,
    case when a.income_type = 'DEPENDENT' then cast(coalesce(p.n, 0) as int) else 0 end as npay
  from applicants a left join pay p on a.request_id = p.request_id and a.pos = p.pos
),
per_req as (
  select request_id, min(case when role = 'TITULAR' then pos end) as tpos,
    cast(sum(case when is_hard_debt then 1 else 0 end) as bigint) as nhard,
    cast(sum(case when has_obs then 1 else 0 end) as bigint) as nobs
  from app group by request_id
),
j as (
  select r.id, r.monthly_rent, pr.tpos, coalesce(pr.nhard, 0) as nhard, coalesce(pr.nobs, 0) as nobs,
    t.avg6 as tavg, t.idx as tidx, t.total as ttotal, t.npay as tpays
  from requests r left join per_req pr on r.id = pr.request_id
  left join app t on t.request_id = r.id and t.pos = pr.tpos
),
k as (
  select *, tpos is not null and tavg > 0 as branch,
    tpos is not null and tavg > 0 and tavg < monthly_rent * 3e0 as low,
    tpos is not null and tavg < monthly_rent * 3e0 as low6
  from j
)"""


def _flow_sql(body: str, extra: str = "") -> str:
    return with_views(["requests", "applicants", "payslips"], "\n" + body.strip(),
                      _BASE + ("," + extra if extra else ""))


_P0_SQL = _flow_sql("""
select cast(id as varchar) as id,
  case when branch and nhard = 0 and not low then 'APPROVED' else 'REJECTED' end as final_decision_code,
  case when branch then concat_ws(',', nullif(rtrim(repeat('RL_DICOM_HARD,', cast(nhard as int)), ','), ''),
                                  case when low then 'RL_RENTA_INSUFICIENTE' end)
       when tpos is null then 'RL_NO_TITULAR' else 'RL_SIN_INGRESOS' end as blocking_rule_codes,
  case when tpos is null then null when branch and not low then 'APPROVED' else 'PENDING' end as titular_income_code,
  ttotal as titular_income_total, tpays as titular_payslips,
  cast(nobs + case when branch then nhard + case when low then 1 else 0 end else 1 end as int) as n_observations,
  case when branch then 3 else 2 end as n_trail
from k""")


@query("flow_p0_decisions", _P0_SQL)
def flow_p0_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 through the generic runner (R10) over nested requests."""
    return flows.decision_summary(run_flow(spark, sf_dir, "p0"))


@query("flow_p0_flat", _P0_SQL)
def flow_p0_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 on flat tables (aggregates only; the scale path)."""
    return flat_rules.p0_flat(views.requests(spark, sf_dir), views.applicant_income(spark, sf_dir))


_FLOW6_SQL = _flow_sql("""
select cast(id as varchar) as id,
  case when tpos is null or low6 then 'REJECTED' else 'APPROVED' end as final_decision_code,
  case when tpos is null then 'RL_NO_TITULAR' when low6 then 'RL_RENTA_INSUFICIENTE' else '' end as blocking_rule_codes,
  case when tpos is null then null when not low6 then 'APPROVED' else 'PENDING' end as titular_income_code,
  ttotal as titular_income_total, tpays as titular_payslips,
  cast(nobs + case when tpos is null or low6 then 1 else 0 end as int) as n_observations,
  2 as n_trail
from k""")


@query("flow6_decisions", _FLOW6_SQL)
def flow6_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved flow without the bureau check, through the runner."""
    return flows.decision_summary(run_flow(spark, sf_dir, "flow-6"))


@query("flow6_flat", _FLOW6_SQL)
def flow6_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R8 on flat tables."""
    return flat_rules.flow6_flat(views.requests(spark, sf_dir), views.applicant_income(spark, sf_dir))


@query("flow_p0_outcomes", _flow_sql("""
select case when branch and nhard = 0 and not low then 'APPROVED' else 'REJECTED' end as decision, count(*) as n
from k group by 1"""))
def flow_p0_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests per final decision."""
    return flows.batch_summary(run_flow(spark, sf_dir, "p0"))


@query("flow_p0_trail", _flow_sql("""
select cast(id as varchar) as id, step, execution_id, fn_name, n_outputs, output_paths from steps""", """
steps as (
  select r.id, 0 as step, 'exec-1' as execution_id, 'fn_calcular_promedio_renta' as fn_name,
    cast(count(a.idx) as int) as n_outputs,
    coalesce(string_agg('applicants[' || cast(a.idx as varchar) || '].calculated_metrics', ',' order by a.idx), '') as output_paths
  from requests r left join app a on a.request_id = r.id and a.has_obs and a.avg6 <> 0
  group by r.id
  union all
  select id, 1, 'exec-2', case when branch then 'rl_check_dicom' else 'rl_sin_ingresos' end,
    case when not branch or nhard > 0 then 1 else 0 end,
    case when not branch or nhard > 0 then 'decision' else '' end
  from k
  union all
  select id, 2, 'exec-3', 'rl_renta_minima', 1,
    case when low then 'decision' else 'applicants[' || cast(tidx as varchar) || '].evaluation_results' end
  from k where branch
)"""))
def flow_p0_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The execution trail exploded to an audit table."""
    return flows.audit_table(run_flow(spark, sf_dir, "p0"))


_TITULAR_SQL = with_views(["requests", "applicants"], """
select cast(r.id as varchar) as id, t.tpos as titular_pos,
  case when t.tpos is not null then concat(cast(r.id as varchar), '-', cast(t.tpos as varchar)) end as titular_id
from requests r left join (select request_id, min(pos) as tpos from applicants where role = 'TITULAR' group by 1) t
  on r.id = t.request_id""")


@query("flow_p0_observations", _flow_sql("""
select cast(id as varchar) as id, fn_name, message, number, value from said""", f"""
said as (
  select request_id as id, '{rules.AVG_OBS_NAME}' as fn_name,
    'Promedio calculado App ' || cast(request_id as varchar) || '-' || cast(pos as varchar) as message,
    round(avg6, 6) as number, cast(null as varchar) as value
  from app where has_obs
  union all
  select k.id, 'SYSTEM', 'Rechazo Automático: RL_DICOM_HARD', null,
    '"Aplicante ' || cast(k.id as varchar) || '-' || cast(a.pos as varchar) || ' tiene antecedentes comerciales bloqueantes."'
  from k join app a on a.request_id = k.id where branch and a.is_hard_debt
  union all
  select id, 'SYSTEM', 'Rechazo Automático: RL_RENTA_INSUFICIENTE', round(tavg, 6),
    '"Renta (#) inferior a 3.0x el arriendo (' || cast(monthly_rent as varchar) || ')"'
  from k where low
  union all
  select id, 'SYSTEM', 'Rechazo Automático: ' || case when tpos is null then 'RL_NO_TITULAR' else 'RL_SIN_INGRESOS' end, null,
    case when tpos is null then '"No existe titular"' else '"No se detectaron ingresos válidos."' end
  from k where not branch
)"""))
def flow_p0_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2-R5's and A10's observation texts.  The mean income is compared as a
    number (its last bit depends on the order of a sum), with ``#`` in the text."""
    x = flows._barrier(run_flow(spark, sf_dir, "p0").select("id", "observations")).select("id", F.inline("observations"))
    x = flows._barrier(x)
    income = F.coalesce(F.col("value").try_cast("double"), F.regexp_extract("value", r"Renta \(([^)]*)\)", 1).try_cast("double"))
    text = F.when(F.col("fn_name") != rules.AVG_OBS_NAME, F.regexp_replace("value", r"Renta \([^)]*\)", "Renta (#)"))
    return x.select("id", "fn_name", "message", F.round(income, 6).alias("number"), text.alias("value"))


@query("flow_titular", _TITULAR_SQL)
def flow_titular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first TITULAR of each request, in applicant order."""
    req = nested_requests(spark, sf_dir)
    t = titular(F.col("applicants"))
    pos = F.when(t.isNotNull(), F.element_at(F.split(t.id, "-"), -1).cast("int"))
    return req.select("id", pos.alias("titular_pos"), t.id.alias("titular_id"))


_INCOME_SQL = with_views(["applicants", "payslips"], """
select concat(cast(a.request_id as varchar), '-', cast(a.pos as varchar)) as applicant_id,
  case when a.income_type = 'DEPENDENT' then coalesce(p.total, cast(0 as decimal(38,2))) end as income_total,
  case when a.income_type = 'DEPENDENT' then cast(coalesce(p.n, 0) as int) end as n_payslips,
  case when a.income_type = 'DEPENDENT' and coalesce(p.n, 0) > 0 then true else false end as has_observation
from applicants a left join pay p on a.request_id = p.request_id and a.pos = p.pos""",
    "pay as (select request_id, pos, count(*) as n, sum(cast(net_income as decimal(38,2))) as total "
    "from payslips group by request_id, pos)")


@query("flow_income_avg", _INCOME_SQL)
def flow_income_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 applied alone, one row per applicant: the payslip total and count
    behind ``avg_6m`` (exact), and whether an observation is emitted."""
    req = nested_requests(spark, sf_dir)
    state = {c: F.col(c) for c in ("id", "context", "applicants", "decision", "observations")}
    apps = rules.fn_calcular_promedio_renta(state)["applicants"]
    x = req.select(F.explode(apps).alias("a"))
    pays = F.col("a.income_source.dependent.payslips")
    return x.select(F.col("a.id").alias("applicant_id"), flows.income_total(F.col("a")).alias("income_total"),
                    F.size(pays).alias("n_payslips"),
                    (rules.is_dependent(F.col("a")) & (F.coalesce(F.size(pays), F.lit(0)) > 0)).alias("has_observation"))


# ------------------------------------------------------------------ R9 per row
def _coded_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    req = nested_requests(spark, sf_dir)
    code = F.when(F.col("id").cast("long") % 5 == 0, F.lit("FLOW_LEGACY")).otherwise(F.lit("FLOW_P0"))
    return req.withColumn("flow_code", code)


@query("flow_by_code", _flow_sql("""
select cast(id as varchar) as id,
  case when id % 5 = 0 then 'PENDING' when branch and nhard = 0 and not low then 'APPROVED' else 'REJECTED' end
    as final_decision_code,
  case when id % 5 = 0 then ''
       when branch then concat_ws(',', nullif(rtrim(repeat('RL_DICOM_HARD,', cast(nhard as int)), ','), ''),
                                  case when low then 'RL_RENTA_INSUFICIENTE' end)
       when tpos is null then 'RL_NO_TITULAR' else 'RL_SIN_INGRESOS' end as blocking_rule_codes,
  case when tpos is null then null when id % 5 = 0 then 'PENDING'
       when branch and not low then 'APPROVED' else 'PENDING' end as titular_income_code,
  ttotal as titular_income_total, tpays as titular_payslips,
  case when id % 5 = 0 then 0
       else cast(nobs + case when branch then nhard + case when low then 1 else 0 end else 1 end as int) end
    as n_observations,
  case when id % 5 = 0 then 0 when branch then 3 else 2 end as n_trail
from k"""))
def flow_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each request names its flow by code; known codes run their flow
    on their slice, unknown codes pass through undecided."""
    decided = flows.apply_flow_by_code(_coded_requests(spark, sf_dir), "flow_code", flows.load_flows())
    return flows.decision_summary(decided)


# The trail's values as JSON texts: an applicant's metrics (the mean income, whose last bit depends on the order of a sum, as ``#``),
# a rejecting decision, the titular's results.
_METRICS = ('{"income":{"avg_6m":#,"avg_12m":0,"min_month":0,"variability_index":0},'
            '"financial_load":{"debt_to_income_ratio":0.0,"available_income_after_debt":0}}')


def _decision(codes: str) -> str:
    return "'{\"final_decision_code\":\"REJECTED\",\"blocking_rule_codes\":[' || " + codes + " || '],\"required_action_codes\":[]}'"


_APPROVED = '\'{"income":{"evaluation_code":"APPROVED","triggered_rule_codes":[]}}\''
_LISTED = "select cast(id as varchar) as id, step, execution_id, fn_name, path, 'object' as value_type, value, number from paths"
_DICOM_LIST = "repeat('\"RL_DICOM_HARD\",', cast(nhard as int))"
_AVERAGES = f"""
  select a.request_id as id, 0 as step, 'exec-1' as execution_id, 'fn_calcular_promedio_renta' as fn_name,
    'applicants[' || cast(a.idx as varchar) || '].calculated_metrics' as path, '{_METRICS}' as value, round(a.avg6, 6) as number
  from app a where a.has_obs and a.avg6 <> 0"""

_AUDIT_PATHS_SQL = _flow_sql(_LISTED, f"""
paths as ({_AVERAGES}
  union all
  select id, 1, 'exec-2', case when branch then 'rl_check_dicom' else 'rl_sin_ingresos' end, 'decision',
    case when branch then {_decision(f"rtrim({_DICOM_LIST}, ',')")} when tpos is null then {_decision("'\"RL_NO_TITULAR\"'")}
         else {_decision("'\"RL_SIN_INGRESOS\"'")} end, null
  from k where not branch or nhard > 0
  union all
  select id, 2, 'exec-3', 'rl_renta_minima',
    case when low then 'decision' else 'applicants[' || cast(tidx as varchar) || '].evaluation_results' end,
    case when low then {_decision(f"{_DICOM_LIST} || '\"RL_RENTA_INSUFICIENTE\"'")} else {_APPROVED} end, null
  from k where branch
)""")


def comparable(paths: DataFrame) -> DataFrame:
    """Audit rows with the mean income taken out of the metrics as a number."""
    metrics = F.col("path").endswith(".calculated_metrics")
    return paths.withColumn("number", F.when(metrics, F.round(F.get_json_object("value", "$.income.avg_6m").cast("double"), 6))).withColumn(
        "value", F.when(metrics, F.regexp_replace("value", r'"avg_6m":[^,]*', '"avg_6m":#')).otherwise(F.col("value")))


@query("flow_p0_audit_paths", _AUDIT_PATHS_SQL)
def flow_p0_audit_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R12 exploded: one audit row per changed part, with its value."""
    return comparable(flows.audit_paths(run_flow(spark, sf_dir, "p0")))


@query("flow_p0_audit_paths_flat", _AUDIT_PATHS_SQL)
def flow_p0_audit_paths_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R12 exploded on flat tables: the same audit rows without building documents."""
    return _flat_audit(spark, sf_dir, "p0")


def _flat_audit(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return comparable(flat_flow.audit(views.requests(spark, sf_dir), views.applicant_income(spark, sf_dir), flows.load_flows()[name]))


@query("flow_titular_flat", _TITULAR_SQL)
def flow_titular_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 on flat rows: the lowest TITULAR position per request (partial aggregate)."""
    req = views.requests(spark, sf_dir).select("id")
    apps = views.applicants(spark, sf_dir)
    t = apps.groupBy("request_id").agg(F.min(F.when(F.col("role") == "TITULAR", F.col("pos"))).alias("titular_pos"))
    j = req.join(t, req.id == t.request_id, "left")
    tid = F.when(F.col("titular_pos").isNotNull(),
                 F.concat(F.col("id").cast("string"), F.lit("-"), F.col("titular_pos").cast("string")))
    return j.select(F.col("id").cast("string").alias("id"), "titular_pos", tid.alias("titular_id"))


@query("flow_income_avg_flat", _INCOME_SQL)
def flow_income_avg_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 on flat rows: payslip total and count per dependent applicant."""
    inc = flat_rules.applicant_income(views.applicant_income(spark, sf_dir))
    dep = F.col("income_type") == "DEPENDENT"
    return inc.select(
        F.concat(F.col("request_id").cast("string"), F.lit("-"), F.col("pos").cast("string")).alias("applicant_id"),
        F.when(dep, F.col("income_total")).alias("income_total"),
        F.when(dep, F.col("n_payslips")).alias("n_payslips"),
        F.col("has_obs").alias("has_observation"))


_FLOW6_AUDIT_SQL = _flow_sql(_LISTED, f"""
paths as ({_AVERAGES}
  union all
  select id, 1, 'exec-2', 'rl_renta_minima',
    case when tpos is null or low6 then 'decision'
         else 'applicants[' || cast(tidx as varchar) || '].evaluation_results' end,
    case when tpos is null then {_decision("'\"RL_NO_TITULAR\"'")} when low6 then {_decision("'\"RL_RENTA_INSUFICIENTE\"'")} else {_APPROVED} end, null
  from k
)""")


@query("flow6_audit_paths", _FLOW6_AUDIT_SQL)
def flow6_audit_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R8 + R12: the flow-6 trail exploded, through the nested runner."""
    return comparable(flows.audit_paths(run_flow(spark, sf_dir, "flow-6")))


@query("flow6_audit_paths_flat", _FLOW6_AUDIT_SQL)
def flow6_audit_paths_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R8 + R12 on flat tables."""
    return _flat_audit(spark, sf_dir, "flow-6")


@query("flow_p0_outcomes_flat", _flow_sql("""
select case when branch and nhard = 0 and not low then 'APPROVED' else 'REJECTED' end as decision, count(*) as n
from k group by 1"""))
def flow_p0_outcomes_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R13 on flat tables: requests per final decision."""
    d = flat_rules.p0_flat(views.requests(spark, sf_dir), views.applicant_income(spark, sf_dir))
    return d.groupBy(F.col("final_decision_code").alias("decision")).agg(F.count(F.lit(1)).alias("n"))
