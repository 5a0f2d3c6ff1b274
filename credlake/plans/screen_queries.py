"""A flow that a user might save: bureau check first, a decision on its outcome, then the income rules.

The same spec runs through the nested runner and through the flat compiler,
against one SQL text; the audit compares the values of the trail, with the
mean income (whose last bit depends on the order of a sum) as a number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from credlake.operators import flat_flow, flows
from credlake.plans.flow_queries import _APPROVED, _METRICS, _decision, _flow_sql, comparable, nested_requests
from credlake.plans.registry import query
from credlake.sources import views

SPEC = {
    "flow_name": "screen", "entryNodeId": "s1",
    "nodes": [
        {"id": "s1", "type": "function", "data": {"functionName": "rl_check_dicom"}},
        {"id": "s2", "type": "decision", "data": {"condition": "len(decision.blocking_rule_codes) > 0"}},
        {"id": "s3", "type": "function", "data": {"functionName": "fn_calcular_promedio_renta"}},
        {"id": "s4", "type": "decision", "data": {"condition": "titular.calculated_metrics.income.avg_6m > 0 AND size(applicants) <= 4"}},
        {"id": "s5", "type": "function", "data": {"functionName": "rl_renta_minima"}},
        {"id": "s6", "type": "function", "data": {"functionName": "rl_sin_ingresos"}},
        {"id": "s7", "type": "function", "data": {"functionName": "motor.finalize_decision"}},
    ],
    "edges": [
        {"source": "s1", "target": "s2"}, {"source": "s2", "target": "s7", "sourceHandle": "true"}, {"source": "s2", "target": "s3", "sourceHandle": "false"},
        {"source": "s3", "target": "s4"}, {"source": "s4", "target": "s5", "sourceHandle": "true"}, {"source": "s4", "target": "s6", "sourceHandle": "false"},
        {"source": "s5", "target": "s7"}, {"source": "s6", "target": "s7"},
    ],
}

_SCREEN = """
counted as (select request_id, count(*) as napp from applicants group by 1),
q as (select k.*, nhard > 0 as hard, nhard = 0 and branch and napp <= 4 as rich,
        case when tpos is null then 'RL_NO_TITULAR' when tavg <= 0 then 'RL_SIN_INGRESOS' end as poor
      from k left join counted c on c.request_id = k.id)"""

_DECIDED = _flow_sql("""
select cast(id as varchar) as id,
  case when hard or (rich and low6) or (not rich and poor is not null) then 'REJECTED' else 'APPROVED' end as final_decision_code,
  case when hard then rtrim(repeat('RL_DICOM_HARD,', cast(nhard as int)), ',') when rich and low6 then 'RL_RENTA_INSUFICIENTE'
       when rich then '' else coalesce(poor, '') end as blocking_rule_codes,
  case when tpos is null then null when rich and not low6 then 'APPROVED' else 'PENDING' end as titular_income_code,
  ttotal as titular_income_total, tpays as titular_payslips,
  cast(case when hard then nhard else nobs + case when (rich and low6) or (not rich and poor is not null) then 1 else 0 end end as int) as n_observations,
  case when hard then 1 else 3 end as n_trail
from q""", _SCREEN)

_AUDIT = _flow_sql("select cast(id as varchar) as id, step, execution_id, fn_name, path, 'object' as value_type, value, number from paths", _SCREEN + f""",
paths as (
  select id, 0 as step, 'exec-1' as execution_id, 'rl_check_dicom' as fn_name, 'decision' as path,
    {_decision("rtrim(repeat('\"RL_DICOM_HARD\",', cast(nhard as int)), ',')")} as value, cast(null as double) as number
  from q where hard
  union all
  select a.request_id, 1, 'exec-2', 'fn_calcular_promedio_renta', 'applicants[' || cast(a.idx as varchar) || '].calculated_metrics', '{_METRICS}', round(a.avg6, 6)
  from app a join q on q.id = a.request_id where not q.hard and a.has_obs and a.avg6 <> 0
  union all
  select id, 2, 'exec-3', 'rl_renta_minima', case when low6 then 'decision' else 'applicants[' || cast(tidx as varchar) || '].evaluation_results' end,
    case when low6 then {_decision("'\"RL_RENTA_INSUFICIENTE\"'")} else {_APPROVED} end, null
  from q where rich
  union all
  select id, 2, 'exec-3', 'rl_sin_ingresos', 'decision', {_decision("'\"' || poor || '\"'")}, null from q where not hard and not rich and poor is not null
)""")


@query("flow_screen_decisions", _DECIDED)
def flow_screen_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R10 + R11: a third spec, with a decision after a rule, through the nested runner."""
    return flows.decision_summary(flows.apply_flow(nested_requests(spark, sf_dir), SPEC))


@query("flow_screen_flat", _DECIDED)
def flow_screen_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same spec compiled to flat state columns."""
    return flat_flow.decide(views.requests(spark, sf_dir), views.applicant_income(spark, sf_dir), SPEC)


@query("flow_screen_audit", _AUDIT)
def flow_screen_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R12 of the nested runner with its values."""
    return comparable(flows.audit_paths(flows.apply_flow(nested_requests(spark, sf_dir), SPEC)))


@query("flow_screen_audit_flat", _AUDIT)
def flow_screen_audit_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R12 of the compiled flow with its values."""
    return comparable(flat_flow.audit(views.requests(spark, sf_dir), views.applicant_income(spark, sf_dir), SPEC))
