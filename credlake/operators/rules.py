"""Calculations and rules over nested requests.

Each step is a pure function from the current state columns to new column
expressions: ``step(state) -> {column: expression}``.  State columns are
``id``, ``context``, ``applicants``, ``decision``, ``observations``.  The flow
runner (``credlake.operators.flows``) applies a step only to the rows whose
path reaches it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from credlake.functions.text import fill, python_float
from credlake.operators.requests import OBSERVATION, titular_index

State = dict[str, Column]
Step = Callable[[State], State]

# Rule codes, observation texts and the rent factor.
CODE_DICOM = "RL_DICOM_HARD"
CODE_NO_TITULAR = "RL_NO_TITULAR"
CODE_LOW_INCOME = "RL_RENTA_INSUFICIENTE"
CODE_NO_INCOME = "RL_SIN_INGRESOS"
REJECTED, APPROVED, REQUIRE_ACTION = "REJECTED", "APPROVED", "REQUIRE_ACTION"
RENT_FACTOR = 3.0
SYSTEM = "SYSTEM"
REJECT_MESSAGE = "Rechazo Automático: {code}"
AVG_OBS_NAME = "fn_calc_renta"
AVG_OBS_MESSAGE = "Promedio calculado App {id}"
REASON_NO_TITULAR = "No existe titular"
REASON_DICOM = "Aplicante {id} tiene antecedentes comerciales bloqueantes."
REASON_LOW_INCOME = "Renta ({renta}) inferior a {factor}x el arriendo ({arriendo})"
REASON_NO_INCOME = "No se detectaron ingresos válidos."


def json_text(s: Column) -> Column:
    """A string as a JSON string literal, every control character escaped."""
    listed = F.to_json(F.array(s))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def json_number(x: Column) -> Column:
    return python_float(x)


def observation(fn_name: Column | str, message: Column, value: Column) -> Column:
    fn = F.lit(fn_name) if isinstance(fn_name, str) else fn_name
    return F.struct(fn.alias("fn_name"), message.alias("message"), value.alias("value"))


# ------------------------------------------------------------------ R1
def is_dependent(a: Column) -> Column:
    return (a.income_source.type == "DEPENDENT") & a.income_source.dependent.isNotNull()


# ------------------------------------------------------------------ R5
def reject_if(state: State, cond: Column, code: Column | str, reason: Column) -> State:
    """R5 for one code per row: REJECTED, code appended, observation appended."""
    code_c = F.lit(code) if isinstance(code, str) else code
    d = state["decision"]
    new_d = d.withField("final_decision_code", F.lit(REJECTED)).withField(
        "blocking_rule_codes", F.concat(d.blocking_rule_codes, F.array(code_c)))
    obs = observation(SYSTEM, fill(REJECT_MESSAGE, code=code_c), json_text(reason))
    return {
        **state,
        "decision": F.when(cond, new_d).otherwise(d),
        "observations": F.when(cond, F.concat(state["observations"], F.array(obs))).otherwise(state["observations"]),
    }


# ------------------------------------------------------------------ A10
def _payslip_avg(a: Column) -> Column:
    pays = a.income_source.dependent.payslips
    total = F.aggregate(pays, F.lit(0.0), lambda acc, p: acc + p.net_income.cast("double"))
    return F.when(F.size(pays) > 0, total / F.size(pays)).otherwise(F.lit(0.0))


def fn_calcular_promedio_renta(state: State) -> State:
    """A10: mean net income over all payslips of each dependent applicant
    (empty list -> 0.0), one observation per applicant that has payslips."""
    apps = state["applicants"]
    new_apps = F.transform(apps, lambda a: F.when(
        is_dependent(a), a.withField("calculated_metrics.income.avg_6m", _payslip_avg(a))).otherwise(a))
    with_pay = F.filter(apps, lambda a: is_dependent(a) & (F.size(a.income_source.dependent.payslips) > 0))
    obs = F.transform(with_pay, lambda a: observation(
        AVG_OBS_NAME, fill(AVG_OBS_MESSAGE, id=a.id), json_number(_payslip_avg(a))))
    return {**state, "applicants": new_apps,
            "observations": F.concat(state["observations"], obs.cast(f"array<{OBSERVATION.simpleString()}>"))}


# ------------------------------------------------------------------ R2
def rl_check_dicom(state: State) -> State:
    """R2: one RL_DICOM_HARD per applicant (any role) with hard bureau debt."""
    apps, d = state["applicants"], state["decision"]
    hard = F.filter(apps, lambda a: F.coalesce(a.commercial_data.dicom.is_hard_debt, F.lit(False)))
    n = F.size(hard)
    codes = F.transform(hard, lambda a: F.lit(CODE_DICOM))
    obs = F.transform(hard, lambda a: observation(
        SYSTEM, fill(REJECT_MESSAGE, code=F.lit(CODE_DICOM)), json_text(fill(REASON_DICOM, id=a.id))))
    new_d = d.withField("final_decision_code", F.lit(REJECTED)).withField(
        "blocking_rule_codes", F.concat(d.blocking_rule_codes, codes))
    return {**state,
            "decision": F.when(n > 0, new_d).otherwise(d),
            "observations": F.concat(state["observations"], obs)}


def _titular_income(state: State) -> tuple[Column, Column]:
    idx = titular_index(state["applicants"])
    renta = F.get(state["applicants"], idx).calculated_metrics.income.avg_6m
    return idx, renta


# ------------------------------------------------------------------ R3
def rl_renta_minima(state: State) -> State:
    """No titular -> RL_NO_TITULAR; income < 3 x rent -> RL_RENTA_INSUFICIENTE;
    else the titular's income result becomes APPROVED."""
    idx, renta = _titular_income(state)
    rent = state["context"].monthly_rent
    none = idx < 0
    low = ~none & (renta < rent * F.lit(RENT_FACTOR))
    reason = fill(REASON_LOW_INCOME, renta=python_float(renta), factor=F.lit(str(RENT_FACTOR)), arriendo=python_float(rent))
    s = reject_if(state, none, CODE_NO_TITULAR, F.lit(REASON_NO_TITULAR))
    s = reject_if(s, F.coalesce(low, F.lit(False)), CODE_LOW_INCOME, reason)
    ok = ~none & F.coalesce(~low, F.lit(False))
    approved = F.transform(state["applicants"], lambda a, i: F.when(
        i == idx, a.withField("evaluation_results.income.evaluation_code", F.lit(APPROVED))).otherwise(a))
    s["applicants"] = F.when(ok, approved).otherwise(state["applicants"])
    return s


# ------------------------------------------------------------------ R4
def rl_sin_ingresos(state: State) -> State:
    """No titular -> RL_NO_TITULAR; titular income <= 0 -> RL_SIN_INGRESOS."""
    idx, renta = _titular_income(state)
    none = idx < 0
    s = reject_if(state, none, CODE_NO_TITULAR, F.lit(REASON_NO_TITULAR))
    return reject_if(s, ~none & F.coalesce(renta <= 0, F.lit(False)), CODE_NO_INCOME, F.lit(REASON_NO_INCOME))


# ------------------------------------------------------------------ R6
def finalize_decision(state: State) -> State:
    """Any blocking code -> REJECTED; else any required action -> REQUIRE_ACTION; else APPROVED."""
    d = state["decision"]
    code = (F.when(F.size(d.blocking_rule_codes) > 0, F.lit(REJECTED))
            .when(F.size(d.required_action_codes) > 0, F.lit(REQUIRE_ACTION))
            .otherwise(F.lit(APPROVED)))
    return {**state, "decision": d.withField("final_decision_code", code)}
