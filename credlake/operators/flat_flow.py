"""Any acyclic flow spec on flat tables (R10-R13 without nesting).

The spec's graph is compiled to columns of one row per request: what the
request's applicants come to is a partial + final aggregate, a node's step is
a change of a few scalar state columns guarded by the node's mask, and a
condition is bound to structs made from those columns.  No document is built
and no request is gathered in a task, so a request with a third of all
applicants costs one row per task before the shuffle.

State of a request: the decision's code and its blocking codes (as runs of a
code and a count), whether the income average has run, the titular's income
code, the numbers of observations and of tracked steps, and one column per
change that the audit lists.  A step is registered with ``register`` as a
function from that state to the columns that it changes.

What the flat tables hold of an applicant is the position, role, kind of
income, hard debt and payslip sums; conditions may use ``titular`` (id,
income average, income code, hard debt), ``context``, ``decision`` and the
number of applicants (``len(applicants)`` or ``size(applicants)``).  A spec
that needs more, has a cycle or names an unregistered function raises
``NotFlat`` when the plan is built; the nested runner takes those.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlake.functions.conditions import condition_column
from credlake.operators import flat_rules, flows
from credlake.operators import rules as R
from credlake.operators.requests import PENDING

RUN = "array<struct<code: string, n: int>>"
STATE = ("code", "blocks", "averaged", "tcode", "n_obs", "n_trail")


class NotFlat(ValueError):
    """A spec that flat tables cannot decide."""


@dataclass
class Change:
    """What a step does to the state; absent columns stay.  ``decision``, ``titular`` and
    ``incomes`` say on which rows the audit lists the decision, the titular's results and
    the applicants' metrics as changed."""
    columns: dict[str, Column]
    decision: Column | None = None
    titular: Column | None = None
    incomes: Column | None = None


def _runs(code: Column, n: Column) -> Column:
    return F.array(F.struct(code.alias("code"), n.cast("int").alias("n")))


def _reject(cond: Column, code: Column, n: Column) -> Change:
    """R5 for ``n`` codes at once: REJECTED, codes and observations appended."""
    return Change({"code": F.when(cond, F.lit(R.REJECTED)).otherwise(F.col("code")),
                   "blocks": F.when(cond, F.concat("blocks", _runs(code, n))).otherwise(F.col("blocks")),
                   "n_obs": F.col("n_obs") + F.when(cond, n).otherwise(F.lit(0))}, decision=cond)


def _income() -> Column:
    return F.when(F.col("averaged"), F.col("tavg")).otherwise(F.lit(0.0))


def _average() -> Change:
    return Change({"averaged": F.lit(True), "n_obs": F.col("n_obs") + F.col("n_pay_obs")}, incomes=~F.col("averaged"))


def _dicom() -> Change:
    return _reject(F.col("n_hard") > 0, F.lit(R.CODE_DICOM), F.col("n_hard"))


def _rent() -> Change:
    none, low = F.col("tpos").isNull(), F.coalesce(_income() < F.col("monthly_rent") * F.lit(R.RENT_FACTOR), F.lit(False))
    ok = ~none & F.coalesce(_income() >= F.col("monthly_rent") * F.lit(R.RENT_FACTOR), F.lit(False))
    out = _reject(none | low, F.when(none, F.lit(R.CODE_NO_TITULAR)).otherwise(F.lit(R.CODE_LOW_INCOME)), F.lit(1))
    out.columns["tcode"] = F.when(ok, F.lit(R.APPROVED)).otherwise(F.col("tcode"))
    out.titular = ok & (F.col("tcode") != R.APPROVED)
    return out


def _no_income() -> Change:
    none = F.col("tpos").isNull()
    return _reject(none | (_income() <= 0), F.when(none, F.lit(R.CODE_NO_TITULAR)).otherwise(F.lit(R.CODE_NO_INCOME)), F.lit(1))


def _finalize() -> Change:
    # The flat tables ask for no actions, so R6's second outcome cannot arise.
    return Change({"code": F.when(F.size("blocks") > 0, F.lit(R.REJECTED)).otherwise(F.lit(R.APPROVED))})


_STEPS: dict[str, Callable[[], Change]] = {
    "fn_calcular_promedio_renta": _average, "rl_check_dicom": _dicom, "rl_renta_minima": _rent,
    "rl_sin_ingresos": _no_income, flows.FINALIZE: _finalize}


def register(name: str, step: Callable[[], Change]) -> None:
    """The flat form of a step that ``flows.register`` knows."""
    _STEPS[name] = step


# ------------------------------------------------------------------ facts
def _facts(requests: DataFrame, applicants: DataFrame) -> DataFrame:
    """A request per row with what its applicants come to; ``applicants``: with income, and ``idx`` for the audit."""
    tpos = F.when(F.col("role") == "TITULAR", F.col("pos"))
    hard = F.coalesce(F.col("is_hard_debt"), F.lit(False))
    index = [F.min_by(F.col("idx"), tpos).alias("tidx")] if "idx" in applicants.columns else []
    # Fixed-width buffers only: a hash aggregate, not a sort.
    per = applicants.groupBy("request_id").agg(
        F.min(tpos).alias("tpos"), F.min_by(F.col("avg_6m"), tpos).alias("tavg"), F.min_by(F.col("income_total"), tpos).alias("ttotal"),
        F.min_by(F.col("n_payslips"), tpos).alias("tpays"), F.min_by(hard, tpos).alias("thard"), F.count_if(hard).alias("n_hard"),
        F.count_if("has_obs").alias("n_pay_obs"), F.count(F.lit(1)).alias("n_applicants"), *index)
    joined = requests.join(per, requests.id == per.request_id, "left").drop("request_id")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_hard", "n_pay_obs", "n_applicants")}
    return joined.withColumns(zero).withColumns({
        "code": F.lit(PENDING), "blocks": F.array().cast(RUN), "averaged": F.lit(False), "tcode": F.lit(PENDING),
        "n_obs": F.lit(0).cast("long"), "n_trail": F.lit(0)})


def codes(blocks: Column) -> Column:
    return F.flatten(F.transform(blocks, lambda b: F.array_repeat(b["code"], b["n"])))


def _bound(df: DataFrame) -> dict[str, Column]:
    """R11's names as structs of the state."""
    def col(c: str) -> Column:
        return F.col(c) if c in df.columns else F.lit(None).cast("string")
    titular = F.struct(
        F.concat_ws("-", F.col("id").cast("string"), F.col("tpos").cast("string")).alias("id"),
        F.struct(F.struct(_income().alias("avg_6m")).alias("income")).alias("calculated_metrics"),
        F.struct(F.struct(F.col("tcode").alias("evaluation_code")).alias("income")).alias("evaluation_results"),
        F.struct(F.struct(F.col("thard").alias("is_hard_debt")).alias("dicom")).alias("commercial_data"))
    return {
        "titular": F.when(F.col("tpos").isNotNull(), titular),
        "context": F.struct(col("property_id").alias("property_id"), F.col("monthly_rent").alias("monthly_rent"),
                            col("currency").alias("currency"), F.col("n_applicants").cast("int").alias("n_applicants")),
        "decision": F.struct(F.col("code").alias("final_decision_code"), codes(F.col("blocks")).alias("blocking_rule_codes"),
                             F.array().cast("array<string>").alias("required_action_codes"))}


def _with_condition(df: DataFrame, text: str, name: str) -> DataFrame:
    text = re.sub(r"\b(?:len|size)\(\s*(?:motor\.)?applicants\s*\)", "context.n_applicants", text)
    if re.search(r"\bapplicants\b", text):
        raise NotFlat(f"condition over the list of applicants: {text}")
    taken = [c for c in ("titular", "context", "decision") if c in df.columns]
    if taken:
        raise NotFlat(f"the request table has columns of its own named {taken}")
    bound = df.withColumns(_bound(df))
    schema = {f.name: f.dataType for f in bound.schema.fields}
    try:
        return bound.withColumn(name, condition_column(text, schema)).drop("titular", "context", "decision")
    except Exception as e:
        if "UNRESOLVED" in str(e) or "FIELD_NOT_FOUND" in str(e):
            raise NotFlat(f"condition over fields that flat tables lack: {text}") from e
        raise


# ------------------------------------------------------------------ R10
def _run(facts: DataFrame, spec: dict) -> tuple[DataFrame, list[tuple[str, int]], list[str]]:
    """The decided requests, (function, number) of every tracked step, and the steps that run the income average.

    Step ``k`` leaves ``_at{k}`` (its number in the request's trail, NULL where it
    did not run) and, where it can change them, ``_dec{k}``, ``_tit{k}``, ``_inc{k}``."""
    try:
        plan = flows.plan_flow(spec)
    except flows.CyclicFlow as e:
        raise NotFlat(str(e)) from e
    out, steps = facts, []
    for k, nid in enumerate(plan.order):
        terms = [F.col(f"_m{plan.order.index(src)}") & (F.lit(True) if branch is None else F.col(f"_c{plan.order.index(src)}") == F.lit(branch == "true"))
                 for src, branch in plan.incoming[nid]]
        reached = F.lit(True) if not terms else terms[0]
        for t in terms[1:]:
            reached = reached | t
        out = out.withColumn(f"_m{k}", reached)
        here = F.col(f"_m{k}")
        if plan.graph.condition(nid):
            out = _with_condition(out, plan.graph.condition(nid), f"_c{k}")
            continue
        name = plan.graph.function(nid)
        if not name:
            continue
        if name not in _STEPS:
            raise NotFlat(f"no flat form of {name}")
        change, tracked = _STEPS[name](), flows.get_step(name)[1]
        new = {c: F.when(here, v).otherwise(F.col(c)) for c, v in change.columns.items()}
        if tracked:
            steps.append((name, k))
            new[f"_at{k}"] = F.when(here, F.col("n_trail"))
            new["n_trail"] = F.col("n_trail") + F.when(here, 1).otherwise(0)
            for mark, cond in (("_dec", change.decision), ("_tit", change.titular), ("_inc", change.incomes)):
                if cond is not None:
                    new[f"{mark}{k}"] = here & F.coalesce(cond, F.lit(False))
            if change.decision is not None:  # the decision as this step left it
                new[f"_then{k}"] = F.when(here, F.struct(new["code"].alias("code"), new["blocks"].alias("blocks")))
        out = out.withColumns(new)
    return out, steps, [f"_inc{k}" for _, k in steps if f"_inc{k}" in out.columns]


def decide(requests: DataFrame, with_pay: DataFrame, spec: dict) -> DataFrame:
    """R10 on flat tables: the columns of ``flows.decision_summary``.

    ``requests``: id, monthly_rent and what conditions use of the context;
    ``with_pay``: applicants with ``n_pay``/``s_pay`` (``flat_rules.payslip_totals``)."""
    done, _, _ = _run(_facts(requests, flat_rules.applicant_income(with_pay)), spec)
    has = F.col("tpos").isNotNull()
    return done.select(
        F.col("id").cast("string").alias("id"), F.col("code").alias("final_decision_code"),
        F.array_join(codes(F.col("blocks")), ",").alias("blocking_rule_codes"), F.when(has, F.col("tcode")).alias("titular_income_code"),
        F.col("ttotal").alias("titular_income_total"), F.col("tpays").alias("titular_payslips"),
        F.col("n_obs").cast("int").alias("n_observations"), F.col("n_trail").cast("int").alias("n_trail"))


def metrics_json(avg: Column) -> Column:
    """The trail's snapshot of an applicant's metrics."""
    zero = F.lit(0)
    return F.to_json(F.struct(
        F.struct(avg.alias("avg_6m"), zero.alias("avg_12m"), zero.alias("min_month"), zero.alias("variability_index")).alias("income"),
        F.struct(F.lit(0.0).alias("debt_to_income_ratio"), zero.alias("available_income_after_debt")).alias("financial_load")))


def audit(requests: DataFrame, with_pay: DataFrame, spec: dict) -> DataFrame:
    """R12 on flat tables: the rows of ``flows.audit_paths``, one per changed part of each step."""
    income = flat_rules.with_applicant_index(flat_rules.applicant_income(with_pay))
    done, steps, averaged = _run(_facts(requests, income), spec)

    def row(name: str, k: int, path: Column, value: Column) -> Column:
        at = F.col(f"_at{k}")
        return F.struct(at.cast("int").alias("step"), F.concat(F.lit("exec-"), (at + 1).cast("string")).alias("execution_id"), F.lit(name).alias("fn_name"),
                        path.alias("path"), F.lit("object").alias("value_type"), value.alias("value"))
    listed = []
    for name, k in steps:
        if f"_dec{k}" in done.columns:
            then = F.col(f"_then{k}")
            value = F.to_json(F.struct(then["code"].alias("final_decision_code"), codes(then["blocks"]).alias("blocking_rule_codes"),
                                       F.array().cast("array<string>").alias("required_action_codes")))
            listed.append(F.when(F.col(f"_dec{k}"), row(name, k, F.lit("decision"), value)))
        if f"_tit{k}" in done.columns:
            path = F.concat(F.lit("applicants["), F.col("tidx").cast("string"), F.lit("].evaluation_results"))
            value = F.to_json(F.struct(F.struct(F.lit(R.APPROVED).alias("evaluation_code"), F.array().cast("array<string>").alias("triggered_rule_codes")).alias("income")))
            listed.append(F.when(F.col(f"_tit{k}"), row(name, k, path, value)))
    kind = "struct<step: int, execution_id: string, fn_name: string, path: string, value_type: string, value: string>"
    key = F.col("id").cast("string").alias("id")
    rows = F.filter(F.array(*listed), lambda x: x.isNotNull()) if listed else F.array().cast(f"array<{kind}>")
    out = done.select(key, F.inline(rows))
    if not averaged:
        return out
    changed = income.where(F.col("has_obs") & (F.col("avg_6m") != 0)).select(F.col("request_id"), "idx", "avg_6m")
    # The average runs for the first time in at most one step of a request.
    first = [F.when(F.col(mark), F.col("_at" + mark[4:])) for mark in averaged]
    name = "fn_calcular_promedio_renta"
    if len(averaged) == 1 and averaged[0] == "_inc0":  # the entry: every request, as its first step
        at, rows = F.lit(0), changed.withColumnRenamed("request_id", "id")
    else:
        at = F.col("at")
        ran = done.select(F.col("id"), F.coalesce(*first).alias("at")).where("at is not null")
        rows = changed.join(ran, changed.request_id == ran.id).drop("request_id")
    path = F.concat(F.lit("applicants["), F.col("idx").cast("string"), F.lit("].calculated_metrics"))
    return out.unionByName(rows.select(
        key, at.cast("int").alias("step"), F.concat(F.lit("exec-"), (at + 1).cast("string")).alias("execution_id"), F.lit(name).alias("fn_name"),
        path.alias("path"), F.lit("object").alias("value_type"), metrics_json(F.col("avg_6m")).alias("value")))
