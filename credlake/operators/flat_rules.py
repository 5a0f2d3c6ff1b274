"""The p0 and flow-6 decisions on flat tables (R7, R8 without nesting).

This is the scale path: no document is ever built, every per-request value
is a partial+final hash aggregate, so a request (or a hot key) holding a
third of all rows costs one row per task before the shuffle.  The nested
runner in ``credlake.operators.flows`` and this module give the same
decisions; the nested one also keeps the execution trail.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from credlake.operators import rules as R


def payslip_totals(applicants: DataFrame, payslips: DataFrame) -> DataFrame:
    """Applicants with ``n_pay``/``s_pay`` from a separate payslip table."""
    pay = payslips.groupBy("request_id", "pos").agg(
        F.count(F.lit(1)).alias("n_pay"), F.sum(F.col("net_income").cast("decimal(38,2)")).alias("s_pay"))
    return applicants.join(pay, ["request_id", "pos"], "left")


def applicant_income(with_pay: DataFrame) -> DataFrame:
    """A10 per applicant: ``avg_6m`` and whether an observation is emitted.
    Input: applicants with ``n_pay`` and ``s_pay`` (NULL/0 when none)."""
    a = with_pay
    dep = F.col("income_type") == "DEPENDENT"
    has = dep & (F.coalesce(F.col("n_pay"), F.lit(0)) > 0)
    total = F.when(dep, F.coalesce(F.col("s_pay"), F.lit(0).cast("decimal(38,2)"))).otherwise(
        F.lit(0).cast("decimal(38,2)"))
    return a.select(
        "request_id", "pos", "role", "income_type", "is_hard_debt",
        F.when(has, (F.col("s_pay") / F.col("n_pay")).cast("double")).otherwise(F.lit(0.0)).alias("avg_6m"),
        has.alias("has_obs"),
        total.alias("income_total"),
        F.when(dep, F.coalesce(F.col("n_pay"), F.lit(0))).otherwise(F.lit(0)).cast("int").alias("n_payslips"),
    )


def _per_request(requests: DataFrame, with_pay: DataFrame) -> DataFrame:
    inc = applicant_income(with_pay)
    tpos = F.when(F.col("role") == "TITULAR", F.col("pos"))
    # min / min_by keep fixed-width buffers: a hash aggregate, not a sort.
    per = inc.groupBy("request_id").agg(
        F.min(tpos).alias("tpos"),
        F.min_by(F.col("avg_6m"), tpos).alias("tavg"),
        F.min_by(F.col("income_total"), tpos).alias("ttotal"),
        F.min_by(F.col("n_payslips"), tpos).alias("tpays"),
        F.count_if(F.coalesce(F.col("is_hard_debt"), F.lit(False))).alias("n_hard"),
        F.count_if("has_obs").alias("n_obs"),
    )
    r = requests.join(per, requests.id == per.request_id, "left")
    return r.select(
        F.col("id"), F.col("monthly_rent"),
        F.col("tpos"), F.col("tavg"), F.col("ttotal"), F.col("tpays"),
        F.coalesce(F.col("n_hard"), F.lit(0)).alias("n_hard"),
        F.coalesce(F.col("n_obs"), F.lit(0)).alias("n_obs"),
    )


def _codes(*parts):
    return F.array_join(F.filter(F.flatten(F.array(*parts)), lambda x: x.isNotNull()), ",")


def p0_flat(requests: DataFrame, with_pay: DataFrame) -> DataFrame:
    """R7 on flat tables: same columns as ``flows.decision_summary``.
    ``with_pay``: applicants with ``n_pay``/``s_pay`` (``payslip_totals``)."""
    k = _per_request(requests, with_pay)
    has_t = F.col("tpos").isNotNull()
    branch = has_t & (F.col("tavg") > 0)
    low = branch & (F.col("tavg") < F.col("monthly_rent") * R.RENT_FACTOR)
    n_hard = F.col("n_hard").cast("int")
    dicom = F.when(branch, F.array_repeat(F.lit(R.CODE_DICOM), n_hard)).otherwise(F.array().cast("array<string>"))
    other = (F.when(low, F.lit(R.CODE_LOW_INCOME))
             .when(~has_t, F.lit(R.CODE_NO_TITULAR))
             .when(~branch, F.lit(R.CODE_NO_INCOME)))
    rejected = ~branch | (n_hard > 0) | low
    extra_obs = F.when(branch, n_hard + F.when(low, 1).otherwise(0)).otherwise(F.lit(1))
    return k.select(
        F.col("id").cast("string").alias("id"),
        F.when(rejected, F.lit(R.REJECTED)).otherwise(F.lit(R.APPROVED)).alias("final_decision_code"),
        _codes(dicom, F.array(other)).alias("blocking_rule_codes"),
        F.when(~has_t, F.lit(None)).when(branch & ~low, F.lit(R.APPROVED)).otherwise(F.lit("PENDING"))
        .alias("titular_income_code"),
        F.col("ttotal").alias("titular_income_total"),
        F.col("tpays").alias("titular_payslips"),
        (F.col("n_obs").cast("int") + extra_obs).alias("n_observations"),
        F.when(branch, F.lit(3)).otherwise(F.lit(2)).alias("n_trail"),
    )


def flow6_flat(requests: DataFrame, with_pay: DataFrame) -> DataFrame:
    """R8 on flat tables: A10, rent rule, finalize."""
    k = _per_request(requests, with_pay)
    has_t = F.col("tpos").isNotNull()
    low = has_t & (F.col("tavg") < F.col("monthly_rent") * R.RENT_FACTOR)
    code = F.when(~has_t, F.lit(R.CODE_NO_TITULAR)).when(low, F.lit(R.CODE_LOW_INCOME))
    return k.select(
        F.col("id").cast("string").alias("id"),
        F.when(code.isNotNull(), F.lit(R.REJECTED)).otherwise(F.lit(R.APPROVED)).alias("final_decision_code"),
        F.coalesce(code, F.lit("")).alias("blocking_rule_codes"),
        F.when(~has_t, F.lit(None)).when(~low, F.lit(R.APPROVED)).otherwise(F.lit("PENDING"))
        .alias("titular_income_code"),
        F.col("ttotal").alias("titular_income_total"),
        F.col("tpays").alias("titular_payslips"),
        (F.col("n_obs").cast("int") + F.when(code.isNotNull(), 1).otherwise(0)).alias("n_observations"),
        F.lit(2).alias("n_trail"),
    )


# Positions per block when ranking applicants inside a request.
POS_BLOCK = 4096


def with_applicant_index(applicants: DataFrame) -> DataFrame:
    """Adds ``idx``: the 0-based position of an applicant inside its request
    (rank of ``pos``), as the nested document's array index.

    A window over a whole request would put a hot request into one task, so
    positions are split into blocks: rows are ranked inside (request, block)
    groups of at most ``POS_BLOCK`` positions, and each block is offset by
    the counts of the blocks before it (a window over one row per block)."""
    blk = F.floor(F.col("pos") / F.lit(POS_BLOCK)).cast("long")
    keyed = applicants.withColumn("_blk", blk)
    counts = keyed.groupBy("request_id", "_blk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("request_id").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("request_id", "_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    ranked = keyed.withColumn("_rn", F.row_number().over(Window.partitionBy("request_id", "_blk").orderBy("pos")))
    return (ranked.join(offsets, ["request_id", "_blk"])
            .withColumn("idx", (F.col("_off") + F.col("_rn") - 1).cast("int"))
            .drop("_blk", "_rn", "_off"))


def p0_audit_paths(requests: DataFrame, with_pay: DataFrame, flow: str = "p0") -> DataFrame:
    """R12 exploded on flat tables for the ``p0`` or ``flow-6`` flow: one row
    per changed part of each step (request, step, execution id, function,
    path, value type)."""
    inc = with_applicant_index(applicant_income(with_pay))
    tpos = F.when(F.col("role") == "TITULAR", F.col("pos"))
    per = inc.groupBy("request_id").agg(
        F.min(tpos).alias("tpos"), F.min_by(F.col("avg_6m"), tpos).alias("tavg"),
        F.min_by(F.col("idx"), tpos).alias("tidx"),
        F.count_if(F.coalesce(F.col("is_hard_debt"), F.lit(False))).alias("n_hard"))
    k = requests.join(per, requests.id == per.request_id, "left").select(
        F.col("id").cast("string").alias("id"), "monthly_rent", "tpos", "tavg", "tidx",
        F.coalesce(F.col("n_hard"), F.lit(0)).alias("n_hard"))
    has_t = F.col("tpos").isNotNull()
    branch = has_t & (F.col("tavg") > 0)
    low = branch & (F.col("tavg") < F.col("monthly_rent") * R.RENT_FACTOR)

    def row(step: int, fn: object, path) -> list:
        return [F.lit(step).alias("step"), F.lit(f"exec-{step + 1}").alias("execution_id"),
                (F.lit(fn) if isinstance(fn, str) else fn).alias("fn_name"), path.alias("path"),
                F.lit("object").alias("value_type")]

    step1 = inc.where(F.col("has_obs") & (F.col("avg_6m") != 0)).select(
        F.col("request_id").cast("string").alias("id"),
        *row(0, "fn_calcular_promedio_renta",
             F.concat(F.lit("applicants["), F.col("idx").cast("string"), F.lit("].calculated_metrics"))))
    evaluation = F.concat(F.lit("applicants["), F.col("tidx").cast("string"), F.lit("].evaluation_results"))
    if flow == "flow-6":
        # Rent rule right after the average: no titular or too little income rejects.
        low6 = has_t & (F.col("tavg") < F.col("monthly_rent") * R.RENT_FACTOR)
        step2 = k.select("id", *row(1, "rl_renta_minima",
                                    F.when(~has_t | low6, F.lit("decision")).otherwise(evaluation)))
        return step1.unionByName(step2)
    step2 = k.where(~branch | (F.col("n_hard") > 0)).select(
        "id", *row(1, F.when(branch, F.lit("rl_check_dicom")).otherwise(F.lit("rl_sin_ingresos")),
                   F.lit("decision")))
    step3 = k.where(branch).select(
        "id", *row(2, "rl_renta_minima", F.when(low, F.lit("decision")).otherwise(
            F.concat(F.lit("applicants["), F.col("tidx").cast("string"), F.lit("].evaluation_results")))))
    return step1.unionByName(step2).unionByName(step3)
