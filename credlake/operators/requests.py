"""Rental requests as nested rows (S2 schema, P4, P5, P6, W1).

A request is one row: ``id``, ``context`` struct, ``applicants`` array of
structs (each with ``income_source.dependent.payslips``), ``fn_history``,
``decision``, ``audit``, ``observations``.  Rules work on the arrays with
higher-order functions, so nothing is exploded and re-grouped per rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ------------------------------------------------------------------ schema
PAYSLIP = T.StructType([
    T.StructField("month_index", T.IntegerType()),
    T.StructField("net_income", T.DoubleType()),
    T.StructField("period", T.StringType()),
    T.StructField("gross_income", T.DoubleType()),
])
INCOME_SOURCE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("dependent", T.StructType([T.StructField("payslips", T.ArrayType(PAYSLIP))])),
])
IDENTITY = T.StructType([T.StructField("full_name", T.StringType()), T.StructField("document_type", T.StringType())])
COMMERCIAL = T.StructType([
    T.StructField("dicom", T.StructType([T.StructField("is_hard_debt", T.BooleanType()),
                                         T.StructField("score", T.IntegerType())])),
    T.StructField("estimated_monthly_debt_payment", T.DoubleType()),
])
QUALITATIVE = T.StructType([
    T.StructField("presentation", T.StringType()),
    T.StructField("previous_landlord_comments", T.StringType()),
    T.StructField("family_size", T.IntegerType()),
    T.StructField("has_pets", T.IntegerType()),
    T.StructField("references_count", T.IntegerType()),
])
METRICS = T.StructType([
    T.StructField("income", T.StructType([T.StructField("avg_6m", T.DoubleType())])),
    T.StructField("financial_load", T.StructType([T.StructField("debt_to_income_ratio", T.DoubleType())])),
])
RESULTS = T.StructType([
    T.StructField("income", T.StructType([
        T.StructField("evaluation_code", T.StringType()),
        T.StructField("triggered_rule_codes", T.ArrayType(T.StringType())),
    ])),
])
APPLICANT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("income_source", INCOME_SOURCE),
    T.StructField("identity", IDENTITY),
    T.StructField("commercial_data", COMMERCIAL),
    T.StructField("qualitative_data", QUALITATIVE),
    T.StructField("calculated_metrics", METRICS),
    T.StructField("evaluation_results", RESULTS),
])
IO_ITEM = T.StructType([T.StructField("path", T.StringType()), T.StructField("value_type", T.StringType()),
                        T.StructField("value", T.StringType())])
HISTORY = T.StructType([
    T.StructField("execution_id", T.StringType()),
    T.StructField("fn_name", T.StringType()),
    T.StructField("executed_at", T.StringType()),
    T.StructField("inputs", T.ArrayType(IO_ITEM)),
    T.StructField("outputs", T.ArrayType(IO_ITEM)),
])
DECISION = T.StructType([
    T.StructField("final_decision_code", T.StringType()),
    T.StructField("blocking_rule_codes", T.ArrayType(T.StringType())),
    T.StructField("required_action_codes", T.ArrayType(T.StringType())),
])
OBSERVATION = T.StructType([T.StructField("fn_name", T.StringType()), T.StructField("message", T.StringType()),
                            T.StructField("value", T.StringType())])
CONTEXT = T.StructType([T.StructField("property_id", T.StringType()), T.StructField("monthly_rent", T.DoubleType()),
                        T.StructField("currency", T.StringType())])
REQUEST = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("context", CONTEXT),
    T.StructField("applicants", T.ArrayType(APPLICANT)),
    T.StructField("fn_history", T.ArrayType(HISTORY)),
    T.StructField("decision", DECISION),
    T.StructField("audit", T.StructType([T.StructField("evaluated_at", T.StringType())])),
    T.StructField("observations", T.ArrayType(OBSERVATION)),
])
# Input files wrap the request as ``{"solicitud": {...}}`` or give it bare.
REQUEST_FILE = T.StructType([T.StructField("solicitud", REQUEST)] + list(REQUEST.fields))

# Defaults of the request model.
PENDING = "PENDING"
DEFAULT_DICOM_SCORE = 999


def _empty(t: T.DataType) -> Column:
    return F.array().cast(T.ArrayType(t))


# ------------------------------------------------------------------ P5
def _default_applicant(a: Column) -> Column:
    """Fill the model defaults of one applicant (unknown keys were dropped by the schema)."""
    pays = F.transform(F.coalesce(a.income_source.dependent.payslips, _empty(PAYSLIP)), lambda p: F.struct(
        p.month_index.alias("month_index"), p.net_income.alias("net_income"),
        F.coalesce(p.period, F.lit("")).alias("period"), F.coalesce(p.gross_income, F.lit(0.0)).alias("gross_income")))
    dep = F.when(a.income_source.dependent.isNotNull(), F.struct(pays.alias("payslips")))
    dicom = a.commercial_data.dicom
    return F.struct(
        a.id.alias("id"), a.role.alias("role"),
        F.struct(a.income_source.type.alias("type"), dep.alias("dependent")).alias("income_source"),
        F.struct(F.coalesce(a.identity.full_name, F.lit("")).alias("full_name"),
                 F.coalesce(a.identity.document_type, F.lit("")).alias("document_type")).alias("identity"),
        F.struct(
            F.when(dicom.isNotNull(), F.struct(F.coalesce(dicom.is_hard_debt, F.lit(False)).alias("is_hard_debt"),
                                               F.coalesce(dicom.score, F.lit(DEFAULT_DICOM_SCORE)).alias("score"))
                   ).alias("dicom"),
            F.coalesce(a.commercial_data.estimated_monthly_debt_payment, F.lit(0.0)).alias("estimated_monthly_debt_payment"),
        ).alias("commercial_data"),
        F.struct(F.coalesce(a.qualitative_data.presentation, F.lit("")).alias("presentation"),
                 F.coalesce(a.qualitative_data.previous_landlord_comments, F.lit("")).alias("previous_landlord_comments"),
                 F.coalesce(a.qualitative_data.family_size, F.lit(0)).alias("family_size"),
                 F.coalesce(a.qualitative_data.has_pets, F.lit(0)).alias("has_pets"),
                 F.coalesce(a.qualitative_data.references_count, F.lit(0)).alias("references_count")
                 ).alias("qualitative_data"),
        F.struct(F.struct(F.coalesce(a.calculated_metrics.income.avg_6m, F.lit(0.0)).alias("avg_6m")).alias("income"),
                 F.struct(F.coalesce(a.calculated_metrics.financial_load.debt_to_income_ratio, F.lit(0.0))
                          .alias("debt_to_income_ratio")).alias("financial_load")).alias("calculated_metrics"),
        F.struct(F.struct(
            F.coalesce(a.evaluation_results.income.evaluation_code, F.lit(PENDING)).alias("evaluation_code"),
            F.coalesce(a.evaluation_results.income.triggered_rule_codes, _empty(T.StringType()))
            .alias("triggered_rule_codes")).alias("income")).alias("evaluation_results"),
    )


def project_request(df: DataFrame) -> DataFrame:
    """P5: keep the known fields and fill every default; input has ``REQUEST`` fields."""
    d = F.col("decision")
    return df.select(
        F.col("id").cast("string").alias("id"),
        F.col("context"),
        F.transform(F.coalesce(F.col("applicants"), _empty(APPLICANT)), _default_applicant).alias("applicants"),
        F.coalesce(F.col("fn_history"), _empty(HISTORY)).alias("fn_history"),
        F.struct(F.coalesce(d.final_decision_code, F.lit(PENDING)).alias("final_decision_code"),
                 F.coalesce(d.blocking_rule_codes, _empty(T.StringType())).alias("blocking_rule_codes"),
                 F.coalesce(d.required_action_codes, _empty(T.StringType())).alias("required_action_codes")
                 ).alias("decision"),
        F.struct(F.coalesce(F.col("audit.evaluated_at"), F.lit("")).alias("evaluated_at")).alias("audit"),
        F.coalesce(F.col("observations"), _empty(OBSERVATION)).alias("observations"),
        *[c for c in df.columns if c.startswith("_") and c not in ("_id",)],
    )


def unwrap(df: DataFrame) -> DataFrame:
    """The ``solicitud`` field if present, else the object itself."""
    inner = F.col("solicitud")
    cols = [F.when(inner.isNotNull(), inner[f.name]).otherwise(F.col(f.name)).alias(f.name) for f in REQUEST.fields]
    extra = [c for c in df.columns if c.startswith("_")]
    return df.select(*cols, *extra)


def to_document(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON text per request, NULL fields omitted."""
    return df.select("id", *keep, F.to_json(F.struct(*[F.col(f.name) for f in REQUEST.fields])).alias("document"))


# ------------------------------------------------------------------ W1
def titular_index(applicants: Column) -> Column:
    """0-based index of the first applicant with role TITULAR, -1 when none."""
    return F.array_position(F.transform(applicants, lambda a: a.role), F.lit("TITULAR")).cast("int") - 1


def titular(applicants: Column) -> Column:
    """First TITULAR in array order, else NULL."""
    return F.get(F.filter(applicants, lambda a: a.role == "TITULAR"), 0)


# ------------------------------------------------------------------ build from flat tables
def group_applicants(applicants: DataFrame, payslips: DataFrame | None = None) -> DataFrame:
    """Flat applicant rows -> ``request_id, _apps`` (slim structs sorted by
    position).  ``applicants`` either carries an ``incomes`` array already or
    ``payslips`` rows are grouped per (request, position) and joined.  Only
    the varying fields cross the shuffle."""
    if payslips is not None:
        inc = (payslips.groupBy("request_id", "pos")
               .agg(F.collect_list(F.col("net_income").cast("double")).alias("incomes")))
        applicants = applicants.join(inc, ["request_id", "pos"], "left")
    slim = F.struct(F.col("pos"), F.col("role"), F.col("income_type"), F.col("is_hard_debt"),
                    F.col("incomes").cast("array<double>").alias("incomes"))
    return applicants.groupBy("request_id").agg(F.sort_array(F.collect_list(slim)).alias("_apps"))


def build_requests(requests: DataFrame, applicants: DataFrame, payslips: DataFrame | None = None) -> DataFrame:
    """Nest requests and their applicants into request documents.

    ``applicants`` is either flat rows (see ``group_applicants``) or already
    grouped per request (``request_id, _apps``).  A request's group is small
    by nature (a handful of applicants, each with a handful of payslips);
    payslips are ordered by income so sums are deterministic, applicants by
    position.  The full applicant struct with its constant defaults is built
    after the shuffle, inside ``transform``.
    """
    grouped = applicants if "_apps" in applicants.columns else group_applicants(applicants, payslips)

    def full(x: Column) -> Column:
        pays = F.transform(F.sort_array(x.incomes), lambda v, i: F.struct(
            (i + 1).cast("int").alias("month_index"), v.alias("net_income"),
            F.lit("").alias("period"), F.lit(0.0).alias("gross_income")))
        dep = F.when(x.income_type == "DEPENDENT", F.struct(F.coalesce(pays, _empty(PAYSLIP)).alias("payslips")))
        return F.struct(
            F.concat(F.col("request_id").cast("string"), F.lit("-"), x.pos.cast("string")).alias("id"),
            x.role.alias("role"),
            F.struct(x.income_type.alias("type"), dep.alias("dependent")).alias("income_source"),
            F.struct(F.lit("").alias("full_name"), F.lit("").alias("document_type")).alias("identity"),
            F.struct(F.struct(x.is_hard_debt.alias("is_hard_debt"), F.lit(DEFAULT_DICOM_SCORE).alias("score"))
                     .alias("dicom"), F.lit(0.0).alias("estimated_monthly_debt_payment")).alias("commercial_data"),
            F.struct(F.lit("").alias("presentation"), F.lit("").alias("previous_landlord_comments"),
                     F.lit(0).alias("family_size"), F.lit(0).alias("has_pets"),
                     F.lit(0).alias("references_count")).alias("qualitative_data"),
            F.struct(F.struct(F.lit(0.0).alias("avg_6m")).alias("income"),
                     F.struct(F.lit(0.0).alias("debt_to_income_ratio")).alias("financial_load"))
            .alias("calculated_metrics"),
            F.struct(F.struct(F.lit(PENDING).alias("evaluation_code"),
                              _empty(T.StringType()).alias("triggered_rule_codes")).alias("income"))
            .alias("evaluation_results"),
        )

    nested = grouped.select("request_id", F.transform("_apps", full).alias("applicants"))
    r = requests.join(nested, requests.id == nested.request_id, "left")
    return r.select(
        F.col("id").cast("string").alias("id"),
        F.struct(F.col("property_id"), F.col("monthly_rent").cast("double").alias("monthly_rent"),
                 F.col("currency")).alias("context"),
        F.coalesce(F.col("applicants"), _empty(APPLICANT)).alias("applicants"),
        _empty(HISTORY).alias("fn_history"),
        F.struct(F.lit(PENDING).alias("final_decision_code"), _empty(T.StringType()).alias("blocking_rule_codes"),
                 _empty(T.StringType()).alias("required_action_codes")).alias("decision"),
        F.struct(F.lit("").alias("evaluated_at")).alias("audit"),
        _empty(OBSERVATION).alias("observations"),
    )
