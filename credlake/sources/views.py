"""Adapter views: credit-shaped tables derived from the driver's tables.

The driver's data holds no credit records, so every query reads these
views.  They are plain projections and joins over the base tables, so their
size grows with the data.  The formulas are fixed values shared with the
DuckDB oracle text in ``credlake.plans.sql_views`` (FIXTURES.md, part 3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.sources.tables import read_table

FEATURES = [
    "ingreso_mensual",
    "score_crediticio",
    "monto_solicitado",
    "antiguedad_laboral_meses",
    "deuda_actual",
]


def _score(orderkey: Column, custkey: Column) -> Column:
    return F.lit(250) + (orderkey * 7919 + custkey * 31) % 650


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One application per order: id, the five features and ``es_fraude``.

    Includes invalid incomes (<= 0) and scores outside 300..850 on purpose.
    """
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_acctbal")
    return applications_from(orders, customer)


def applications_from(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """The applications projection over given orders (batch or stream) and customers."""
    j = orders.select("o_orderkey", "o_custkey", "o_totalprice").join(
        customer.select("c_custkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    frac = (ok * 104729) % 1000
    return j.select(
        ok.alias("id"),
        (F.col("c_acctbal") * 400.0).alias("ingreso_mensual"),
        _score(ok, ck).cast("double").alias("score_crediticio"),
        (F.col("o_totalprice") * 20.0).alias("monto_solicitado"),
        ((ck * 13 + ok) % 151).cast("int").alias("antiguedad_laboral_meses"),
        (F.abs(F.col("c_acctbal")) * 400.0 * (frac / 1000.0)).alias("deuda_actual"),
        F.when((frac >= 800) & (_score(ok, ck) < 500), 1).otherwise(0).alias("es_fraude"),
    )


def closed_form_risk(income: Column, debt: Column, score: Column) -> Column:
    """Stand-in for the missing model file: a probability in [0, 1]."""
    ratio = F.when(income > 0, F.lit(0.7) * debt / income).otherwise(F.lit(0.0))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), ratio + F.lit(0.4) * (F.lit(850.0) - score) / F.lit(550.0)))


def risk_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    apps = applications(spark, sf_dir)
    return apps.withColumn(
        "p_riesgo", closed_form_risk(F.col("ingreso_mensual"), F.col("deuda_actual"), F.col("score_crediticio"))
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rental requests: one per order."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("PROP-"), F.col("o_custkey").cast("string")).alias("property_id"),
        (F.col("o_totalprice") * 0.05).alias("monthly_rent"),
        F.lit("CLP").alias("currency"),
    )


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applicants of a request: one per (order, line number)."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_discount")
    agg = li.groupBy(F.col("l_orderkey").alias("request_id"), F.col("l_linenumber").alias("pos")).agg(
        (F.max(_hard_debt()) == 1).alias("is_hard_debt"))
    # Role and income type depend on the keys only: derived after the
    # aggregate, so the aggregate stays a hash aggregate on fixed-width buffers.
    return agg.select("request_id", "pos", *_role_and_type(F.col("request_id"), F.col("pos")), "is_hard_debt")


def _hard_debt() -> Column:
    return F.when((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.09), 1).otherwise(0)


def _role_and_type(ok: Column, ln: Column) -> list[Column]:
    return [F.when((ln <= 3) & (ok % 13 != 0), "TITULAR").otherwise("AVAL").alias("role"),
            F.when((ln % 4 == 3) | (ok % 17 == 0), "INDEPENDENT").otherwise("DEPENDENT").alias("income_type")]


def request_applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applicants grouped per request straight from ``lineitem``:
    ``request_id, _apps`` with the slim applicant structs (``pos, role,
    income_type, is_hard_debt, incomes``) sorted by position, the shape
    ``requests.build_requests`` nests.

    The lines are hash-partitioned by order once; the per-applicant and the
    per-request aggregates then both run inside those partitions (a hash
    partitioning on the order satisfies both groupings), so there is a
    single shuffle and the work per request stays linear in its lines."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_discount",
                    "l_partkey", "l_extendedprice").repartition("l_orderkey")
    is_pay = F.col("l_partkey") % 11 != 0
    per_app = li.groupBy(F.col("l_orderkey").alias("request_id"), F.col("l_linenumber").alias("pos")).agg(
        (F.max(_hard_debt()) == 1).alias("is_hard_debt"),
        F.collect_list(F.when(is_pay, F.col("l_extendedprice").cast("double"))).alias("incomes"))
    role, income_type = _role_and_type(F.col("request_id"), F.col("pos"))
    slim = F.struct(F.col("pos"), role.alias("role"), income_type.alias("income_type"), F.col("is_hard_debt"),
                    F.col("incomes"))
    return per_app.groupBy("request_id").agg(F.sort_array(F.collect_list(slim)).alias("_apps"))


def applicant_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applicants with their payslip count and sum, from ONE scan and ONE
    aggregate of ``lineitem`` (the ``applicants`` and ``payslips`` views
    fused): ``request_id, pos, role, income_type, is_hard_debt, n_pay, s_pay``."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_discount",
                    "l_partkey", "l_extendedprice")
    is_pay = F.col("l_partkey") % 11 != 0
    agg = li.groupBy(F.col("l_orderkey").alias("request_id"), F.col("l_linenumber").alias("pos")).agg(
        (F.max(_hard_debt()) == 1).alias("is_hard_debt"),
        F.count_if(is_pay).alias("n_pay"),
        F.sum(F.when(is_pay, F.col("l_extendedprice").cast("decimal(38,2)"))).alias("s_pay"))
    return agg.select("request_id", "pos", *_role_and_type(F.col("request_id"), F.col("pos")), "is_hard_debt",
                      "n_pay", "s_pay")


def payslips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return li.where(F.col("l_partkey") % 11 != 0).select(
        F.col("l_orderkey").alias("request_id"),
        F.col("l_linenumber").alias("pos"),
        F.col("l_extendedprice").alias("net_income"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product catalogue flattened to one row per flow."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size")
    return p.select(
        F.col("p_brand").alias("product_id"),
        F.col("p_partkey").cast("string").alias("flow_id"),
        F.col("p_name").alias("flow_name"),
        F.when(F.col("p_size") < 20, "active")
        .when(F.col("p_size") < 40, "draft")
        .otherwise("archived")
        .alias("flow_status"),
    )


def available_flow_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", "p_partkey")
    ids = p.where(F.col("p_partkey") % 97 == 0).select(F.col("p_partkey").cast("string").alias("name"))
    return ids.unionByName(spark.range(1).select(F.lit("small ring").alias("name")))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled predictions: ``y`` from ``labels``, ``yhat`` from document length."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "lang", "n_chars")
    lab = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    return d.join(lab, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("quality").alias("y"),
        F.when(F.col("n_chars") > 400, 1).otherwise(0).alias("yhat"),
        "lang",
        "n_chars",
    )


def user_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return c.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("role"))


def role_permissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey).where(F.col("n_nationkey") % 3 == 0)
    mode = F.when(F.length("c_mktsegment") > 9, "write").otherwise("read")
    return j.select(
        F.col("c_mktsegment").alias("role"),
        F.concat(F.col("n_name"), F.lit(":"), mode).alias("permission"),
    ).distinct()


def access_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.concat(F.lit("NATION_"), (F.col("o_orderkey") % 25).cast("string")).alias("resource"),
        F.when(F.col("o_orderkey") % 2 == 0, "read").otherwise("write").alias("action"),
    )
