"""Template operators of the function library and the product catalogue
(P11, P12, P13, J2, J3, J7, K7, A11, A15, A18, T3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.functions.labels import label_name

# ------------------------------------------------------------------ P11 / P12 / T3


def catalog_search(df: DataFrame, q: str, fields: tuple[str, ...] = ("name", "description"),
                   status_col: str | None = None, status: str = "all") -> DataFrame:
    """Case-insensitive substring on any of ``fields`` AND an optional
    equality filter (``'all'`` = off).  ``contains``, not LIKE: ``%`` and
    ``_`` in ``q`` are literal."""
    needle = F.lit(q.lower())
    cond = None
    for f in fields:
        c = F.coalesce(F.lower(F.col(f)), F.lit("")).contains(needle)
        cond = c if cond is None else (cond | c)
    if status_col and status != "all":
        cond = cond & (F.col(status_col) == F.lit(status))
    return df.where(cond)


def keyed_lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Rows whose key equals a value (pushed down to the scan)."""
    return df.where(F.col(key) == F.lit(value))


def sort_key(field: str, order: str = "asc", text: bool = False) -> Column:
    """T3's order; ``text`` compares lower-cased, close to a locale compare."""
    key = F.lower(F.col(field)) if text else F.col(field)
    return key.desc() if order == "desc" else key.asc()


def catalog_sort(df: DataFrame, field: str, order: str = "asc", text: bool = False) -> DataFrame:
    """Sort by a field (``ranking.with_rank`` gives each row its place instead)."""
    return df.orderBy(sort_key(field, order, text))


def query_database(spark: SparkSession, sql: str, params: list | None = None) -> DataFrame:
    """Parameterised SQL with ``?`` markers; all rows."""
    return spark.sql(sql, args=list(params or []))


# ------------------------------------------------------------------ J2 / A18
def catalog_rollup(flows: DataFrame, names: DataFrame) -> DataFrame:
    """Keep a product's flows whose id OR name is in ``names``.

    An OR join condition would make Spark fall back to a nested-loop join.
    Instead the names are made distinct and joined twice with equi left
    joins (by id, by name), which cannot duplicate a flow; one scan of the
    flows, and a flow is kept when either join matched."""
    n = names.select("name").where(F.col("name").isNotNull()).distinct()
    by_id = n.select(F.col("name").alias("_k1"), F.lit(True).alias("_m1"))
    by_name = n.select(F.col("name").alias("_k2"), F.lit(True).alias("_m2"))
    j = (flows.join(by_id, F.col("flow_id") == F.col("_k1"), "left")
         .join(by_name, F.col("flow_name") == F.col("_k2"), "left"))
    keep = F.coalesce(F.col("_m1"), F.lit(False)) | F.coalesce(F.col("_m2"), F.lit(False))
    return j.where(keep).drop("_k1", "_m1", "_k2", "_m2")


def catalog_counts(visible_flows: DataFrame) -> DataFrame:
    """A18 per product: active and total visible flows (products with none are absent)."""
    return visible_flows.groupBy("product_id").agg(
        F.count_if(F.col("flow_status") == "active").alias("active_flows"),
        F.count(F.lit(1)).alias("total_flows"),
    )


def catalog_totals(per_product: DataFrame) -> DataFrame:
    """A18 totals over visible products."""
    return per_product.agg(
        F.count(F.lit(1)).alias("visible_products"),
        F.count_if(F.col("active_flows") > 0).alias("products_with_active_flows"),
        F.sum("total_flows").alias("total_flows"),
        F.sum("active_flows").alias("total_active_flows"),
    )


# ------------------------------------------------------------------ J3
# Products recommended per decision code (name, tag).
RECOMMENDED = [
    ("APROBADO", 1, "Crédito de consumo", "Originación"),
    ("APROBADO", 2, "Cuenta sueldo premium", "Cross-sell"),
    ("RECHAZADO", 1, "Cuenta digital básica", "Bajo riesgo"),
    ("RECHAZADO", 2, "Educación financiera", "Recuperación"),
    ("ERROR_EVALUACION", 1, "Revisión manual del ejecutivo", "Validación"),
    ("ERROR_EVALUACION", 2, "Preaprobación condicionada", "Pendiente"),
    ("DEFAULT", 1, "Evaluación comercial", "Espera"),
]


def recommendation_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RECOMMENDED, "code string, rank int, product string, tag string")


def recommend_products(df: DataFrame, code_col: str = "resultado_final") -> DataFrame:
    """1..2 products per decision code; unknown or NULL codes get the
    default row.  Codes match exactly (``ERROR_EVALUACION: ...`` is unknown).
    The dimension has 7 rows, so it is broadcast."""
    dim = recommendation_table(df.sparkSession)
    known = [c for c, *_ in RECOMMENDED if c != "DEFAULT"]
    key = F.when(F.col(code_col).isin(known), F.col(code_col)).otherwise(F.lit("DEFAULT"))
    return df.withColumn("_code", key).join(F.broadcast(dim), F.col("_code") == dim.code).drop("_code", "code")


# ------------------------------------------------------------------ J7
def check_permissions(requests: DataFrame, user_roles: DataFrame, role_permissions: DataFrame) -> DataFrame:
    """Adds ``allowed`` = some role of the user holds ``resource:action``.

    Equi-joins only: what each user holds (distinct user and permission,
    through the roles) is joined to the requests as a flag, so every request
    gives one row, repeated requests included."""
    held = (user_roles.select(F.col("user_id").alias("_user"), "role").join(role_permissions.select("role", F.col("permission").alias("_held")), "role")
            .select("_user", "_held").distinct())
    needed = requests.withColumn("_perm", F.concat(F.col("resource"), F.lit(":"), F.col("action")))
    flagged = needed.join(held, (F.col("user_id") == F.col("_user")) & (F.col("_perm") == F.col("_held")), "left")
    return flagged.select(*requests.columns, F.col("_held").isNotNull().alias("allowed"))


# ------------------------------------------------------------------ K7
def delete_records(df: DataFrame, keys: DataFrame, key: str = "id") -> DataFrame:
    """K7: rows whose key is not in ``keys`` (anti join); write the result
    back with ``mode('overwrite')`` to apply the delete."""
    return df.join(keys.select(key), key, "left_anti")


# ------------------------------------------------------------------ A11 / A15
def value_counts(df: DataFrame, label: str, names: bool = True) -> DataFrame:
    """Frequency per (mapped) label, most frequent first."""
    lab = label_name(F.col(label)) if names else F.col(label)
    return df.groupBy(lab.alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label")


def aggregate_data(df: DataFrame, operations: dict[str, str]) -> DataFrame:
    """``{field: sum|avg|count}``; an absent value counts as 0 in sum
    and avg; count is all rows; avg of no rows is NULL.  Sums are exact in
    steps of 1e-6, to which every value is rounded first; a NaN among the
    values makes the sum NULL, since a DECIMAL has no NaN, and the avg NaN."""
    aggs: list[Column] = []
    for field, op in operations.items():
        v = F.coalesce(F.col(field).cast("double"), F.lit(0.0)) if field in df.columns else F.lit(0.0)
        if op == "sum":
            total = F.sum(F.when(~F.isnan(v), v).cast("decimal(38,6)"))
            aggs.append(F.when(~F.coalesce(F.bool_or(F.isnan(v)), F.lit(False)), total).alias(field))
        elif op == "avg":
            aggs.append(F.avg(v).alias(field))
        elif op == "count":
            aggs.append(F.count(F.lit(1)).alias(field))
    return df.agg(*aggs)
