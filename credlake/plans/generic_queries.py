"""Registered template, catalogue, sampling and metric queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.functions.scoring import decrypt_column, encrypt_column
from credlake.operators import generic, p0, stats
from credlake.operators.sampling import in_sample, sample_cut, stratified_split
from credlake.session import cut_lineage
from credlake.plans.registry import query
from credlake.plans.sql_views import with_views
from credlake.sources import views
from credlake.sources.tables import read_table, register_tables

# ------------------------------------------------------------------ catalogue
_VISIBLE = """vis as (
  select * from products p
  where exists (select 1 from available_names n where n.name = p.flow_id or n.name = p.flow_name)
)"""


def _visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generic.catalog_rollup(views.products(spark, sf_dir), views.available_flow_names(spark, sf_dir))


@query("catalog_rollup", with_views(["products", "available_names"], """
select product_id, cast(sum(case when flow_status = 'active' then 1 else 0 end) as bigint) as active_flows,
  count(*) as total_flows
from vis group by product_id""", _VISIBLE))
def catalog_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + A18: visible flows per product (id OR name available)."""
    return generic.catalog_counts(_visible(spark, sf_dir))


@query("catalog_totals", with_views(["products", "available_names"], """
select count(*) as visible_products, cast(sum(case when active_flows > 0 then 1 else 0 end) as bigint) as products_with_active_flows,
  cast(sum(total_flows) as bigint) as total_flows, cast(sum(active_flows) as bigint) as total_active_flows
from (select product_id, sum(case when flow_status = 'active' then 1 else 0 end) as active_flows, count(*) as total_flows
      from vis group by product_id) t""", _VISIBLE))
def catalog_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A18 totals over the visible products."""
    return generic.catalog_totals(generic.catalog_counts(_visible(spark, sf_dir)))


CATALOG_QUERY = "ring"


@query("catalog_search", with_views(["products"], f"""
select product_id, flow_id, flow_name, flow_status from products
where (contains(lower(flow_name), '{CATALOG_QUERY}') or contains(lower(product_id), '{CATALOG_QUERY}'))
  and flow_status = 'active'
order by lower(flow_name)"""))
def catalog_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 + T3: case-insensitive search with a status filter, sorted by name."""
    found = generic.catalog_search(views.products(spark, sf_dir), CATALOG_QUERY, ("flow_name", "product_id"),
                                   "flow_status", "active")
    return generic.catalog_sort(found, "flow_name", "asc", text=True)


# ------------------------------------------------------------------ J3
_REC_VALUES = ", ".join(
    "('{}', {}, '{}', '{}')".format(c, r, p.replace("'", "''"), t) for c, r, p, t in generic.RECOMMENDED)


@query("recommend_products", with_views(["risk_input"], f"""
select s.id, s.resultado_final, d.rank, d.product, d.tag
from (select id, case when round_even(p_riesgo*100e0, 0) >= 40 then 'RECHAZADO' else 'APROBADO' end as resultado_final
      from risk_input
      where ingreso_mensual > 0 and score_crediticio >= 300 and score_crediticio <= 850 and monto_solicitado > 0
        and antiguedad_laboral_meses >= 0 and deuda_actual >= 0) s
join (values {_REC_VALUES}) d(code, rank, product, tag)
  on d.code = case when s.resultado_final in ('APROBADO', 'RECHAZADO', 'ERROR_EVALUACION') then s.resultado_final else 'DEFAULT' end"""))
def recommend_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products offered for each scored application's decision."""
    scored, _ = p0.bulk_score(views.risk_input(spark, sf_dir))
    rec = generic.recommend_products(scored.select("id", "resultado_final"))
    return rec.select("id", "resultado_final", "rank", "product", "tag")


# ------------------------------------------------------------------ J7
@query("permissions", with_views(["user_roles", "role_permissions", "access_requests"], """
select r.id, r.user_id, r.resource, r.action,
  exists (select 1 from user_roles u join role_permissions p on u.role = p.role
          where u.user_id = r.user_id and p.permission = concat(r.resource, ':', r.action)) as allowed
from access_requests r"""))
def permissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access requests checked against role permissions."""
    return generic.check_permissions(views.access_requests(spark, sf_dir), views.user_roles(spark, sf_dir),
                                     views.role_permissions(spark, sf_dir)).select(
        "id", "user_id", "resource", "action", "allowed")


# ------------------------------------------------------------------ J4 / K7
SAMPLE_FRACTION = 0.01
_H = "((id % 1000003) * 2654435761 + 42) % 1000003"


@query("sample_extract", with_views(["applications"], f"""
select id, case when {_H} < {sample_cut(SAMPLE_FRACTION)} then 'sample' else 'rest' end as part from applications"""))
def sample_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 % sample and the remainder, disjoint and complete."""
    apps = views.applications(spark, sf_dir)
    part = F.when(in_sample(F.col("id"), SAMPLE_FRACTION), F.lit("sample")).otherwise(F.lit("rest"))
    return apps.select("id", part.alias("part"))


@query("delete_records", with_views(["applications"], """
select id from applications a
where not exists (select 1 from orders o where o.o_orderstatus = 'P' and o.o_orderkey = a.id)"""))
def delete_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: delete by key list: the applications whose order is still pending."""
    apps = views.applications(spark, sf_dir)
    keys = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus") \
        .where(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("id"))
    return generic.delete_records(apps.select("id"), keys)


# ------------------------------------------------------------------ A15 / A11
AGG_OPS = {"monto_solicitado": "sum", "ingreso_mensual": "avg", "id": "count"}


@query("aggregate_data", with_views(["applications"], """
select sum(cast(coalesce(monto_solicitado, 0e0) as decimal(38,6))) as monto_solicitado,
  round_even(avg(coalesce(ingreso_mensual, 0e0)), 6) as ingreso_mensual, count(*) as id
from applications"""))
def aggregate_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum / avg / count by field name (the average reported to 6 decimals)."""
    out = generic.aggregate_data(views.applications(spark, sf_dir), AGG_OPS)
    return out.withColumn("ingreso_mensual", F.rint(F.col("ingreso_mensual") * 1e6) / 1e6)


@query("value_counts", with_views(["predictions"], """
select case y when 0 then 'Confiable' when 1 then 'Comportamiento crediticio variable' when 2 then 'Moroso' end as label,
  count(*) as n
from predictions group by 1"""))
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 + F14: label frequencies."""
    return generic.value_counts(views.predictions(spark, sf_dir), "y")


# ------------------------------------------------------------------ A12
DESCRIBE = [("customer", "c_acctbal"), ("orders", "o_totalprice"), ("events", "value")]


def _describe_sql() -> str:
    parts = []
    for t, c in DESCRIBE:
        parts.append(f"""select '{c}' as "column", count({c}) as count, round_even(avg({c}), 2) as mean,
  round_even(stddev_samp({c}), 2) as std, round_even(min({c}), 2) as min,
  round_even(quantile_cont({c}, 0.25), 2) as p25, round_even(quantile_cont({c}, 0.5), 2) as p50,
  round_even(quantile_cont({c}, 0.75), 2) as p75, round_even(max({c}), 2) as max from {t}""")
    return "\nunion all\n".join(parts)


@query("describe", _describe_sql())
def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact describe of three numeric columns."""
    out = None
    for t, c in DESCRIBE:
        d = stats.describe(read_table(spark, sf_dir, t, c), [c])
        out = d if out is None else out.unionByName(d)
    return out


# ------------------------------------------------------------------ A13 / A14 / W2
@query("confusion_matrix", with_views(["predictions"], """
select a.y, b.yhat, count(p.id) as n
from (select distinct y from predictions union select distinct yhat from predictions) a(y)
cross join (select distinct y from predictions union select distinct yhat from predictions) b(yhat)
left join predictions p on p.y = a.y and p.yhat = b.yhat
group by a.y, b.yhat"""))
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13 on the labelled predictions."""
    return stats.confusion_matrix(views.predictions(spark, sf_dir))


_PER_CLASS = """per as (
  select cast(c as varchar) as label, p as precision, r as recall,
    case when p + r > 0 then 2 * p * r / (p + r) else 0e0 end as f1, sp as support
  from (select c, case when pp > 0 then tp / pp else 0e0 end as p, case when sp > 0 then tp / sp else 0e0 end as r, sp
        from (select k.c, cast(sum(case when y = k.c and yhat = k.c then 1 else 0 end) as bigint) as tp,
                cast(sum(case when yhat = k.c then 1 else 0 end) as bigint) as pp,
                cast(sum(case when y = k.c then 1 else 0 end) as bigint) as sp
              from predictions, (select distinct y as c from predictions union select distinct yhat from predictions) k
              group by k.c) t) u
)"""
_REPORT_SQL = with_views(["predictions"], """
select label, precision, recall, f1, support from per
union all
select 'accuracy', null, null, cast(sum(case when y = yhat then 1 else 0 end) as double) / count(*), count(*)
from predictions
union all
select 'macro avg', avg(precision), avg(recall), avg(f1), (select count(*) from predictions) from per
union all
select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), (select count(*) from predictions) from per""", _PER_CLASS)


@query("classification_report", _REPORT_SQL)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class precision / recall / f1 / support, accuracy, averages."""
    return stats.classification_report(views.predictions(spark, sf_dir))


@query("stratified_split", with_views(["predictions"], """
select id, y, rn <= cast(floor(n * 0.2e0 + 0.5e0) as bigint) as is_test from (
  select id, y, row_number() over (partition by y order by ((id % 1000003) * 2654435761 + 42) % 1000003, id) as rn,
    count(*) over (partition by y) as n
  from predictions) t"""))
def stratified_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 80/20 split per class, chosen by key hash."""
    split = stratified_split(views.predictions(spark, sf_dir), "y", 0.2, 42, key="id")
    return split.select("id", "y", "is_test")


# ------------------------------------------------------------------ F20 / P13
# A fixed 256-bit test key (in production it comes from a secret store).
TEST_KEY = "credlake-test-key-0123456789abcd"


@query("encrypt_roundtrip", """
select c_custkey as id, c_name as text, octet_length(encode(c_name)) + 28 as sealed_bytes, false as shows_text, false as opens_with_other_key,
  cast(1 as bigint) as rows_with_this_token from customer""")
def encrypt_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AES-256-GCM of customer names: the text it decrypts to, the sealed
    size (12 bytes IV, 16 bytes tag), and three things that must not hold: the
    text shows in the token, another key opens it, two rows share a token."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    key, other = (F.lit(k.encode("utf-8")[:32]) for k in (TEST_KEY, TEST_KEY[::-1]))
    # Written once: a random IV drawn anew by each use of the column would prove nothing.
    enc = cut_lineage(c.select("c_custkey", "c_name", encrypt_column(F.col("c_name"), key).alias("token")))
    same = enc.groupBy("token").agg(F.count("*").alias("rows_with_this_token"))
    sealed = F.unbase64("token")
    opened = F.try_aes_decrypt(sealed, other, F.lit("GCM"))
    return enc.join(same, "token").select(
        F.col("c_custkey").alias("id"), decrypt_column(F.col("token"), key).alias("text"), F.octet_length(sealed).cast("bigint").alias("sealed_bytes"),
        F.contains(sealed, F.col("c_name").cast("binary")).alias("shows_text"), opened.isNotNull().alias("opens_with_other_key"), "rows_with_this_token")


P13_SQL = ("select o_orderpriority, count(*) as n, min(o_totalprice) as min_price, max(o_totalprice) as max_price "
           "from orders where o_totalprice > ? group by o_orderpriority")
P13_PARAMS = [100000.0]


@query("query_database", """
select o_orderpriority, count(*) as n, min(o_totalprice) as min_price, max(o_totalprice) as max_price
from orders where o_totalprice > 100000e0 group by o_orderpriority""")
def query_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameterised SQL over the registered tables."""
    register_tables(spark, sf_dir)
    return generic.query_database(spark, P13_SQL, P13_PARAMS)


# ------------------------------------------------------------------ P8 / P9
INPUT_RULES = {"txt": {"required": True, "type": "float"}, "id": {"required": True, "type": "int"},
               "extra": {"required": True}}


@query("template_validate_input", """with texts as (
  select o_orderkey as id, case o_orderkey % 8
    when 0 then concat(cast(o_orderkey % 100 as varchar), '%')
    when 1 then concat(' ', cast(o_custkey % 100 as varchar), ' %')
    when 2 then concat(cast(o_orderkey % 1000 as varchar), ',', cast(o_custkey % 10 as varchar))
    when 3 then 'abc' when 4 then ''
    when 5 then concat(cast(o_orderkey % 10 as varchar), ',', cast(o_custkey % 10 as varchar), ',2')
    when 6 then concat('-', cast(o_custkey % 50 as varchar)) end as txt
  from orders
)
select id, errors = '' as is_valid, errors from (
  select id, concat_ws('; ',
    case when txt is null then 'txt is required' end,
    case when txt is not null and txt <> '' and try_cast(txt as double) is null then 'txt must be float' end,
    'extra is required') as errors
  from texts) t""")
def template_validate_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """required/type rules over form-like texts derived from orders."""
    from credlake.operators.validate import validate_input
    from credlake.plans.p0_queries import _texts
    v = validate_input(_texts(spark, sf_dir), INPUT_RULES)
    return v.select("id", "is_valid", F.array_join("errors", "; ").alias("errors"))


@query("template_transform_data", """
select c_custkey as id, c_name as cliente, c_acctbal as saldo, lower(c_mktsegment) as segmento,
  cast(null as varchar) as telefono
from customer""")
def template_transform_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field mapping by name, by expression, and a missing source (NULL)."""
    from credlake.operators.validate import transform_data
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    out = transform_data(c, {"id": "c_custkey", "cliente": "c_name", "saldo": "c_acctbal",
                             "segmento": lambda d: F.lower(F.col("c_mktsegment")), "telefono": "c_phone"})
    return out.withColumn("telefono", F.col("telefono").cast("string"))
