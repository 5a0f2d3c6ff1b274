"""Orders, lookups and projections whose results other queries only use: the order itself as a rank, keys, vectors, required actions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.operators import flows, generic, lsh, ml, p0
from credlake.operators.ranking import with_rank
from credlake.operators.validate import project_features
from credlake.plans.flow_queries import _flow_sql, nested_requests
from credlake.plans.lsh_queries import _BUCKET_COLS, _signed_sql, signed_applications
from credlake.plans.p0_queries import _p0_sql
from credlake.plans.registry import query
from credlake.plans.sql_views import with_views
from credlake.sources import views

FEATURES = views.FEATURES


# ------------------------------------------------------------------ T1, T2, T3, A11: the order as a column
@query("lsh_buckets_ranked", _signed_sql(f"""
select firma_lsh, total_solicitudes, fraudes_detectados, probabilidad_fraude_pct,
  row_number() over (order by probabilidad_fraude_pct desc, total_solicitudes desc, firma_lsh) as rank
from (select {_BUCKET_COLS} from signed group by firma_lsh) b where fraudes_detectados > 0"""))
def lsh_buckets_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 over all buckets with fraud, with their ranks."""
    signed, _ = signed_applications(spark, sf_dir)
    stats = lsh.bucket_stats(signed).where(F.col("fraudes_detectados") > 0)
    return with_rank(stats, [F.desc("probabilidad_fraude_pct"), F.desc("total_solicitudes"), F.asc("firma_lsh")])


@query("p0_latest_ranked", _p0_sql("""
select id, resultado_final, row_number() over (order by id desc) as rank from scored order by id desc limit 10000"""))
def p0_latest_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 10 000 scored documents, with their places in the listing."""
    scored, _ = p0.bulk_score(views.risk_input(spark, sf_dir))
    return with_rank(p0.latest(scored.select("id", "resultado_final"), 10000), [F.desc("id")])


@query("catalog_sort_ranked", with_views(["products"], """
select product_id, flow_id, flow_name, row_number() over (order by lower(flow_name) desc, flow_id) as rank from products"""))
def catalog_sort_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue by name, descending, with each flow's place."""
    products = views.products(spark, sf_dir).select("product_id", "flow_id", "flow_name")
    return with_rank(products, [generic.sort_key("flow_name", "desc", text=True), F.asc("flow_id")])


@query("value_counts_ranked", with_views(["applications"], """
select label, n, row_number() over (order by n desc, label) as rank
from (select cast(antiguedad_laboral_meses as varchar) as label, count(*) as n from applications group by 1) c"""))
def value_counts_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenures by frequency, with their places."""
    tenures = views.applications(spark, sf_dir).select(F.col("antiguedad_laboral_meses").cast("string").alias("tenure"))
    return with_rank(generic.value_counts(tenures, "tenure", names=False), [F.desc("n"), F.asc("label")])


# ------------------------------------------------------------------ P1, M1
@query("project_features", with_views(["applications"], f"select id, {', '.join(FEATURES)} from applications"))
def project_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five features in their fixed order; vector and signature columns are left behind."""
    signed, _ = signed_applications(spark, sf_dir)
    return project_features(signed, FEATURES, ["id"])


@query("model_vectors", with_views(["applications"], "select id, " + ", ".join(
    f"cast({c} as double) as v{i}" for i, c in enumerate(FEATURES)) + " from applications"))
def model_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the vector that the models read, component by component."""
    v = vector_to_array(F.col("features"))
    return ml.assemble(views.applications(spark, sf_dir), FEATURES).select("id", *[F.get(v, i).alias(f"v{i}") for i in range(len(FEATURES))])


# ------------------------------------------------------------------ P12
ROLE = "BUILDING"


@query("keyed_lookup", with_views(["user_roles"], f"select user_id, role from user_roles where role = '{ROLE}'"))
def keyed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users of one role."""
    return generic.keyed_lookup(views.user_roles(spark, sf_dir), "role", ROLE).select("user_id", "role")


# ------------------------------------------------------------------ R6
ACTION = "RA_ADD_GUARANTOR"
ACTION_SPEC = {
    "flow_name": "actions", "entryNodeId": "a1",
    "nodes": [{"id": "a1", "type": "function", "data": {"functionName": "rl_check_dicom"}},
              {"id": "a2", "type": "function", "data": {"functionName": "motor.finalize_decision"}}],
    "edges": [{"source": "a1", "target": "a2"}],
}


@query("flow_required_actions", _flow_sql(f"""
select cast(id as varchar) as id,
  case when nhard > 0 then 'REJECTED' when asked then 'REQUIRE_ACTION' else 'APPROVED' end as final_decision_code,
  case when asked then '{ACTION}' else '' end as required_action_codes
from asks""", """
asks as (select k.id, k.nhard, r.monthly_rent > 5000e0 as asked from k join requests r on r.id = k.id)"""))
def flow_required_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that come with a required action (a high rent asks for a guarantor) end as REQUIRE_ACTION unless a rule blocks them."""
    asked = F.when(F.col("context.monthly_rent") > 5000.0, F.array(F.lit(ACTION))).otherwise(F.array().cast("array<string>"))
    requests = nested_requests(spark, sf_dir).withColumn("decision", F.col("decision").withField("required_action_codes", asked))
    out = flows.apply_flow(requests, ACTION_SPEC)
    return out.select("id", F.col("decision.final_decision_code").alias("final_decision_code"),
                      F.array_join("decision.required_action_codes", ",").alias("required_action_codes"))
