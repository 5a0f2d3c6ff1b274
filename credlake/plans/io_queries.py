"""Registered file round trips: tables written to the shared folder by the
sinks and read back by the sources, each write done twice so that a rerun is
seen to change nothing.  They must equal the queries that stay in the plan,
whose oracle SQL they carry."""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.operators import lsh, p0
from credlake.operators.requests import to_document
from credlake.plans import flow_queries, jobs, lsh_queries, p0_queries  # noqa: F401  (their oracles are reused below)
from credlake.plans.registry import ORACLES, query
from credlake.session import ensure_checkpoint_dir
from credlake.sinks import versioned, writers
from credlake.sources import files, views
from credlake.sources.tables import read_table


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    return f"{ensure_checkpoint_dir(spark)}/round-trips/{name}-{uuid.uuid4().hex}"


@query("io_silver_job", ORACLES["lsh_bucket_stats"])
def io_silver_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 -> S1 -> L1 (K1, K3), run twice -> A1 of the gold table."""
    out = folder(spark, "silver")
    writers.write_csv(views.applications(spark, sf_dir).drop("id"), f"{out}/bronze")
    for _ in range(2):
        jobs.silver_job(spark, f"{out}/bronze", f"{out}/gold", f"{out}/model")
    return lsh.bucket_stats(spark.read.parquet(f"{out}/gold"))


@query("io_stored_lsh_model", ORACLES["lsh_signatures"])
def io_stored_lsh_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 -> S4: every application signed by the model read back from its file."""
    out, apps = folder(spark, "model"), views.applications(spark, sf_dir)
    for _ in range(2):
        writers.save_model(spark, lsh.fit_lsh(apps, views.FEATURES), out)
    return files.load_lsh_model(spark, out, views.FEATURES).transform(apps).select("id", "firma_lsh")


@query("io_scored_documents", p0_queries._p0_sql("""
select cast(id as varchar) as id, ingreso_mensual, score_crediticio, monto_solicitado,
  cast(antiguedad_laboral_meses as double) as antiguedad_laboral_meses, deuda_actual, ratio_endeudamiento_actual,
  capacidad_pago, estabilidad_laboral, score_estabilidad_financiera, decision_preliminar, pct_riesgo, is_aprobado
from scored"""))
def io_scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 + K2, appended twice by key -> S3 -> P3."""
    out = folder(spark, "scored")
    for _ in range(2):
        jobs.score_to_documents(spark, views.risk_input(spark, sf_dir), out)
    return p0.flatten_scored(files.read_scored(spark, out))


@query("io_delete_and_records", """
select c_custkey as id, c_acctbal as saldo from customer where c_custkey % 7 <> 0
union all select c_custkey, c_acctbal from customer where c_custkey % 7 = 3""")
def io_delete_and_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 appends records, K7 deletes by key (twice: the second finds none), K6 appends again."""
    out = folder(spark, "records")
    rows = read_table(spark, sf_dir, "customer", "c_custkey", "c_acctbal").toDF("id", "saldo")
    writers.save_record(rows, ["id", "saldo"], out)
    gone = rows.where(F.col("id") % 7 == 0).select("id")
    removed = [writers.delete_from(spark, out, gone), writers.delete_from(spark, out, gone)]
    if removed != [not gone.isEmpty(), False]:
        raise AssertionError(f"delete reported {removed}")
    writers.save_record(rows.where(F.col("id") % 7 == 3), ["id", "saldo"], out)
    return spark.read.parquet(out).select("id", "saldo")


@query("io_versioned_records", ORACLES["io_delete_and_records"])
def io_versioned_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 and K7 on a table that changes in one step: a delete that fails midway leaves it as it was."""
    out = folder(spark, "versions")
    rows = read_table(spark, sf_dir, "customer", "c_custkey", "c_acctbal").toDF("id", "saldo")
    versioned.append(rows, out)
    before = versioned.parts(spark, out)
    broken = rows.where(F.col("id") % 7 == 0).select(F.when(F.col("id") >= 0, F.raise_error(F.lit("lost"))).cast("long").alias("id"))
    try:
        versioned.delete(spark, out, broken)
        raise AssertionError("the delete should have failed")
    except PySparkException:
        if versioned.parts(spark, out) != before:
            raise AssertionError("a failed delete changed the table") from None
    gone = rows.where(F.col("id") % 7 == 0).select("id")
    removed = [versioned.delete(spark, out, gone), versioned.delete(spark, out, gone)]
    if removed != [gone.count(), 0]:
        raise AssertionError(f"delete reported {removed}")
    versioned.append(rows.where(F.col("id") % 7 == 3), out)
    return versioned.read(spark, out).select("id", "saldo")


@query("io_request_batch", flow_queries._flow_sql("""
select cast(id as varchar) as id, case when branch and nhard = 0 and not low then 'APPROVED' else 'REJECTED' end as decision,
  cast(null as varchar) as error from k where id % 16 not in (3, 5)
union all select null, 'ERROR', 'broken' from k where id % 16 = 3
union all select null, 'ERROR', 'missing required field' from k where id % 16 = 5"""))
def io_request_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 -> L4 (P4, P5, P6, R7, R13) -> K4: requests written as JSON lines, wrapped,
    bare, cut short and without a rent; decisions from the result documents, errors from the error file."""
    out = folder(spark, "requests")
    docs = to_document(flow_queries.nested_requests(spark, sf_dir))
    k, t = F.col("id").cast("long"), F.col("document")
    for cond, changed in ((k % 16 == 5, F.regexp_replace(t, '"monthly_rent":[-0-9.E]+,', "")), (k % 3 == 0, F.concat(F.lit('{"solicitud":'), t, F.lit("}"))),
                          (k % 16 == 3, F.substring(t, 1, 60))):
        docs = docs.withColumn("document", F.when(cond, changed).otherwise(t))
    docs.select(t.alias("value")).write.option("compression", "gzip").text(f"{out}/plain")
    jobs.request_batch_job(spark, f"{out}/plain", f"{out}/results", "p0", errors_dir=f"{out}/errors", lines=True, compression="gzip")
    done = spark.read.schema("id string, document string").json(f"{out}/results").select(
        "id", F.get_json_object("document", "$.decision.final_decision_code").alias("decision"), F.lit(None).cast("string").alias("error"))
    error = F.when(F.col("error").startswith("missing"), F.col("error")).otherwise(F.lit("broken"))
    bad = spark.read.schema("file string, error string").json(f"{out}/errors").select(
        F.lit(None).cast("string").alias("id"), F.lit("ERROR").alias("decision"), error.alias("error"))
    return done.unionByName(bad)
