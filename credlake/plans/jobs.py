"""End-to-end jobs over files (L1, L3, L4).

Each job is one Spark application step: read with a fixed schema, run the
operators as one plan, write with the partition-parallel writers.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from credlake.operators import flows, insights, lsh, ml, p0, rules
from credlake.operators.requests import PENDING, to_document
from credlake.sinks import writers
from credlake.sources import files
from credlake.sources.views import FEATURES

DECISIONS = [rules.APPROVED, rules.REJECTED, rules.REQUIRE_ACTION, PENDING]


def silver_job(spark: SparkSession, csv_path: str, gold_dir: str, model_path: str, k: int = 5) -> dict:
    """L1: S1 -> A17 -> F2 -> A1 -> T1 -> A16 -> K1, K3.

    The signed table feeds four actions, so it is persisted (memory, then
    disk); a lost executor recomputes its partitions from the CSV."""
    apps = files.read_applications(spark, csv_path)
    model = lsh.fit_lsh(apps, FEATURES)
    writers.save_model(spark, model, model_path)
    signed = model.transform(apps).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = lsh.bucket_stats(signed)
        top = [r.asDict() for r in lsh.top_risk_buckets(stats, k).collect()]
        totals = lsh.totals(signed).first().asDict()
        written = writers.write_gold(signed, gold_dir)
    finally:
        signed.unpersist()
    return {"top": top, "rows": totals["total_filas"], "buckets": totals["total_baldes"], "written": written}


def lsh_evaluation_job(spark: SparkSession, apps: DataFrame, model_path: str, gold_dir: str, out_dir: str) -> int:
    """Part B as a job: S4 model -> F1/F2 signatures -> A2 history from the
    gold table -> J1 lookup -> F11/F12 decision and reason -> K4 reports.
    ``apps`` needs an ``id`` column and the five features."""
    model = files.load_lsh_model(spark, model_path, FEATURES)
    history = spark.read.parquet(gold_dir)
    scored = lsh.score_against_history(apps, model, lsh.bucket_history(history))
    return writers.write_evaluations(lsh.evaluation_documents(scored, FEATURES), out_dir)


def insights_report(spark: SparkSession, scored_path: str) -> dict[str, DataFrame]:
    """L3: read the scored documents, flatten once, every panel from the
    persisted flat table (returned as ``"flat"``; ``unpersist`` it when the
    panels have been read)."""
    flat = p0.flatten_scored(files.read_scored(spark, scored_path)).persist(StorageLevel.MEMORY_AND_DISK)
    return {**insights.report(flat), "flat": flat}


def score_to_documents(spark: SparkSession, apps: DataFrame, scored_path: str,
                       invalid_path: str | None = None, model_path: str | None = None) -> int:
    """L2 + K2: score a table of applications and append the documents.

    With ``model_path`` the probability comes from the stored risk model,
    else from the applications' ``p_riesgo`` column."""
    if model_path:
        apps = ml.score_risk(ml.load_risk_model(model_path), apps, "p_riesgo")
    scored, invalid = p0.bulk_score(apps)
    n = writers.append_scored(p0.to_documents(scored), scored_path, key="_id")
    if invalid_path:
        writers.append_scored(invalid.withColumn("motivos", F.array_join("motivos", "; ")), invalid_path)
    return n


def request_batch_job(spark: SparkSession, in_dir: str, out_dir: str, flow_name: str = "p0",
                      flow_code: str | None = None, errors_dir: str | None = None, lines: bool = False,
                      compression: str | None = None) -> DataFrame:
    """L4: S2 -> P4, P5 -> flow (R7..R12) -> K4 and the R13 summary.

    ``lines``: a request per line instead of one per file.  A flow code, when given, overrides the flow name (R9).
    ``compression``: codec of the result and error files.

    The decided requests are written in one pass and not kept: what the summary
    counts is counted by that pass, for the codes of the rules; only if there
    are others (a flow without a final step leaves what the input says) the
    written results are read again."""
    name = flows.flow_name_for(flow_code) if flow_code else flow_name
    spec = flows.load_flow(name)
    requests, bad = files.read_requests(spark, in_dir, lines=lines)
    code, seen = F.col("decision.final_decision_code"), Observation("decisions")
    decided = flows.apply_flow(requests, spec).observe(
        seen, F.count(F.lit(1)).alias("all"), *[F.count_if(code == c).alias(c) for c in DECISIONS])
    docs = to_document(decided, keep=("_file",)).select(
        F.concat(F.lit("result_"), F.col("_file")).alias("result_name"), "id", "document")
    writers.write_evaluations(docs, out_dir, compression)
    if errors_dir:
        # Unreadable or incomplete files, with their name and the reason.
        n_bad = writers.write_evaluations(bad.select(F.col("_file").alias("file"), F.col("_corrupt").alias("error")),
                                          errors_dir, compression)
    else:
        n_bad = bad.count()
    counts = {c: int(seen.get[c]) for c in DECISIONS}
    rows = [(c, n) for c, n in counts.items() if n] + [("ERROR", n_bad)] * (n_bad > 0)
    if sum(counts.values()) == int(seen.get["all"]):
        return spark.createDataFrame(rows, "decision string, n long")
    written = spark.read.schema("document string").json(out_dir).select(F.struct(
        F.get_json_object("document", "$.decision.final_decision_code").alias("final_decision_code")).alias("decision"))
    summary = flows.batch_summary(written)
    rows = [tuple(r) for r in summary.collect()] + [("ERROR", n_bad)] * (n_bad > 0)   # one row per decision code: bounded
    return spark.createDataFrame(rows, "decision string, n long")
