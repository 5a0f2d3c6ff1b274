"""Structured Streaming scorers.

New applications arrive as files; each micro-batch runs the same column
expressions as the batch path.  Sinks are idempotent: X1 appends through
Spark's file sink (exactly-once via its commit log), X2 writes each batch
into its own ``batch=<id>`` folder with overwrite, so a replayed batch
replaces its own output.  Checkpoints and outputs live under the shared
``spark.checkpoint.dir``; only a local session may do without that setting.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.functions.lsh import LshModel
from credlake.operators import lsh, ml, p0
from credlake.operators.sampling import split_hash, sample_cut
from credlake.session import ensure_checkpoint_dir, table_path
from credlake.sinks import writers
from credlake.sources import views
from credlake.sources.tables import read_table


def stream_dir(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex}")


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A table's Parquet files as a stream.

    A table is a folder of part files, which the stream watches, or a single
    file, for which the stream watches the folder above with a filter on the
    file's name.  ``max_files`` bounds the files of a micro-batch; without it
    a trigger takes all that is there.
    """
    path = table_path(sf_dir, name)
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", os.path.basename(path)).parquet(sf_dir)


def application_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """Orders arriving as Parquet files, joined to the (static) customers."""
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_acctbal")
    return views.applications_from(table_stream(spark, sf_dir, "orders", max_files), customer)


def stream_lsh_scores(spark: SparkSession, stream: DataFrame, model: LshModel, history_stats: DataFrame,
                      out_dir: str) -> DataFrame:
    """Signature -> bucket lookup (stream-static, broadcast) -> decision.
    Runs to completion (``availableNow``) and returns the sink as a table."""
    scored = lsh.score_against_history(stream, model, history_stats)
    out = scored.select("id", "firma_lsh", "total_balde", "fraudes_balde",
                        F.when(F.col("encontrado"), F.col("pct_fraude")).alias("pct_fraude"), "decision")
    q = (out.writeStream.format("parquet").option("path", os.path.join(out_dir, "data"))
         .option("checkpointLocation", os.path.join(out_dir, "checkpoint"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(os.path.join(out_dir, "data"))


def stream_p0_scores(spark: SparkSession, stream: DataFrame, out_dir: str,
                     probability: str = "p_riesgo", model_path: str | None = None, key: str | None = None,
                     buckets: int = 64, checkpoint: str = "checkpoint") -> tuple[DataFrame, DataFrame]:
    """Validate -> labels -> risk -> decision per micro-batch; valid rows
    to ``scored``, invalid rows (with reasons) to ``invalid``.  With
    ``model_path`` the stored risk model, loaded once, gives the probability.

    With ``key`` a key is stored once (K2): every micro-batch appends only the
    keys that no earlier one stored, whatever batches the rows are cut into, so
    an application that arrives in two files, or again after a restart from an
    older checkpoint or none, adds no row; what a batch had stored before it
    failed is skipped when it is replayed.  Nothing stored is ever overwritten.
    Without ``key`` a batch replaces its own folder."""
    model = ml.load_risk_model(model_path) if model_path else None
    scored_dir, invalid_dir = os.path.join(out_dir, "scored"), os.path.join(out_dir, "invalid")

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # Both sinks read the batch: compute its join once (recomputed from the source if an executor is lost).
        batch = (ml.score_risk(model, batch, probability) if model else batch).persist()
        try:
            scored, invalid = p0.bulk_score(batch, probability)
            reasons = invalid.withColumn("motivos", F.array_join("motivos", "; "))
            if key:
                writers.append_scored(scored, scored_dir, key, buckets)
                writers.append_scored(reasons, invalid_dir, key, buckets)
                return
            scored.write.mode("overwrite").parquet(os.path.join(scored_dir, f"batch={batch_id}"))
            reasons.write.mode("overwrite").parquet(os.path.join(invalid_dir, f"batch={batch_id}"))
        finally:
            batch.unpersist()

    q = (stream.writeStream.foreachBatch(each_batch)
         .option("checkpointLocation", os.path.join(out_dir, checkpoint))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    read = lambda d: spark.read.parquet(d).drop("batch", writers.BUCKET)
    return read(scored_dir), read(invalid_dir)


def holdout_filter(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """The J4 sample predicate as a stream filter (same rows as batch)."""
    return df.where(split_hash(F.col("id"), seed) < F.lit(sample_cut(fraction)))
