"""Sinks (K1-K7).

Writes are Spark's partition-parallel file writers; counts come from
``Observation`` metrics collected during the write, not a second job.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from credlake.functions.lsh import LshModel
from credlake.session import cut_lineage


def _count_while_writing(df: DataFrame, write) -> int:
    obs = Observation("rows")
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
    write(observed)
    return int(obs.get["n"])


def write_gold(df: DataFrame, path: str, drop: tuple[str, ...] = ("features_vec", "scaled_features")) -> int:
    """K1: idempotent overwrite; returns the rows written."""
    out = df.drop(*[c for c in drop if c in df.columns])
    return _count_while_writing(out, lambda d: d.write.mode("overwrite").parquet(path))


BUCKET = "_bucket"


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """Of the rows of a key the one with the least hash of all its columns: the same one whenever it is computed.
    Null keys are no keys: all their rows stay."""
    cols = [F.col(c) for c in df.columns]
    keyed = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*cols), F.xxhash64(*cols)).alias("_row"))
    return keyed.select("_row.*").unionByName(df.where(F.col(key).isNull()))


def append_scored(df: DataFrame, path: str, key: str | None = None, buckets: int = 0) -> int:
    """K2: append scored documents; returns the rows inserted.

    With ``key``, rows whose key is already stored are skipped (anti join
    against the stored keys) and of the batch's own rows of one key one is
    kept (``one_per_key``), so a replayed batch inserts nothing twice.  With
    ``buckets`` the store is partitioned by a hash of the key, and only the
    buckets that the batch meets are read for their keys.  A store that is not
    there yet is empty; any other read error is raised."""
    spark = df.sparkSession
    if key is not None:
        df = one_per_key(df, key)
        if buckets:
            df = df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        try:
            stored = spark.read.parquet(path)
            if buckets:
                met = [r[0] for r in df.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
                stored = stored.where(F.col(BUCKET).isin(met))
            df = df.join(stored.select(key), key, "left_anti")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise

    def write(d: DataFrame) -> None:
        out = d.write.mode("append")
        (out.partitionBy(BUCKET) if key is not None and buckets else out).parquet(path)
    return _count_while_writing(df, write)


def save_model(spark: SparkSession, model: LshModel, path: str) -> None:
    """K3: the model parameters as one JSON object."""
    spark.createDataFrame([(json.dumps(model.to_row()),)], "v string").coalesce(1) \
        .write.mode("overwrite").text(path)


def write_evaluations(df: DataFrame, path: str, compression: str | None = None) -> int:
    """K4: JSON lines, one report per row (the source name stays a column)."""
    return _count_while_writing(df, lambda d: d.write.mode("overwrite").json(path, compression=compression))


def write_csv(df: DataFrame, path: str) -> int:
    """K5: CSV with a header."""
    return _count_while_writing(df, lambda d: d.write.mode("overwrite").option("header", True).csv(path))


def save_record(df: DataFrame, columns: list[str], path: str) -> int:
    """K6: append the given columns."""
    return _count_while_writing(df.select(*columns), lambda d: d.write.mode("append").parquet(path))


def delete_from(spark: SparkSession, path: str, keys: DataFrame, key: str = "id") -> bool:
    """K7: delete rows by key from a Parquet table; True if any row went.

    The remaining rows are checkpointed to the shared checkpoint folder first,
    so the table can be overwritten in place without reading what is being
    replaced."""
    table = spark.read.parquet(path)
    obs_before = Observation("before")
    kept = table.observe(obs_before, F.count(F.lit(1)).alias("n")).join(keys.select(key), key, "left_anti")
    kept = cut_lineage(kept)
    before = int(obs_before.get["n"])
    after = _count_while_writing(kept, lambda d: d.write.mode("overwrite").parquet(path))
    return after < before
