"""Readers for the driver's Parquet tables.

Only the columns a caller needs are selected right after the scan, so the
Parquet reader prunes the rest (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from credlake.session import table_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Register every table as a temp view (for ``spark.sql`` users)."""
    for name in TABLES:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
