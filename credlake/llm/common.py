"""Helpers shared by the operators: table access, the shared scratch folder, column names."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlake.session import send_package

# What is handed to a Python worker at a time.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local session may go without the setting; it then gets a folder
    of this machine, which all its tasks can read.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor, and a
    value such as a partition number keeps what it was when it was written.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` carries (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8(column) -> F.Column:
    """The text's UTF-8 bytes, empty for null."""
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


def filesystem(path: str):
    """pyarrow's file system for a path or URI, and the path within it (for tasks that read byte ranges)."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return fs.LocalFileSystem(), os.path.abspath(path)


def ship() -> None:
    """Send this package's modules to the executors once per Spark application (``session.send_package``)."""
    spark = SparkSession.active()
    # Texts are long rows: small batches keep a worker's memory to a few of them.  Spark reads these
    # settings when a plan runs, so they cannot be restored here; what the caller has set stays.
    for name, value in BATCHES.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    send_package(spark, scratch(spark, "modules"))
