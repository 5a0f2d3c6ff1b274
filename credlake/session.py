"""Session helpers.

The library never creates a cluster session on its own: callers pass a
``SparkSession``.  ``local_session`` exists for tests and the benchmark.
"""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured like the tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("credlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of Parquet.

    The initial shuffle partition count gives ~``target_partition_bytes`` per
    reduce task for a shuffle as large as the input (AQE then coalesces small
    ones and splits skewed ones); it is never below the number of task slots.
    Scan splits use the same target so map tasks fit executor memory.
    """
    slots = max(1, executors * cores_per_executor)
    partitions = max(slots * 2, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        # Broadcasts stay small; operators that need one hint it after a size check.
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is given by the cluster (a shared file system);
    without it this raises, since a folder of one machine would split results
    over the executors' disks.  A ``local`` session, whose tasks all run on
    this machine, gets a scratch folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="credlake-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def send_package(spark: SparkSession, folder: str) -> None:
    """Send this package's modules to the executors once per Spark application, as ``--py-files`` would.

    Functions that run in Python workers import them there.  The archive is
    written to ``folder``, below the shared one, from which Spark hands it out.
    """
    context = spark.sparkContext
    if getattr(context, "_credlake_sent", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for at, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    target = f"{folder}/credlake_modules.zip"
    path = context._jvm.org.apache.hadoop.fs.Path(target)  # any file system that Spark itself can write to
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(target)
    context._credlake_sent = True


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a plan would otherwise grow across many steps; survives the
    loss of executors because the data lives in the shared folder.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
