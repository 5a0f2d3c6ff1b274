"""Tables that change in one step (K2, K6, K7 on top of Parquet folders).

A table is a folder with one folder per write and a small list, ``CURRENT``,
of those that make up the table now.  A change first writes its rows to a new
folder and then replaces the list by a rename, so a reader sees the table from
before or from after; a change that fails, or an executor lost in the middle of
one, leaves the old rows readable and unchanged.  Folders that the list no
longer names stay for readers that began earlier, until ``vacuum``.

One writer at a time: two changes made from the same list would lose one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CURRENT = "CURRENT"  # Spark skips files whose name begins with an underscore


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, where, where.getFileSystem(conf)


def parts(spark: SparkSession, root: str) -> list[str]:
    """The folders that make up the table; none where it does not exist yet."""
    _, _, where, fs = _fs(spark, f"{root}/{CURRENT}")
    if not fs.exists(where):
        return []
    return [f"{root}/{r.value}" for r in spark.read.text(f"{root}/{CURRENT}").collect() if r.value]  # one line per write since the last ``replace``


def read(spark: SparkSession, root: str) -> DataFrame:
    now = parts(spark, root)
    if not now:
        raise FileNotFoundError(f"no table at {root}")
    return spark.read.parquet(*now)


def _point(spark: SparkSession, root: str, folders: list[str]) -> None:
    """Replace the list by one rename."""
    jvm, conf, target, fs = _fs(spark, f"{root}/{CURRENT}")
    draft = jvm.org.apache.hadoop.fs.Path(f"{root}/{CURRENT}.{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray("".join(f"{f}\n" for f in folders).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    option = jvm.org.apache.hadoop.fs.Options.Rename
    array = spark.sparkContext._gateway.new_array(option, 1)
    array[0] = option.OVERWRITE
    context.rename(fs.makeQualified(draft), fs.makeQualified(target), array)


def _written(df: DataFrame, root: str) -> tuple[str, int]:
    name, seen = f"w-{uuid.uuid4().hex}", Observation("rows")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/{name}")
    return name, int(seen.get["n"])


def replace(df: DataFrame, root: str) -> int:
    """Make ``df`` the table; it may read the table itself.  Returns the rows written."""
    name, rows = _written(df, root)
    _point(df.sparkSession, root, [name])
    return rows


def append(df: DataFrame, root: str) -> int:
    """K6: add rows; returns how many."""
    held = [p.rsplit("/", 1)[1] for p in parts(df.sparkSession, root)]
    name, rows = _written(df, root)
    _point(df.sparkSession, root, [*held, name])
    return rows


def delete(spark: SparkSession, root: str, keys: DataFrame, key: str = "id") -> int:
    """K7: drop the rows whose key is in ``keys``; returns how many went.  Nothing is written where none does."""
    table = read(spark, root)
    gone = table.join(keys.select(key).distinct(), key, "left_semi").count()
    if gone:
        replace(table.join(keys.select(key), key, "left_anti").select(table.columns), root)
    return gone


def vacuum(spark: SparkSession, root: str) -> int:
    """Remove the folders that the list does not name; for when no reader of an older list is left."""
    _, _, where, fs = _fs(spark, root)
    named = {p.rsplit("/", 1)[1] for p in parts(spark, root)}
    old = [f.getPath() for f in fs.listStatus(where) if f.isDirectory() and f.getPath().getName().startswith("w-") and f.getPath().getName() not in named]
    for path in old:
        fs.delete(path, True)
    return len(old)
