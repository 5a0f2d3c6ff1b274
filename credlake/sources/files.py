"""File sources.

Every reader gives an explicit schema: no inference pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credlake.functions.lsh import LshModel
from credlake.operators.requests import REQUEST_FILE, project_request, unwrap

APPLICATION_SCHEMA = T.StructType([
    T.StructField("ingreso_mensual", T.DoubleType()),
    T.StructField("score_crediticio", T.DoubleType()),
    T.StructField("monto_solicitado", T.DoubleType()),
    T.StructField("antiguedad_laboral_meses", T.IntegerType()),
    T.StructField("deuda_actual", T.DoubleType()),
    T.StructField("es_fraude", T.IntegerType()),
])
MODEL_SCHEMA = T.StructType([
    T.StructField("scaler_mean", T.ArrayType(T.DoubleType())),
    T.StructField("scaler_scale", T.ArrayType(T.DoubleType())),
    T.StructField("R", T.ArrayType(T.ArrayType(T.DoubleType()))),
])


def read_applications(spark: SparkSession, path: str, schema: T.StructType = APPLICATION_SCHEMA) -> DataFrame:
    """Applicant CSV with a header, read with a fixed schema."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_requests(spark: SparkSession, path: str, return_raw: bool = False, lines: bool = False):
    """Every ``*.json`` file under ``path`` (one multi-line object per
    file, or with ``lines`` one object per line) -> (requests with defaults
    filled, unreadable files or lines).

    A bad document does not stop the batch: it lands in the second frame with
    its file name.  The texts are read as they are and parsed by ``from_json``
    with a corrupt-record column, so nothing has to be cached; with
    ``return_raw`` the parsed documents are returned third.  A text is parsed
    once per read: a one-element ``inline`` keeps Catalyst from copying the
    parse into every condition and field that mentions the document."""
    schema = T.StructType(list(REQUEST_FILE.fields) + [T.StructField("_corrupt", T.StringType())])
    texts = spark.read.option("pathGlobFilter", "*" if lines else "*.json").text(path, wholetext=not lines)
    if lines:
        texts = texts.where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    once = F.struct(F.from_json("value", schema, options).alias("r"), F.col("_metadata.file_name").alias("_file"), "value")
    raw = (texts.select(F.inline(F.array(once)))
           .select("r.*", "_file", (F.col("r").isNull() | F.col("r._corrupt").isNotNull()).alias("_bad"), "value")
           .withColumn("_corrupt", F.when(F.col("_bad"), F.col("value"))).drop("_bad", "value"))
    # Required fields of the request model (a missing one makes the document fail).
    ctx = F.col("context")
    bad_applicant = F.exists(F.col("applicants"), lambda a: a.id.isNull() | a.role.isNull()
                             | a.income_source.isNull() | a.income_source.type.isNull())
    missing = (F.col("id").isNull() | ctx.isNull() | ctx.property_id.isNull() | ctx.monthly_rent.isNull()
               | ctx.currency.isNull() | F.col("applicants").isNull() | F.coalesce(bad_applicant, F.lit(False)))
    reason = F.coalesce("_corrupt", F.when(missing, F.lit("missing required field")))
    checked = unwrap(raw).withColumn("_corrupt", reason)
    good, bad = checked.where(F.col("_corrupt").isNull()).drop("_corrupt"), checked.where(F.col("_corrupt").isNotNull()).select("_file", "_corrupt")
    if return_raw:
        return project_request(good), bad, raw
    return project_request(good), bad


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """S3: the scored-document table."""
    return spark.read.parquet(path)


def load_lsh_model(spark: SparkSession, path: str, features: list[str]) -> LshModel:
    """Scaler mean/scale and R from the model JSON (one small row)."""
    try:
        row = spark.read.schema(MODEL_SCHEMA).option("multiLine", True).json(path).first()
    except Exception as e:  # a missing path raises at analysis time
        raise FileNotFoundError(f"LSH model not found at {path}: fit it first (silver job)") from e
    if row is None or row["R"] is None:
        raise FileNotFoundError(f"LSH model not found at {path}: fit it first (silver job)")
    return LshModel.from_row(row.asDict(), features)
