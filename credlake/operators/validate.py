"""Row validation and projection templates.

Each check becomes a ``CASE WHEN bad THEN reason END`` and the reasons are
collected with ``filter(array(...), x -> x IS NOT NULL)``: one projection,
no UDF, no join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
)

# The P0 request ranges.
SCORE_MIN, SCORE_MAX = 300.0, 850.0


def _reasons(checks: list[tuple[Column, str]]) -> Column:
    arr = F.array(*[F.when(bad, F.lit(msg)) for bad, msg in checks])
    return F.filter(arr, lambda x: x.isNotNull())


def application_checks() -> list[tuple[Column, str]]:
    inc, score = F.col("ingreso_mensual"), F.col("score_crediticio")
    amt, months, debt = F.col("monto_solicitado"), F.col("antiguedad_laboral_meses"), F.col("deuda_actual")

    def fails(ok: Column, value: Column) -> Column:
        # NULL makes a comparison NULL, and Spark puts NaN above all numbers; both are bad values.
        return F.coalesce(~ok | F.isnan(value.cast("double")), F.lit(True))
    return [
        (fails(inc > 0, inc), "ingreso_mensual must be > 0"),
        (fails((score >= SCORE_MIN) & (score <= SCORE_MAX), score), "score_crediticio must be in [300, 850]"),
        (fails(amt > 0, amt), "monto_solicitado must be > 0"),
        (fails((months >= 0) & (months.cast("double") == F.floor(months.cast("double"))), months),
         "antiguedad_laboral_meses must be an integer >= 0"),
        (fails(debt >= 0, debt), "deuda_actual must be >= 0"),
    ]


def validate_applications(df: DataFrame) -> DataFrame:
    """Adds ``motivos`` (array of reasons) and ``es_valida``."""
    reasons = _reasons(application_checks())
    return df.withColumn("motivos", reasons).withColumn("es_valida", F.size("motivos") == 0)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    v = validate_applications(df)
    return v.where("es_valida").drop("motivos", "es_valida"), v.where("NOT es_valida")


_TYPE_NAMES: dict[str, DataType] = {
    "str": StringType(), "int": LongType(), "float": DoubleType(), "bool": BooleanType(), "int32": IntegerType(),
}


def validate_input(df: DataFrame, rules: dict[str, dict]) -> DataFrame:
    """Per-field ``required`` / ``type`` rules.

    ``"<f> is required"`` when a required value is NULL (or the column is
    absent); otherwise the type is checked only for truthy values (not NULL,
    not ``''``, not a numeric 0): a string must parse as the type
    (``try_cast``), a typed column is checked by its own type.  Adds
    ``errors`` (array) and ``is_valid``."""
    checks = []
    types = dict(df.dtypes)
    for field_name, rule in rules.items():
        present = field_name in df.columns
        c = F.col(field_name) if present else F.lit(None).cast("string")
        dtype = types.get(field_name, "string")
        if rule.get("required"):
            checks.append((c.isNull(), f"{field_name} is required"))
        t = rule.get("type")
        if not t:
            continue
        if dtype == "string":
            truthy = c.isNotNull() & (c != "")
            bad = c.try_cast(_TYPE_NAMES[t]).isNull()
        else:
            truthy = c.isNotNull() & (c.cast("double") != 0) if dtype != "boolean" else c.isNotNull() & c
            bad = F.lit(_TYPE_NAMES[t].simpleString() != dtype and not (
                t == "int" and dtype in ("int", "bigint", "smallint", "tinyint")))
        checks.append((F.coalesce(truthy & bad, F.lit(False)), f"{field_name} must be {t}"))
    errors = _reasons(checks)
    return df.withColumn("errors", errors).withColumn("is_valid", F.size("errors") == 0)


def transform_data(df: DataFrame, mapping: dict[str, str | Callable[[DataFrame], Column] | Column]) -> DataFrame:
    """Target <- source column name, Column, or callable; a missing
    source gives NULL."""
    out = []
    for target, src in mapping.items():
        if isinstance(src, str):
            c = F.col(src) if src in df.columns else F.lit(None)
        elif isinstance(src, Column):
            c = src
        elif callable(src):
            c = src(df)
        else:
            continue
        out.append(c.alias(target))
    return df.select(*out)


def project_features(df: DataFrame, features: list[str], keep: list[str] | None = None) -> DataFrame:
    """Fixed-order feature projection."""
    return df.select(*(keep or []), *features)
