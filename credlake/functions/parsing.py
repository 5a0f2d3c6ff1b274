"""Text-to-number parsing of the form and dashboard inputs.

Regular expressions run inside the JVM; NaN results are returned as NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a leading decimal number, as a browser's parseFloat reads it.
LEADING_NUMBER = r"^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)"
WHOLE_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_pct(text: Column) -> Column:
    """drop the first ``%`` and read the leading number; NULL -> 0,
    no leading number -> NULL (the dashboard's NaN)."""
    first_pct_removed = F.regexp_replace(text, r"^([^%]*)%", "$1")
    num = (F.regexp_extract(first_pct_removed, LEADING_NUMBER, 1)).try_cast("double")
    return F.when(text.isNull(), F.lit(0.0)).otherwise(num)


def parse_decimal(text: Column) -> Column:
    """first comma becomes a point, surrounding blanks are ignored,
    the empty string is 0; anything else that is not a number is NULL."""
    s = F.regexp_replace(F.regexp_replace(text, r"^([^,]*),", "$1."), r"^\s+|\s+$", "")
    return (F.when(s == "", F.lit(0.0))
            .when(s.rlike(WHOLE_NUMBER), (s).try_cast("double")))


def valid_amount(value: Column) -> Column:
    """F18 validity: finite and >= 0."""
    return value.isNotNull() & ~F.isnan(value) & (value >= 0) & (value != F.lit(float("inf")))
