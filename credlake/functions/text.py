"""Text templates as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill(template: str, **values: Column) -> Column:
    """``concat`` of a ``{name}`` template with Column values (no Python per row)."""
    parts: list[Column] = []
    pos = 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(values[m.group(1)].cast("string"))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it (a one-element ``transform``)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shortest(x: Column, text: Column) -> Column:
    """The text of a double, less a last digit that the JVM's conversion may print though it is not needed."""
    def repaired(p: Column) -> Column:
        digits, tail = p["digits"], p["tail"]
        places = F.length(digits) - 1 - F.instr(digits, ".")
        step = F.pow(F.lit(10.0), -places).cast("decimal(38,18)") * F.when(x < 0, F.lit(-1)).otherwise(F.lit(1))
        fits = lambda t: F.concat(t, tail).try_cast("double") == x

        def tried(cut: Column) -> Column:
            up = F.regexp_replace((cut.try_cast("decimal(38,18)") + step).cast("decimal(38,18)").cast("string"), "0+$", "")
            return F.when(fits(cut), F.concat(cut, tail)).otherwise(bind(up, lambda u: F.when(fits(u), F.concat(u, tail)).otherwise(text)))
        long = F.length(F.regexp_replace(digits, "[-.]", "")) > 16
        cut = F.regexp_replace(F.substring(digits, F.lit(1), F.length(digits) - 1), "0+$", "")
        return F.when(long, bind(cut, tried)).otherwise(text)
    parts = F.struct(F.regexp_extract(text, r"^(-?[0-9]+\.[0-9]+)", 1).alias("digits"), F.regexp_extract(text, "(E.*)$", 1).alias("tail"))
    return bind(parts, repaired)


def _python_text(text: Column) -> Column:
    """The shortest text of a double in Python's form."""
    def moved(power: Column) -> Column:
        plain = F.regexp_replace(F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), "0+$", ""), r"\.$", ".0")
        mantissa = F.regexp_replace(F.regexp_extract(text, "^(-?[0-9.]+)E", 1), r"\.0$", "")
        size = F.abs(power).cast("string")
        exponent = F.concat(mantissa, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), F.when(F.abs(power) > 99, size).otherwise(F.lpad(size, 2, "0")))
        return F.when(power.isNull(), text).when(power.between(-4, 15), plain).otherwise(exponent)
    named = F.when(text == "NaN", F.lit("nan")).when(text == "Infinity", F.lit("inf")).when(text == "-Infinity", F.lit("-inf"))
    return named.otherwise(bind(F.regexp_extract(text, "E(-?[0-9]+)$", 1).try_cast("int"), moved))


def python_float(x: Column) -> Column:
    """Text of a double as Python prints it: plain from 1e-4 to below 1e16, else with an exponent of two digits or more.

    Numbers of at most 16 digits without an exponent, the common case, are the
    JVM's text as it is; only the others are worked on."""
    def of(v: Column) -> Column:
        def written(text: Column) -> Column:
            easy = (F.length(text) <= 17) & ~F.contains(text, F.lit("E")) & ~F.contains(text, F.lit("N")) & ~F.contains(text, F.lit("I"))
            return F.when(easy, text).otherwise(bind(_shortest(v, text), _python_text))
        return bind(v.cast("string"), written)
    return bind(x.cast("double"), of)


def fixed2(x: Column) -> Column:
    """Text of ``x`` with two decimals exactly as Python's ``f"{x:.2f}"``."""
    from credlake.functions.rounding import python_fixed
    return python_fixed(x, 2)
