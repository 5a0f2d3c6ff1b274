"""Rounding exactly as Python's ``round(x, n)`` / ``f"{x:.nf}"`` (half-even
on the exact binary value), in column arithmetic.

``x * 10**n`` is rounded in floating point; its exact error is recovered
with Dekker's split (``x = hi + lo`` with 26-bit halves; ``10**n`` has at
most 26 bits for n <= 7, so ``hi * 10**n`` and ``lo * 10**n`` are exact).
The error tells whether the exact product lies above, below or on the half.
numpy's ``round`` (used by pandas) instead rounds the floating product, i.e.
``rint(x * 10**n) / 10**n``; use that where the reference used numpy.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1


def python_round_int(x: Column, digits: int = 2) -> Column:
    """The integer ``n`` with ``round(x, digits) == n / 10**digits``."""
    if not 0 <= digits <= 7:
        raise ValueError("digits must be in 0..7")
    scale = float(10**digits)
    a = x.cast("double")
    p = a * scale
    c = a * _SPLIT
    hi = c - (c - a)
    err = (hi * scale - p) + (a - hi) * scale     # exact: x * 10**digits == p + err
    f = F.floor(p)
    d = (p - f - 0.5) + err                        # sign of (exact fraction - 1/2)
    up = (d > 0) | ((d == 0) & (F.pmod(f, F.lit(2)) == 1))
    return (f + F.when(up, 1).otherwise(0)).cast("long")


def python_round(x: Column, digits: int = 2) -> Column:
    """``round(x, digits)`` of a Python float."""
    return python_round_int(x, digits) / float(10**digits)


def python_fixed(x: Column, digits: int = 2) -> Column:
    """``f"{x:.{digits}f}"`` built from the rounded integer (no formatter rounding)."""
    n = python_round_int(x, digits)
    m = F.abs(n)
    scale = 10**digits
    frac = F.lpad((m % scale).cast("string"), digits, "0") if digits else F.lit("")
    body = F.concat((m / scale).cast("long").cast("string"), F.lit("." if digits else ""), frac)
    a = x.cast("double")
    # Python keeps the sign of the input, also when it rounds to zero ("-0.00").
    negative = (a < 0) | a.cast("string").startswith("-")
    return F.when(a.isNull() | F.isnan(a), F.lit(None)).otherwise(
        F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), body))


def python_round_sql(x: str, digits: int = 2) -> str:
    """The same rounding as SQL text (for the DuckDB oracle)."""
    s = f"{float(10**digits)!r}e0".replace(".0e0", "e0")
    p, c = f"(({x})*{s})", f"(({x})*134217729e0)"
    hi = f"({c} - ({c} - ({x})))"
    err = f"(({hi}*{s} - {p}) + (({x}) - {hi})*{s})"
    d = f"(({p} - floor({p}) - 0.5e0) + {err})"
    return (f"((floor({p}) + case when {d} > 0 or ({d} = 0 and floor({p}) % 2 = 1) then 1 else 0 end)"
            f" / {s})")
