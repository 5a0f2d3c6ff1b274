"""Arithmetic helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_score(weights: dict[str, float], lo: float = 0.0, hi: float = 100.0) -> Column:
    """sum of value * weight over the weighted columns, clamped to [lo, hi].

    A NULL value contributes nothing (a key that is absent)."""
    terms = [F.coalesce(F.col(c).cast("double") * F.lit(float(w)), F.lit(0.0)) for c, w in weights.items()]
    total = reduce(lambda a, b: a + b, terms, F.lit(0.0))
    return F.least(F.greatest(total, F.lit(lo)), F.lit(hi))


def avoided_loss(amount: Column, risk_pct: Column) -> Column:
    """F16: amount * risk / 100."""
    return amount * (risk_pct / 100.0)


def affordability_pct(income: Column, debt: Column, amount: Column) -> Column:
    """(debt + amount) / income * 100; 0 when income <= 0; negative or
    missing inputs count as 0."""
    def clean(c: Column) -> Column:
        return F.when(c.isNotNull() & (c >= 0), c).otherwise(F.lit(0.0))

    inc, d, a = clean(income), clean(debt), clean(amount)
    return F.when(inc > 0, (d + a) / inc * 100.0).otherwise(F.lit(0.0))


def encrypt_column(text: Column, key: Column) -> Column:
    """AES-256-GCM (random IV), base64 text."""
    return F.base64(F.aes_encrypt(text.cast("binary"), key, F.lit("GCM")))


def decrypt_column(token: Column, key: Column) -> Column:
    return F.aes_decrypt(F.unbase64(token), key, F.lit("GCM")).cast("string")


def content_id(text: Column) -> Column:
    """an id in a uuid's form from the SHA-256 of a text, so a recomputed task makes the same one."""
    h = F.sha2(text.cast("binary"), 256)
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def request_id(run: str, key: Column) -> Column:
    """the id of a row in a run; another run gives another id, a retried task or a second read the same one."""
    return content_id(F.concat(F.lit(f"{run}|"), F.coalesce(key.cast("string"), F.lit(""))))
