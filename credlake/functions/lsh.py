"""Sign-random-projection LSH as column expressions (F1, F2).

A signature bit k is ``1`` iff the projection of the standardised feature
vector on row k of R is >= 0.  R is a K x d matrix of standard normals drawn
with ``numpy.random.RandomState(seed).randn(K, d)``; the reference model uses
seed 42 and K = 16.  Everything stays inside whole-stage codegen: the
matrix is embedded as double literals, no Python UDF is involved.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference model: number of planes and the seed.
DEFAULT_BITS = 16
DEFAULT_SEED = 42


def projection_matrix(bits: int = DEFAULT_BITS, dims: int = 5, seed: int = DEFAULT_SEED) -> list[list[float]]:
    return np.random.RandomState(seed).randn(bits, dims).tolist()


def standardise(x: Column, mean: float, std: float) -> Column:
    """``(x - mean) / std``."""
    return (x.cast("double") - F.lit(float(mean))) / F.lit(float(std))


def _dot(cols: list[Column], row: list[float]) -> Column:
    terms = [c * F.lit(float(w)) for c, w in zip(cols, row)]
    return reduce(lambda a, b: a + b, terms)


def signature_from_columns(z_cols: list[Column], R: list[list[float]]) -> Column:
    """F2 over standardised scalar columns: a string of '0'/'1', bit 0 first."""
    bits = [F.when(_dot(z_cols, row) >= 0, F.lit("1")).otherwise(F.lit("0")) for row in R]
    return F.concat(*bits)


def signature_from_array(vec: Column, R: list[list[float]]) -> Column:
    """F2 over an ``array<float|double>`` column (dims = len(R[0])).

    The dot products are unrolled into element reads (``get`` gives NULL
    past the end, like a short vector), which stay in generated code;
    higher-order ``zip_with``/``aggregate`` would be interpreted per row."""
    elems = [F.get(vec, j).cast("double") for j in range(len(R[0]))]
    return signature_from_columns(elems, R)


@dataclass(frozen=True)
class LshModel:
    """Scaler statistics plus the projection matrix (model params, S4/K3)."""

    features: list[str]
    mean: list[float]
    scale: list[float]
    R: list[list[float]] = field(default_factory=list)

    @property
    def bits(self) -> int:
        return len(self.R)

    def standardised(self) -> list[Column]:
        return [standardise(F.col(c), m, s) for c, m, s in zip(self.features, self.mean, self.scale)]

    def signature(self) -> Column:
        return signature_from_columns(self.standardised(), self.R)

    def transform(self, df: DataFrame, out: str = "firma_lsh") -> DataFrame:
        return df.withColumn(out, self.signature())

    def to_row(self) -> dict:
        return {"scaler_mean": list(self.mean), "scaler_scale": list(self.scale), "R": [list(r) for r in self.R]}

    @staticmethod
    def from_row(row: dict, features: list[str]) -> "LshModel":
        return LshModel(features, list(row["scaler_mean"]), list(row["scaler_scale"]), [list(r) for r in row["R"]])
