"""Descriptive statistics and classification metrics.

Exact quantiles without one-task aggregation
--------------------------------------------
``percentile`` keeps every distinct value of a group in one buffer and the
final merge happens in a single task, which does not survive 100 TB.  Here
the value at rank k is found by histogram refinement instead: each pass is
one distributed aggregate over the current value brackets that returns at
most ``BUCKETS`` rows per bracket (count, min, max per bucket); the bucket
holding rank k becomes the next bracket.  All wanted ranks, of all columns,
are refined in the same passes.  The ends of a bracket lie in its first and last bucket, so
every pass shrinks it, and a bracket whose min equals its max (a hot value)
ends the search at once.

NaN is a missing value, as in pandas: it is left out of counts, means and
ranks alike.  Infinities are values.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
BEYOND = 1000.0  # above log1p of every finite double


def present(c: Column, dtype: str) -> Column:
    """The value, NULL for NaN."""
    return F.when(~F.isnan(c), c) if dtype in ("double", "float") else c


def _squeezed(v: Column) -> Column:
    """A monotone image of a double with finite differences: signed log1p, infinities beyond the rest."""
    size = F.when(F.abs(v) == F.lit(math.inf), F.lit(BEYOND)).otherwise(F.log1p(F.abs(v)))
    return F.when(v < 0, -size).otherwise(size)


def _squeeze(x: float) -> float:
    return math.copysign(BEYOND if math.isinf(x) else math.log1p(abs(x)), x)


class Ranks:
    """Exact values of 0-based ranks of many columns, refined in the same passes.

    Every pass is one job over the source, whatever the number of columns: a
    row yields an entry per bracket that holds one of its values, and the
    entries are counted by (bracket, bucket), at most ``BUCKETS`` of them per
    bracket, with the smallest and the greatest value of each.  Values travel
    in a field of their own type, one field per type among the columns, so
    64-bit keys and decimals stay exact; only the bucket index is computed in
    floating point, which is monotone and so never reorders values.  Where a
    bracket of doubles is too wide for a finite difference, its buckets are
    equal steps of the logarithm."""

    def __init__(self, df: DataFrame, cols: list[str]):
        dtypes = dict(df.dtypes)
        self.kinds = [dtypes[c] for c in cols]
        self.slots = sorted(set(self.kinds))
        self.base = df.select(*[present(F.col(c), t).alias(f"v{i}") for i, (c, t) in enumerate(zip(cols, self.kinds))])

    def sizes(self) -> list[tuple]:
        """(values present, least, greatest) per column, in one job."""
        if not self.kinds:
            return []
        aggs = [f(f"v{i}").alias(f"{n}{i}") for i in range(len(self.kinds)) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
        r = self.base.agg(*aggs).first()
        return [(r[f"n{i}"], r[f"lo{i}"], r[f"hi{i}"]) for i in range(len(self.kinds))]

    def _entry(self, i: int, lo, hi, bracket: int) -> Column:
        """The entry of column ``i``'s value for the bracket [lo, hi]; NULL where the value is not in it."""
        v, kind = F.col(f"v{i}"), self.kinds[i]
        low = F.lit(lo).cast(kind)
        if kind in ("double", "float"):
            wide = not math.isfinite(float(hi) - float(lo))
            span = _squeeze(hi) - _squeeze(lo) if wide else float(hi) - float(lo)
            offset = _squeezed(v.cast("double")) - F.lit(_squeeze(lo)) if wide else v.cast("double") - F.lit(float(lo))
        else:
            # Spans and offsets from exact differences: adjacent 64-bit keys can share one double, their difference cannot.
            exact = "decimal(38,0)" if not kind.startswith("decimal") else kind
            span, offset = float(hi - lo), (v.cast(exact) - low.cast(exact)).cast("double")
        bucket = F.floor(offset / F.lit(span) * F.lit(BUCKETS - 1.0)).cast("int")
        values = [(v if t == kind else F.lit(None).cast(t)).alias(f"s{j}") for j, t in enumerate(self.slots)]
        return F.when((v >= low) & (v <= F.lit(hi).cast(kind)), F.struct(F.lit(bracket).alias("bid"), bucket.alias("b"), *values))

    def at(self, wanted: list[list[int]], sizes: list[tuple] | None = None) -> list[dict[int, object]]:
        """Per column, rank -> value; ranks that a column does not have are left out."""
        sizes = self.sizes() if sizes is None else sizes
        brackets = {(i, k): (lo, hi, 0) for i, (n, lo, hi) in enumerate(sizes) for k in set(wanted[i]) if 0 <= k < n}
        out: list[dict[int, object]] = [{} for _ in sizes]
        while True:
            for (i, k), (lo, hi, _) in brackets.items():
                if lo == hi:
                    out[i][k] = lo
            brackets = {at: b for at, b in brackets.items() if b[0] != b[1]}
            if not brackets:
                return out
            uniq = sorted({(i, *b) for (i, _), b in brackets.items()}, key=lambda u: (u[0], u[3]))
            entries = F.array(*[self._entry(i, lo, hi, n) for n, (i, lo, hi, _) in enumerate(uniq)])
            ends = [f(f"s{j}").alias(f"{n}{j}") for j in range(len(self.slots)) for n, f in (("lo", F.min), ("hi", F.max))]
            hist = (self.base.select(F.explode(entries).alias("e")).where(F.col("e").isNotNull()).select("e.*")
                    .groupBy("bid", "b").agg(F.count(F.lit(1)).alias("n"), *ends).collect())
            by_bracket: dict[int, list] = {}
            for r in sorted(hist, key=lambda r: (r["bid"], r["b"])):
                by_bracket.setdefault(r["bid"], []).append(r)
            place = {u: n for n, u in enumerate(uniq)}
            for (i, k), b in brackets.items():
                below, slot = b[2], self.slots.index(self.kinds[i])
                for r in by_bracket[place[(i, *b)]]:
                    if k - below < r["n"]:
                        brackets[i, k] = (r[f"lo{slot}"], r[f"hi{slot}"], below)
                        break
                    below += r["n"]


def values_at_ranks(df: DataFrame, col: str, ks: list[int]) -> dict[int, float]:
    """Exact values of the 0-based ranks ``ks`` among the non-null values of ``col``, all refined in the same passes."""
    return Ranks(df, [col]).at([ks])[0]


def value_at_rank(df: DataFrame, col: str, k: int):
    """Exact value of 0-based rank ``k`` among the non-null values of ``col``."""
    return values_at_ranks(df, col, [k]).get(k)


def quantiles(df: DataFrame, cols: list[str], ps: list[float]) -> list[list[float | None]]:
    """Per column, linear interpolation between the two closest ranks (pandas / DuckDB ``quantile_cont``)."""
    ranks = Ranks(df, cols)
    sizes = ranks.sizes()
    wanted = [sorted({k for p in ps for k in (int(p * (n - 1)), min(int(p * (n - 1)) + 1, n - 1))}) if n else [] for n, _, _ in sizes]
    found = ranks.at(wanted, sizes)

    def between(i: int, p: float) -> float | None:
        n = sizes[i][0]
        if n == 0:
            return None
        x = p * (n - 1)
        k, frac = int(x), x - int(x)
        lo = float(found[i][k])
        hi = lo if frac == 0 or k + 1 >= n else float(found[i][k + 1])
        return lo if lo == hi else lo + (hi - lo) * frac
    return [[between(i, p) for p in ps] for i in range(len(cols))]


def exact_quantiles(df: DataFrame, col: str, ps: list[float]) -> list[float | None]:
    """``quantiles`` of one column."""
    return quantiles(df, [col], ps)[0]


def exact_quantile(df: DataFrame, col: str, p: float) -> float | None:
    return exact_quantiles(df, col, [p])[0]


def _r2(x):
    """Round half-even on the binary product, like ``numpy.round``."""
    if x is None:
        return None
    return float(np.rint(x * 100.0) / 100.0)


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (linear), max, rounded to 2.

    All columns share the source's scans: one for the moments, one for the
    ends and one per refinement pass of all quartiles."""
    spark = df.sparkSession
    schema = ("column string, count bigint, mean double, std double, min double, "
              "p25 double, p50 double, p75 double, max double")
    if not cols:
        return spark.createDataFrame([], schema)
    v = [present(F.col(c).cast("double"), "double") for c in cols]
    r = df.agg(*[f(x).alias(f"{n}{i}") for i, x in enumerate(v) for n, f in (
        ("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("lo", F.min), ("hi", F.max))]).first()
    rows = [(c, int(r[f"n{i}"]), _r2(r[f"mean{i}"]), _r2(r[f"std{i}"]), _r2(r[f"lo{i}"]), *map(_r2, q), _r2(r[f"hi{i}"]))
            for i, (c, q) in enumerate(zip(cols, quantiles(df, cols, [0.25, 0.5, 0.75])))]
    return spark.createDataFrame(rows, schema)


def class_counts(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Rows per (y, yhat) pair: the one pass over the data (combined before the shuffle) that A13 and A14 need."""
    return df.groupBy(F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(F.count(F.lit(1)).alias("n"))


def _classes(counts: DataFrame, classes: list | None) -> DataFrame:
    """One row with the sorted classes, from the pair counts (or as given); NULL is no class."""
    if classes is not None:
        return counts.sparkSession.range(1).select(F.lit(list(classes)).alias("classes"))
    both = counts.select(F.explode(F.array("y", "yhat")).alias("c"))
    return both.agg(F.array_sort(F.collect_set("c")).alias("classes"))


def confusion_matrix(df: DataFrame, y: str = "y", yhat: str = "yhat", classes: list | None = None) -> DataFrame:
    """One row per (true, predicted) class pair, zero-filled: the grid of
    the classes (its size is the result's) with the pair counts joined on."""
    counts = class_counts(df, y, yhat)
    grid = (_classes(counts, classes).select(F.explode("classes").alias("y"), "classes")
            .select("y", F.explode("classes").alias("yhat")))
    return grid.join(counts, ["y", "yhat"], "left").select("y", "yhat", F.coalesce("n", F.lit(0)).alias("n"))


def classification_report(df: DataFrame, y: str = "y", yhat: str = "yhat", classes: list | None = None) -> DataFrame:
    """Precision, recall, f1, support per class; accuracy; macro and
    weighted averages.  A zero denominator gives 0 (scikit-learn's default).
    Rows with a NULL label or prediction count in the total only."""
    counts = class_counts(df, y, yhat)
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(zero)
    part = lambda c, tp, pp, sp, t: F.struct(F.col(c).alias("c"), tp.alias("tp"), pp.alias("pp"), sp.alias("sp"), t.alias("t"))
    parts = counts.select(F.inline(F.array(part("y", hit, zero, F.col("n"), F.col("n")), part("yhat", zero, F.col("n"), zero, zero))))
    if classes is not None:
        listed = _classes(counts, classes).select(F.explode("classes").alias("c"))
        parts = parts.withColumn("c", F.when(F.col("c").isin(list(classes)), F.col("c")))
        parts = parts.unionByName(listed.select("c", *[zero.alias(x) for x in ("tp", "pp", "sp", "t")]))
    sums = parts.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("tp", "pp", "sp", "t")])

    def div(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    p, r = div(F.col("tp"), F.col("pp")), div(F.col("tp"), F.col("sp"))
    per = F.struct(F.col("c").alias("key"), F.col("c").cast("string").alias("label"), p.alias("precision"), r.alias("recall"),
                   div(2 * p * r, p + r).alias("f1"), F.col("sp").alias("support"))
    x = sums.agg(F.sum("t").alias("total"), F.sum("tp").alias("correct"),
                 F.array_sort(F.collect_list(F.when(F.col("c").isNotNull(), per))).alias("per"))
    x = x.withColumns({"total": F.coalesce("total", zero), "correct": F.coalesce("correct", zero),
                       "per": F.transform("per", lambda s: F.struct(s["label"].alias("label"), s["precision"].alias("precision"),
                                                                    s["recall"].alias("recall"), s["f1"].alias("f1"), s["support"].alias("support")))})
    k = F.size("per").cast("double")

    def mean_of(field):
        return div(F.aggregate(F.col("per"), F.lit(0.0), lambda acc, s: acc + s[field]), k)

    def weighted(field):
        return div(F.aggregate(F.col("per"), F.lit(0.0), lambda acc, s: acc + s[field] * s.support), F.col("total"))

    extra = F.array(
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), div(F.col("correct"), F.col("total")).alias("f1"),
                 F.col("total").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), mean_of("precision").alias("precision"),
                 mean_of("recall").alias("recall"), mean_of("f1").alias("f1"), F.col("total").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), weighted("precision").alias("precision"),
                 weighted("recall").alias("recall"), weighted("f1").alias("f1"), F.col("total").alias("support")),
    )
    return x.select(F.inline(F.concat(F.col("per"), extra)))
