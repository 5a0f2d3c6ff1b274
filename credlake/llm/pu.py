r"""A quality classifier learned from positive and unlabelled texts.

The trusted positives are rows labelled good; all other texts, labels unseen,
stand for the web.  With the class prior p, the logistic loss l and a score
f(x), the risk is  p E+[l(f)] + max(0, Eu[l(-f)] - p E+[l(-f)]): the second
term is the negatives' risk, estimated without a negative and never let
below 0.  The unclipped risk is convex and Newton's steps minimise it; a step
that takes the second term below -``beta`` (0.1, more than a slightly high
prior does: a fit to chance) is halved back until it is not.  Of the weights
met where it is not, those with the least risk are kept.

Features are shares and logarithms measured on the whole text, cut at
quantiles of the corpus into indicator bins, so the linear score is a sum of
free curves.  Quantiles, risks, gradients and curvature are all aggregates
over every training row (partial sums per task, a few kilobytes each, added
up by Spark); nothing is sampled.  The features are written once.

The prior, unless given, is estimated without a negative label either: a
first model is fitted at prior 0.5 to four fifths of the training rows, and
on the rest the share of all texts above a score is divided by the share of
trusted positives above it.  Every such ratio is at least the prior, and near
the top, where negatives are rare, it is close to it; the score is the one
with the least upper confidence bound (best bin estimation).  The shares come
from one aggregate of a fixed number of score bins.

Defined results: null and empty texts have all-zero features and get a score
like any other; rows without a usable label are unlabelled; of several labels
of one key the least counts; a null key is held out; repeated rows get equal
scores; with no positive or no unlabelled row every score is the prior, and
with no positive to estimate it from the prior is 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlake.llm.common import fresh, ship, stored, utf8

BINS = 1000
CUTS = [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
SPACE = b" \t\n\x0b\x0c\r"
UPPER, DIGIT = bytes(range(65, 91)), bytes(range(48, 58))
MARKS, STOPS, TABLE = b"#*$%&<>@^~_=+\\/[]{}", b".,;:", b"|"
CONTINUED = bytes(range(0x80, 0xC0))
NAMES = ["words", "letters_per_word", "marks", "bangs", "stops", "table", "upper", "digits", "wide", "echo", "variety", "repeats", "lines", "dup_lines",
         "upper_words", "long_words", "mark_words"]


def features(text: bytes) -> list[float]:
    """Measures of a whole text, in the order of ``NAMES``."""
    words = text.split()
    n, size = len(words), len(text.translate(None, SPACE + CONTINUED))
    if not n:
        return [0.0] * len(NAMES)

    def share(chars: bytes) -> float:
        return (len(text) - len(text.translate(None, chars))) / size
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    wide = sum(map(len, words)) - len(text.translate(None, SPACE + bytes(range(0x80, 0x100))))
    return [math.log1p(n), size / n, share(MARKS), share(b"!"), share(STOPS), share(TABLE), share(UPPER), share(DIGIT), wide / size,
            sum(map(bytes.__eq__, words, words[1:])) / n, len(set(words)) / n ** 0.9, 1 - pairs / max(1, n - 1),
            math.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines), sum(map(bytes.isupper, words)) / n,
            sum(len(w) > 20 for w in words) / n, sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n]


def measured(text: Column) -> Column:
    ship()

    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        flat = [x for t in texts for x in features(t.as_py())]
        ends = np.arange(len(texts) + 1, dtype=np.int32) * len(NAMES)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.float64()))
    return run(utf8(text))


def bins(x: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """A leading 1, and per feature an indicator for every cut that the value is above."""
    columns = [np.ones((len(x), 1))]
    columns += [(x[:, [i]] > np.array([c])).astype(float) for i, c in enumerate(cuts) if c]
    return np.concatenate(columns, axis=1)


def sums(batches: Iterator[pa.RecordBatch], cuts: list[list[float]], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's part of the aggregates: per place of the flat vector a row (place, value)."""
    d = len(weights)
    total = np.zeros(5 + 2 * d + d * d)
    for batch in batches:
        if not batch.num_rows:
            continue
        positive = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
        x = bins(batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1), cuts)
        f = x @ weights
        p = 1 / (1 + np.exp(-np.clip(f, -50, 50)))
        high, low = np.logaddexp(0, f), np.logaddexp(0, -f)  # l(-f) and l(f)
        total[:5] += len(x), positive.sum(), high.sum(), high[positive].sum(), low[positive].sum()
        total[5:5 + d] += p @ x
        total[5 + d:5 + 2 * d] += x[positive].sum(axis=0)
        total[5 + 2 * d:] += ((x * (p * (1 - p))[:, None]).T @ x).ravel()
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])


class Model:
    def __init__(self, cuts: list[list[float]], weights: np.ndarray, prior: float):
        self.cuts, self.weights, self.prior = cuts, weights, prior

    def score(self, x: Column) -> Column:
        """The probability of the positive class, by expressions over the feature array."""
        f, at = F.lit(float(self.weights[0])), 1
        for i, cuts in enumerate(self.cuts):
            for cut in cuts:
                f = f + F.when(x[i] > F.lit(float(cut)), F.lit(float(self.weights[at]))).otherwise(F.lit(0.0))
                at += 1
        return 1 / (1 + F.exp(-f))


def fit(rows: DataFrame, prior: float, rounds: int = 25, ridge: float = 1e-3, beta: float = 0.1) -> Model:
    """Minimise the risk over ``rows``: ``positive`` (boolean) and ``x`` (features); every row counts as unlabelled."""
    ship()
    edges = rows.agg(*[F.percentile_approx(F.col("x")[i], CUTS, 10_000).alias(f"c{i}") for i in range(len(NAMES))]).first()
    cuts = [sorted(set(c or [])) for c in edges]
    d = 1 + sum(map(len, cuts))
    weights, stale = np.zeros(d), 0
    start = min(max(prior, 1e-3), 1 - 1e-3)
    weights[0] = math.log(start / (1 - start))
    base, best = weights, (math.inf, weights)
    for _ in range(rounds):
        parts = rows.select("positive", "x").mapInArrow(lambda b, w=weights: sums(b, cuts, w), "place long, value double")
        got = {r["place"]: r["value"] for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect()}
        t = np.array([got.get(i, 0.0) for i in range(5 + 2 * d + d * d)])
        n, k = t[0], t[1]
        if not n or not k:
            return Model([[] for _ in cuts], weights[:1], prior)
        pu, px, curve = t[5:5 + d] / n, t[5 + d:5 + 2 * d] / k, t[5 + 2 * d:].reshape(d, d) / n
        negatives = t[2] / n - prior * t[3] / k
        risk = prior * t[4] / k + max(0.0, negatives) + ridge / 2 * weights[1:] @ weights[1:]
        if negatives < -beta:
            weights = (weights + base) / 2
            continue
        if risk < best[0] - 1e-5:
            best, stale = (risk, weights), 0
        elif (stale := stale + 1) >= 2:
            break
        pull = ridge * np.concatenate(([0.0], weights[1:]))
        # the gradient of  prior E+[l(f) - l(-f)] + Eu[l(-f)],  and l(f) - l(-f) = -f
        step = np.linalg.solve(curve + ridge * np.eye(d), pu - prior * px + pull)
        base, weights = weights, weights - step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
    return Model(cuts, best[1], prior)


def prior_of(counts: dict[int, tuple[int, int]], slack: float = 0.1, error: float = 0.1) -> float:
    """The class prior from {score bin: (all rows, positives)}; 0.5 without a positive."""
    n, k = (sum(c[i] for c in counts.values()) for i in (0, 1))
    if not n or not k:
        return 0.5
    room = sum(math.sqrt(math.log(4 / error) / 2 / m) for m in (n, k)) * (1 + slack)
    best, above, good = (math.inf, 0.5), 0, 0
    for b in sorted(counts, reverse=True):
        above, good = above + counts[b][0], good + counts[b][1]
        if good:
            best = min(best, ((above / n + room) / (good / k), (above / n) / (good / k)))
    return min(max(best[1], 0.01), 0.99)


def estimated_prior(train: DataFrame) -> float:
    """The share of positives among the texts of ``train`` (``fold``, ``positive``, ``x``)."""
    first = fit(train.where("fold > 0"), 0.5)
    tail = (train.where("fold = 0").groupBy(F.floor(first.score(F.col("x")) * BINS).alias("bin"))
            .agg(F.count("*").alias("n"), F.count_if("positive").alias("good")))
    return prior_of({r["bin"]: (r["n"], r["good"]) for r in tail.collect()})


def held_out(key: Column, folds: int = 5) -> Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def score(df: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text", prior: float | None = None) -> DataFrame:
    """(key, held_out, score) for every row of ``df``; only the labels 1 of keys that are not held out are read."""
    trusted = (labels.groupBy(F.col(key).alias("known_key")).agg(F.min(F.when(F.col(label).isin(0, 1), F.col(label))).alias("least"))
               .where((F.col("least") == 1) & ~held_out(F.col("known_key"))).select("known_key"))
    rows = stored(df.select(F.col(key).alias("row_key"), held_out(F.col(key)).alias("held_out"), measured(F.col(text)).alias("x")), "features")
    train = rows.where(~F.col("held_out")).join(trusted, F.col("row_key") == F.col("known_key"), "left")
    train = stored(train.select(F.pmod(F.xxhash64("row_key"), F.lit(5)).alias("fold"), F.col("known_key").isNotNull().alias("positive"), "x"), "training")
    model = fit(train, estimated_prior(train) if prior is None else prior)
    name = key if key not in ("held_out", "score") else fresh(df, key)
    return rows.select(F.col("row_key").alias(name), "held_out", model.score(F.col("x")).alias("score"))
