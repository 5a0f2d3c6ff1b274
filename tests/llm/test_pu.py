import zlib

import numpy as np
import pytest

from credlake.llm import pu
from credlake.llm.op3_quality_classifier import op3_pu_classifier

SF = "/root/testdata/sf0.1"


def area(score, label):
    order = np.argsort(np.argsort(score)) + 1
    good = label == 1
    n, m = good.sum(), (~good).sum()
    return (order[good].sum() - n * (n + 1) / 2) / (n * m)


def test_held_out_accuracy(spark):
    rows = op3_pu_classifier(spark, SF).toPandas()
    assert rows.score.between(0, 1).all() and ((rows.score >= 0.3) == (rows.predicted == 1)).all()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    known = spark.read.parquet(f"{SF}/labels.parquet").toPandas().merge(rows[rows.held_out], on="doc_id")
    assert len(known) > 500
    assert area(known.score.to_numpy(), known.quality.to_numpy()) > 0.98
    assert (known.predicted == known.quality).mean() > 0.97


def test_held_out_labels_are_never_read(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    one = pu.score(docs, labels).orderBy("doc_id", "score").collect()
    changed = labels.withColumn("quality", (1 - labels.quality) * pu.held_out(labels.doc_id).cast("int") + labels.quality * (~pu.held_out(labels.doc_id)).cast("int"))
    two = pu.score(docs, changed).orderBy("doc_id", "score").collect()
    assert [round(r.score, 9) for r in one] == [round(r.score, 9) for r in two] and len(one) == docs.count()


def test_labels_0_are_never_read(spark):
    """Dropping every label 0 changes no score: the prior too comes from trusted positives and all texts."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    one = {r.doc_id: r.score for r in pu.score(docs, labels).collect()}
    two = {r.doc_id: r.score for r in pu.score(docs, labels.where("quality = 1")).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_prior_from_the_tail_of_the_scores():
    rng = np.random.default_rng(2)
    for true in (0.1, 0.4, 0.8):
        positive = np.clip(rng.normal(0.8, 0.1, 40_000), 0, 1)
        mixed = np.where(rng.random(200_000) < true, np.clip(rng.normal(0.8, 0.1, 200_000), 0, 1), np.clip(rng.normal(0.3, 0.1, 200_000), 0, 1))
        bins = np.floor(mixed * pu.BINS).astype(int), np.floor(positive * pu.BINS).astype(int)
        counts = {int(b): (int((bins[0] == b).sum()), int((bins[1] == b).sum())) for b in np.union1d(*bins)}
        assert abs(pu.prior_of(counts) - true) < 0.02
    assert pu.prior_of({}) == 0.5 and pu.prior_of({3: (10, 0)}) == 0.5


def plain_risk(w, x, positive, cuts, prior, ridge=1e-3):
    f = pu.bins(x, cuts) @ w
    negatives = np.logaddexp(0, f).mean() - prior * np.logaddexp(0, f[positive]).mean()
    return prior * np.logaddexp(0, -f[positive]).mean() + max(0.0, negatives) + ridge / 2 * w[1:] @ w[1:], negatives


@pytest.mark.parametrize("prior", [0.3, 0.95])
def test_fit_finds_weights_of_less_risk_than_any_near_them(spark, prior):
    """At 0.95 the negatives' risk falls below 0 on the way, so steps are halved back."""
    rng = np.random.default_rng(4)
    x = rng.random((3000, len(pu.NAMES)))
    good = x[:, 0] + x[:, 1] > 1.1
    positive = good & (rng.random(len(x)) < 0.5)
    rows = spark.createDataFrame([(bool(p), v.tolist()) for p, v in zip(positive, x)], "positive boolean, x array<double>")
    model = pu.fit(rows, prior)
    least, negatives = plain_risk(model.weights, x, positive, model.cuts, prior)
    start = np.zeros(len(model.weights))
    start[0] = np.log(prior / (1 - prior))
    assert least < plain_risk(start, x, positive, model.cuts, prior)[0] and negatives >= -0.1
    if prior == 0.3:
        for _ in range(300):
            assert plain_risk(model.weights + rng.normal(size=len(start)) * 0.05, x, positive, model.cuts, prior)[0] > least - 1e-3
    scores = 1 / (1 + np.exp(-pu.bins(x, model.cuts) @ model.weights))
    assert area(scores, good.astype(int)) > 0.9
    got = [r[0] for r in rows.select(model.score(rows.x)).collect()]
    assert np.allclose(sorted(got), sorted(scores))


def test_risk_is_minimised_by_the_fit():
    """A step of the aggregates from one task equals the gradient of the risk taken numerically."""
    import pyarrow as pa
    rng = np.random.default_rng(1)
    x = rng.random((300, len(pu.NAMES)))
    positive = rng.random(300) < 0.4
    cuts = [[0.5] for _ in pu.NAMES]
    batch = pa.RecordBatch.from_arrays([pa.array(positive), pa.array(list(x), pa.list_(pa.float64()))], ["positive", "x"])
    d = 1 + len(cuts)
    w = rng.normal(size=d) * 0.3

    def total(v):
        return next(pu.sums(iter([batch]), cuts, v)).column(1).to_numpy()

    def risk(v, prior=0.3):
        t = total(v)
        return prior * t[4] / t[1] + t[2] / t[0] - prior * t[3] / t[1]
    t = total(w)
    gradient = t[5:5 + d] / t[0] - 0.3 * t[5 + d:5 + 2 * d] / t[1]
    numeric = [(risk(w + e) - risk(w - e)) / 2e-5 for e in np.eye(d) * 1e-5]
    assert np.allclose(gradient, numeric, atol=1e-6)


def test_no_labels_and_empty_table(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {round(r.score, 6) for r in pu.score(docs, none).collect()} == {0.5}
    assert pu.score(empty, none).count() == 0
