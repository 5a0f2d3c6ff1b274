import hashlib
import math
import random

import numpy as np
import pytest

from credlake.llm import centroids as cc
from credlake.llm.op11_centroids import op11_centroid_clusters

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string, ids string"


def plain(rows, dims, k, rounds, scale, seed):
    """Every vector against every centroid, in Python integers."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    ints = [[math.floor(scale * x) for x in v] for _, v in kept]
    order = sorted(range(len(kept)), key=lambda r: (hashlib.sha256(f"{seed}:{'' if kept[r][0] is None else kept[r][0]}".encode()).hexdigest(), kept[r][1]))
    c = [list(ints[r]) for r in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        to = [nearest(v)[1] for v in ints]
        for j in range(len(c)):
            mine = [v for v, t in zip(ints, to) if t == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted(((i, *nearest(v)[::-1]) for (i, _), v in zip(kept, ints)), key=str), c


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA).repartition(parts)


def got(found):
    return sorted(((r.vec_id, r.cluster, r.distance) for r in found.assigned.collect()), key=str)


@pytest.mark.parametrize("case", ["normal", "grid", "groups"])
def test_equals_brute_force(spark, case, monkeypatch):
    rng = random.Random(case)
    monkeypatch.setattr(cc, "BLOCK", 100)
    if case == "normal":
        rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    elif case == "grid":  # ties everywhere, copies, more seeds than different vectors
        rows = [(i % 300, [float(rng.randrange(2)) for _ in range(6)]) for i in range(400)]
    else:  # a third of all rows is one vector
        rows = [(i, [1.5] * 6 if i % 3 == 0 else [rng.gauss(5 * (i % 4), 0.1) for _ in range(6)]) for i in range(400)]
    want, c = plain(rows, 6, 25, 3, 256, "2")
    found = cc.cluster(frame(spark, rows), dims=6, k=25, rounds=3)
    assert got(found) == want and found.centroids == c


def test_search_spares_comparisons_and_counts_its_bounds():
    rng = np.random.default_rng(1)
    middle = rng.integers(-4000, 4000, (50, 8))
    x = np.repeat(middle, 40, 0) + rng.integers(-60, 60, (2000, 8))
    state = [np.zeros(2000, np.int32), np.ones(2000, np.int32), np.full(2000, np.inf), np.full(2000, -np.inf)]
    before, now, measured = None, middle.tolist(), []
    for _ in range(3):
        measured.append(cc.search(cc.Centroids(now, before), x, *state))
        full = ((x[:, None] - np.array(now)) ** 2).sum(2)
        assert (state[0] == full.argmin(1)).all()
        assert (state[2] >= np.sqrt(full.min(1)) - 1e-6).all() and (state[3] <= np.sqrt(np.sort(full, 1)[:, 1]) + 1e-6).all()
        before, now = now, (np.array(now) + 3).tolist()
    assert measured[0] <= 2000 * 50 and max(measured[1:]) < 2000 * 3  # the first round knows nothing yet


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0]), (1, [0.5, 1.0]), (None, [2.0, 2.0]), (3, None), (4, []), (5, [1.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [1.0, -inf]),
            (9, [-0.001, -3.3]), (10, [6e6, -6e6]), (11, [6e6, -6e6])]
    for k in (1, 3, 50):
        want, c = plain(rows, 2, k, 2, 256, "2")
        found = cc.cluster(frame(spark, rows), dims=2, k=k, rounds=2)
        assert got(found) == want and found.centroids == c
    assert [cc.whole(np.array([[v, 0.0]]), 0).dtype for v in (1e6, 1e9, 1e12)] == [np.int64, np.int64, object]


def test_large_components_stay_exact(spark):
    rows = [(i, [float(1 << 22) + i, float(i % 2) * (1 << 22)]) for i in range(7)]
    want, c = plain(rows, 2, 3, 2, 256, "2")
    found = cc.cluster(frame(spark, rows), dims=2, k=3, rounds=2)
    assert got(found) == want and found.centroids == c


def test_query_and_empty(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(64)]) for i in range(120)] + [(500, None)]
    for at, some in (("a", rows), ("b", [])):
        frame(spark, some).write.parquet(f"{tmp_path}/{at}/embeddings.parquet")
        out = {r.vec_id: r for r in op11_centroid_clusters(spark, f"{tmp_path}/{at}").collect()}
        want, c = plain(some, 64, 40, 5, 256, "2")
        assert sorted(((i, r.cluster, r.distance) for i, r in out.items()), key=str) == want
        for i, j, _ in want:
            assert out[i].inertia == sum(w[2] for w in want) and out[i].cluster_inertia == sum(w[2] for w in want if w[1] == j)
            assert out[i].centroid_sha256 == hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()
