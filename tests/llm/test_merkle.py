import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from credlake.llm import merkle
from credlake.llm.op12_merkle import op12_merkle_manifest

NAMES = ["doc_id", "source", "lang", "n_chars", "text"]
# Columns that the rows do not need, under names that the operator uses.
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, hash string, `group` int, rank int, node int, path int, root int, block int, part int"


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(hashes, fanout):
    """(root, for each leaf its (left, right) steps)."""
    steps, at, now = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(now) > 1:
        runs = [now[i:i + fanout] for i in range(0, len(now), fanout)]
        for i, k in enumerate(at):
            run = runs[k // fanout]
            steps[i].append(("".join(run[:k % fanout]), "".join(run[k % fanout + 1:])))
        at, now = [k // fanout for k in at], [h(*r) for r in runs]
    return now[0], steps


def plain(rows, fanout=2):
    """(doc_id, leaf, subroot, root, steps) sorted."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r[:5])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])], fanout) for g in order}
    if not order:
        return []
    root, above = tree([trees[g][0] for g in order], fanout)
    return sorted((str(x[1] if x[0] else None), x[2], trees[g][0], root, trees[g][1][i] + above[j])
                  for j, g in enumerate(order) for i, x in enumerate(sorted(groups[g])))


def documents(n=260):
    rng = random.Random(2)
    rows = [(i * 7 % 1009, f"s{i % 3}", rng.choice(["en", "en", "en", "é", "zz", None, "", "-", "=a"]), i, f"text {rng.random()} é漢") for i in range(n)]
    rows += [(2000, None, "lone", None, None), (None, "s", "en", 3, "x"), (None, "s", "en", 3, "y"), (5, "s", "en", 1, "same"), (5, "s", "en", 1, "same"),
             (5, "s", "en", 1, "other"), (77, "s", "en", None, ""), (3000, "s", "en", 9223372036854775807, "a" * 200_000)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "h", 1, 2, 3, 4, 5, 6, 7) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("fanout,depth", [(2, 3), (3, 2), (2, 10)])
def test_equals_plain_tree(spark, fanout, depth):
    rows = documents()
    got = merkle.manifest(frame(spark, rows), "doc_id", "lang", NAMES, {"block": F.col("text")}, fanout, depth)
    assert got.columns == ["doc_id", "leaf", "path", "subroot", "root", "block"]
    out = got.withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.path]) for r in out) == plain(rows, fanout)
    assert all(r.folded == r.root for r in out)
    text = {leaf(r): r[4] for r in rows}
    assert all(r.block == text[r.leaf] for r in out)


def test_query(spark, tmp_path):
    rows = documents()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = op12_merkle_manifest(spark, str(tmp_path)).collect()
    want = plain(rows)
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256) for r in out) == sorted((*w[:4], h(*[a + b for a, b in w[4]])) for w in want)
    changed = {leaf(r) for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None and r[3] < 2**63 - 1}
    assert changed and all(r.verified == (r.leaf not in changed) == (r.folded_root == r.root) for r in out)
    assert len({r.folded_root for r in out if not r.verified}) == len({r.leaf for r in out if not r.verified})


def test_small_tables(spark):
    for rows in ([], [(1, None, None, None, None)], [(None,) * 5] * 5, [(i, "s", str(i), 1, "t") for i in range(9)]):
        got = merkle.manifest(frame(spark, rows), "doc_id", "lang", NAMES, depth=2).collect()
        assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.path]) for r in got) == plain(rows)


def test_no_join_and_one_exchange_per_block_tier(spark):
    leaves = spark.range(5000).selectExpr("cast(id % 3 as string) as `group`", "id div 3 as rank", "sha2(cast(id as string), 256) as hash", "id")
    plan = merkle._nest(leaves, ["id"], 2, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
