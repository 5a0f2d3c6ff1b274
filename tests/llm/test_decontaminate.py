import hashlib
import re

from credlake.llm import decontaminate
from credlake.llm.op7_decontaminate import op7_winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items):
    """(words, hit word places, ids)."""
    words, hit, ids = split(text), set(), set()
    for item, body in items:
        w = split(body)
        size = min(13, len(w))
        windows = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(words) - size + 1 if w else 0):
            if tuple(words[i:i + size]) in windows:
                hit |= set(range(i, i + size))
                ids.add(str(item))
    return len(words), hit, ids


def test_query_equals_plain_version(spark, sf, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = []
    for r in docs.collect():
        n, hit, ids = plain(r.text, items)
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        want.append((-1 if r.doc_id is None else r.doc_id, n, len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= n))
    got = sorted(tuple(-1 if x is None else x for x in r) for r in op7_winnowing(spark, sf).collect())
    assert got == sorted(want) and any(w[-1] for w in want)


def test_more_blocks_give_the_same(spark, sf, docs):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").unionByName(spark.createDataFrame([(None, "gina1 x y"), (9, "x")], "item_id long, text string"))
    one = decontaminate.find(docs, bench).collect()
    many = decontaminate.find(docs, bench, block_bytes=60).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words, str(r.spans), str(r["items"]))
    assert sorted(map(key, one)) == sorted(map(key, many)) and len(one) == docs.count()


def test_long_items_in_pieces(monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 5)
    body = " ".join(f"w{i % 17}x{i}" for i in range(60)).encode()
    whole = {tuple(decontaminate.words_of(body)[i:i + 13]) for i in range(48)}
    cut = {tuple(w[i:i + 13]) for _, w in decontaminate.pieces_of("a", body) for i in range(len(w) - 12)}
    assert cut == whole


def test_every_shared_window_has_a_common_fingerprint():
    import random

    import numpy as np
    rng = random.Random(2)
    for _ in range(200):
        span = [rng.randint(1, 9) for _ in range(13)]
        a = np.array([rng.randint(1, 9) for _ in range(9)] + span + [4, 4], np.uint64)
        b = np.array([7] + span + [rng.randint(1, 9) for _ in range(20)], np.uint64)
        assert decontaminate.winnow(a)[9] == decontaminate.winnow(b)[1]


def test_empty_tables_and_clashing_columns(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.find(docs.withColumn("items", docs.doc_id).withColumn("found", docs.doc_id), none)
    assert out.where("contaminated or n_hit > 0 or size(items) > 0").count() == 0 and out.count() == docs.count()
    assert decontaminate.find(empty, none).count() == 0
    clash = docs.selectExpr("doc_id as n_hit", "text", "doc_id as spans", "lang as row")
    assert decontaminate.decontaminate(clash, none).columns == clash.columns


def test_stage_drops_contaminated_only(spark, sf, docs):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = 0
    for r in docs.collect():
        n, hit, _ = plain(r.text, items)
        want += not (hit and 20 * len(hit) >= n)
    out = decontaminate.decontaminate(docs, bench)
    assert out.count() == want and out.columns == docs.columns


def test_clashing_columns_with_one_block_and_with_many(spark):
    rng = __import__("random").Random(4)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=30))) for i in range(20)]
    docs = [(i, "x " * (i % 5) + items[i % 20][1] + " y" if i % 2 else " ".join(rng.choices(words, k=40)), "s", "t", "n", 1, "r") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, spans string, items string, _n string, words int, `row` string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = [sorted(map(str, decontaminate.find(df, bench, block_bytes=b).collect())) for b in (1 << 22, 300)]
    assert found[0] == found[1] and sum("contaminated=True" in r for r in found[0]) == 30
    kept = [decontaminate.decontaminate(df, bench, block_bytes=b) for b in (1 << 22, 300)]
    assert all(k.columns == df.columns and {tuple(r)[2:] for r in k.collect()} == {("s", "t", "n", 1, "r")} and k.count() == 30 for k in kept)
