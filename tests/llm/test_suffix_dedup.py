import hashlib
import random

import numpy as np

from credlake.llm import suffix_dedup as sd
from credlake.llm.op5_suffix_dedup import op5_suffix_dedup


def plain(bodies):
    """(removed spans, kept) per body, in order."""
    seen, out = set(), []
    for b in bodies:
        gone = bytearray(len(b))
        for p in range(len(b) - sd.LENGTH + 1):
            w = b[p:p + sd.LENGTH]
            if w in seen:
                gone[p:p + sd.LENGTH] = b"\1" * sd.LENGTH
            seen.add(w)
        spans = [(i, next((j for j in range(i, len(b)) if not gone[j]), len(b))) for i in range(len(b)) if gone[i] and (not i or not gone[i - 1])]
        out.append((spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def test_cover_and_names():
    assert {(a - b) % sd.PERIOD for a in sd.COVER for b in sd.COVER} == set(range(sd.PERIOD))
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 700_000, dtype=np.uint8)
    data[600_000:600_300] = data[100:400]
    places = np.array([100, 101, 262_143, 262_144, 600_000, 600_001, 699_900])
    h = sd.names(2, sd.LENGTH).at(data, places)
    assert h[0] == h[4] and h[1] == h[5] and len(set(h.tolist())) == 5


def test_query_equals_brute_force(spark, sf, docs):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    unique = sorted((r for r in rows if r[0] is not None and [x[0] for x in rows].count(r[0]) == 1))
    got = {r.doc_id: r for r in op5_suffix_dedup(spark, sf).collect()}
    assert sum(1 for _ in op5_suffix_dedup(spark, sf).collect()) == len(rows)
    # Rows without a key come first; rows of one key (0 here) are equal texts, so their order does not matter.
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = dict(zip([r[0] for r in ordered], plain([b for _, b in ordered])))
    for key, body in unique:
        spans, kept = want[key]
        assert (got[key].n_bytes, got[key].n_removed, got[key].n_spans, got[key].kept_sha256) == (
            len(body), len(body) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()), key


def test_small_blocks_and_buckets(spark):
    rng = random.Random(8)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randint(60, 400))) for _ in range(12)]
    texts = ["".join(rng.choice(pool)[rng.randint(0, 50):][:rng.randint(40, 390)] for _ in range(rng.randint(1, 5))) for _ in range(150)]
    texts += ["ab" * 300, "a" * 99, "a" * 100, "a" * 101, "a" * 350, texts[3], texts[3], "", None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, block long, id string").repartition(4)
    want = plain([(t or "").encode() for t in texts])
    for block, bucket in ((3000, 2000), (1 << 20, 1 << 20)):
        got = {r.doc_id: r for r in sd.dedup(df, block=block, bucket=bucket).collect()}
        for i, (spans, kept) in enumerate(want):
            assert ([(s.start, s.stop) for s in got[i].spans], bytes(got[i].kept)) == (spans, kept), i


def test_empty_and_nulls_only(spark, empty):
    assert sd.dedup(empty).count() == 0
    rows = sd.dedup(spark.createDataFrame([(None, None), (None, "b" * 300), (None, "b" * 300)], "doc_id long, text string")).collect()
    assert sorted((r.n_bytes, len(r.kept)) for r in rows) == [(0, 0), (300, 0), (300, 1)]  # a run's second string starts at its second byte


def test_strings_of_one_name_are_told_apart_by_their_bytes(spark, monkeypatch):
    rng = random.Random(2)
    text = bytes(rng.choice(b"ab") for _ in range(900)) + b"c" * 300
    places = np.arange(len(text) - sd.LENGTH + 1)
    seen, want = set(), []
    for p in places:
        want.append(text[p:p + sd.LENGTH] in seen)
        seen.add(text[p:p + sd.LENGTH])
    for names in (np.zeros(len(places), np.uint64), sd.names(2, sd.LENGTH).at(np.frombuffer(text, np.uint8), places) & np.uint64(0xFF)):
        assert (sd.repeated(names, text, places) == np.array(want)).all()
    same = "x" * 60 + "q" * 120
    bodies = [same, "y" * 60 + "r" * 120, same[:170]]
    bucket = b"".join(sd.struct.pack("<qq", 1, len(b)) + b.encode() for b in bodies[:1])
    others = [sd.struct.pack("<qq", 1, len(b)) + b.encode() for b in bodies[1:]]
    monkeypatch.setattr(sd.Depth, "at", lambda self, data, at: np.zeros(len(at), np.uint64))  # every name the same
    said = sd.first_places([(0, bucket), (1, others[0]), (2, others[1])])
    own = np.unpackbits(np.frombuffer(said[1], np.uint8), count=81)
    assert own[:61].sum() == 0 and own[61:].all()  # its runs of one letter start again within itself
    assert np.unpackbits(np.frombuffer(said[2], np.uint8), count=71).all()


def test_stretches_hold_every_suffix_once():
    rng = random.Random(6)
    body = bytes(rng.choice(b"abcd ") for _ in range(6000)) + b"z" * 3000
    b = sd.Block(np.array([6000, 3000]), body, np.array([False, False]))
    places = np.array([p for p in range(9000 - sd.LENGTH + 1) if not 5901 <= p < 6000 and p % 700 > 30])
    first, counts, which, home, texts = b.stretches(places, 7)
    assert np.concatenate([np.arange(p, p + c) for p, c in zip(first, counts)]).tolist() == places.tolist()
    assert all(texts[w] == body[p:p + c + sd.LENGTH - 1] for p, c, w in zip(first, counts, which))
    assert len(set(texts)) == len(texts) and counts.max() <= sd.STRETCH and len(set(which[-9:])) < 9
    by = {}
    for p, c, w in zip(first, counts, which):
        for q in range(p, p + c):  # equal strings must meet in one bucket
            assert by.setdefault(body[q:q + sd.LENGTH], home[w]) == home[w]


def test_clashing_columns_and_a_long_text(spark):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdef ") for _ in range(130))
    long = "".join(rng.choice("ghijkl ") for _ in range(300_000)) + passage
    rows = [(1, passage, 1, 2, "b", [1]), (2, long, 1, 2, "b", [1]), (3, long[:250_000], 1, 2, "b", [1])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int, sizes int, body string, spans array<int>")
    got = {r.doc_id: ([(s.start, s.stop) for s in r.spans], len(r.kept)) for r in sd.dedup(df, block=100_000).collect()}
    assert got == {1: ([], 130), 2: ([(300_000, 300_130)], 300_000), 3: ([(0, 250_000)], 0)}
