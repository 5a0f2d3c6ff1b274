import collections
import hashlib
import random
import re

import numpy as np
import pytest

from credlake.llm import blocks as bl
from credlake.llm import window_dedup as wd
from credlake.llm.op13_windows import op13_window_dedup

SCHEMA = "doc_id long, text string, id string, block int, kept string, spans int"


def plain(texts, length):
    """(words, removed spans, kept) per text."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    starts = collections.Counter(tuple(w[i:i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if starts[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        spans = [(i, next((j for j in range(i, len(w)) if not gone[j]), len(w))) for i in range(len(w)) if gone[i] and (not i or not gone[i - 1])]
        out.append((len(w), spans, " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def texts():
    rng = random.Random(5)
    pool = [" ".join(rng.choice("abcdé漢") * rng.randint(1, 2) for _ in range(rng.randint(3, 60))) for _ in range(14)]
    out = [" ".join(w for _ in range(rng.randint(1, 5)) for w in rng.choice(pool).split()[rng.randint(0, 9):][:rng.randint(1, 50)]) for _ in range(90)]
    out += ["x y  z\x85\x1c q", "a " * 300, "a b " * 100, "", None, " \t\n\x0b\x0c\r ", "one", out[3], out[3], "  " + out[4].replace(" ", "\n\t"), out[5] + " end",
            ("w" * 3000 + " ") * 2 + "v " * 20 + "w" * 3000, "w" * 2999 + "x " + "v " * 20 + "w" * 3000 + " " + "w" * 3000]
    out += [" ".join(f"u{i}-{j}" for j in range(40)) for i in range(3)]
    return out


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, "i", 1, "k", 2) for i, t in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("length,block,bucket", [(35, 1 << 20, 1 << 20), (13, 700, 400), (30, 2000, 900), (4, 900, 500)])
def test_equals_brute_force(spark, length, block, bucket):
    rows = list(enumerate(texts()))
    random.Random(1).shuffle(rows)
    found = wd.dedup(frame(spark, rows), length=length, block=block, bucket=bucket)
    assert found.columns == ["doc_id", "n_words", "spans", "kept"]
    got = {r.doc_id: r for r in found.collect()}
    want = plain([t for _, t in rows], length)
    assert any(w[1] for w in want) and len(got) == len(rows)
    for (i, _), w in zip(rows, want):
        assert (got[i].n_words, [(s.start, s.stop) for s in got[i].spans], got[i].kept.decode()) == w, i


def test_levels():
    assert wd.levels(35) == [9, 18, 35] and wd.levels(12) == [12] and wd.levels(100) == [7, 13, 25, 50, 100]
    assert all(b <= 2 * a for n in range(1, 300) for a, b in zip(wd.levels(n), wd.levels(n)[1:]))


def test_names_follow_the_words_over_steps():
    body = wd.words(("ab cd " * 90_000 + "zz " + "ab cd " * 10).encode())
    b = wd.Block(np.array([len(body)]), body)
    h = b.hashes()
    assert len(set(h[:180_000:2].tolist())) == 1 and len(set(h.tolist())) == 3
    ranks = b.ranks(h, np.arange(0, 170_000, 2), 9, 4)
    assert len(set(ranks.tolist())) == 1


def test_last_level_tells_windows_of_one_name_apart(monkeypatch):
    """With every filter name equal all windows stay candidates; the digests decide."""
    real = bl.narrow
    monkeypatch.setattr(bl, "narrow", lambda h, buckets: real(h & np.uint64(0), buckets))
    some = texts()[:30]
    b = wd.Block(np.array([len(wd.words((t or "").encode())) for t in some]), b"".join(wd.words((t or "").encode()) for t in some))
    assert len(set(b.ranks(b.hashes(), np.flatnonzero(b.left >= 9), 9, 3).tolist())) == 1
    digests = b.digests(np.flatnonzero(b.left >= 9), 9)
    distinct, parts, often, place = wd.exact_parts(digests, 3)
    assert (distinct[place] == digests).all() and parts[-1][1].stop == len(distinct)
    assert len({bytes(d) for d in digests}) == len(distinct) and often.sum() == sum(c > 1 for c in collections.Counter(map(bytes, digests)).values())


def test_hard_tables(spark):
    assert wd.dedup(frame(spark, [])).count() == 0
    rows = wd.dedup(frame(spark, [(None, None), (None, "b " * 40), (7, "c " * 34), (7, "c " * 36), (7, "c " * 36)])).collect()
    assert sorted((str(r.doc_id), r.n_words, r.kept) for r in rows) == [
        ("7", 34, b" ".join([b"c"] * 34)), ("7", 36, b""), ("7", 36, b""), ("None", 0, b""), ("None", 40, b"")]
    unlike = wd.dedup(frame(spark, [(i, " ".join(f"w{i}-{j}" for j in range(60))) for i in range(5)])).collect()
    assert all(r.n_words == 60 and not r.spans for r in unlike)  # no candidate survives the first level


def test_query(spark, sf, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = collections.Counter((i, n, sum(b - a for a, b in spans), hashlib.sha256(kept.encode()).hexdigest())
                               for (i, _), (n, spans, kept) in zip(rows, plain([t for _, t in rows], 35)))
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in op13_window_dedup(spark, sf).collect()) == want
