import itertools
import random
import re

from xxhash import xxh64_intdigest

from credlake.llm import simhash
from credlake.llm.components import components
from credlake.llm.op8_simhash import op8_simhash_components


def plain_print(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    h = [xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, bits=3):
    """rows: (id, print) -> list of the smallest non-null id reachable."""
    prints = sorted({p for _, p in rows})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    for a, b in itertools.combinations(prints, 2):
        if bin(a ^ b).count("1") <= bits:
            root[find(a)] = find(b)
    least = {}
    for i, p in rows:
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    return [least.get(find(p)) for _, p in rows]


def test_position_sets_meet_every_five():
    sets = [set(s) for s in simhash.position_sets()]
    assert len(sets) == 14 and all(len(s) == 4 for s in sets)
    for five in itertools.combinations(range(8), 5):
        assert any(s <= set(five) for s in sets)


def test_fingerprints():
    for text in ("", " \n", "A", "a b", "One two THREE four", "x y z " * 50, "é É ß 漢字\x0b\x1c w"):
        assert simhash.fingerprint_of(text.encode()) == plain_print(text), text
    long = " ".join(str(i % 977) for i in range(40000))
    assert simhash.fingerprint_of(long.encode()) == plain_print(long)


def test_query_equals_brute_force(spark, sf, docs):
    rows = [(r.doc_id, plain_print(r.text)) for r in docs.collect()]
    want = sorted((-1 if i is None else i, f"{p:016x}", c) for (i, p), c in zip(rows, plain_components(rows)))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, r.component_id) for r in op8_simhash_components(spark, sf).collect())
    assert got == want


def test_links_connect_what_brute_force_connects(spark, monkeypatch):
    rng = random.Random(4)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    points = set(seeds)
    for s in seeds[:25]:  # clouds around a point and chains away from it
        for _ in range(30):
            s2 = s
            for b in rng.sample(range(64), rng.randint(1, 4)):
                s2 ^= 1 << b
            points.add(s2)
            s = s2 if rng.random() < 0.3 else s
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in points]
    found = components(simhash.links(spark.createDataFrame(signed, "fp long"))).collect()
    root = {r.node & (1 << 64) - 1: r.root for r in found}
    want = plain_components([(i, p) for i, p in enumerate(sorted(points))])
    groups = {}
    for p, c in zip(sorted(points), want):
        groups.setdefault(c, set()).add(root.get(p, ("alone", p)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_wide_lists_are_searched_exactly(monkeypatch):
    import numpy as np
    rng = random.Random(9)
    base = rng.getrandbits(64)
    points = sorted({base ^ sum(1 << b for b in rng.sample(range(32), rng.randint(0, 6))) for _ in range(300)})
    array = np.array(points, np.uint64)
    whole = simhash.list_links(array, 3)
    monkeypatch.setattr(simhash, "WIDE", 10)
    split = simhash.list_links(array, 3)

    def classes(edges):
        root = {p: p for p in points}

        def find(p):
            while root[p] != p:
                p = root[p]
            return p
        for a, b in edges:
            root[find(a)] = find(b)
        return [find(p) == find(q) for p, q in itertools.combinations(points, 2)]
    assert classes(whole) == classes(split)
    assert len(whole) < len(points)


def test_wide_lists_with_further_constant_bytes_are_searched_exactly(monkeypatch):
    import numpy as np
    monkeypatch.setattr(simhash, "WIDE", 10)
    rng = random.Random(10)
    base = rng.getrandbits(64)
    for free in (24, 16, 8, 2):  # a fifth, sixth, ... byte is constant
        points = set()
        while len(points) < min(200, 1 << free):
            p = base ^ rng.getrandbits(free)
            # one bit in each of the last three bytes, so the pair shares five bytes only
            points |= {p, p ^ sum(1 << 8 * byte + rng.randrange(8) for byte in range(3) if 8 * byte + 8 <= free)}
        rows = [(i, p) for i, p in enumerate(sorted(points))]
        root = {p: p for p in points}

        def find(p):
            while root[p] != p:
                p = root[p]
            return p
        for a, b in simhash.list_links(np.array(sorted(points), np.uint64), 3):
            assert bin(a ^ b).count("1") <= 3
            root[find(a)] = find(b)
        want = plain_components(rows)
        assert [find(p) == find(q) for (_, p), (_, q) in itertools.combinations(rows, 2)] == [a == b for a, b in itertools.combinations(want, 2)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (500, 400), (400, 300), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 500: 300, 400: 300, 300: 300}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_one(spark, docs, empty):
    rows = [(r.doc_id, plain_print(r.text)) for r in docs.collect()]
    want = sorted({c for c in plain_components(rows) if c is not None})
    got = simhash.keep_one(docs).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == want
    nameless = [(None, "only here at all"), (None, "only here at all"), (1, "something else entirely new")]
    kept = simhash.keep_one(spark.createDataFrame(nameless, "doc_id long, text string").selectExpr("doc_id", "text", "1 as fp", "2 as component_id"))
    assert kept.columns == ["doc_id", "text", "fp", "component_id"] and kept.count() == 2
    assert simhash.keep_one(empty).count() == 0


def test_rows_that_share_a_key_are_documents_of_their_own(spark):
    from credlake.llm.simhash import keep_one
    texts = ["alpha beta gamma delta epsilon zeta", "one two three four five six seven", "ten green bottles standing on the wall"]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (3, texts[0]), (None, texts[1]), (None, "lone words without any key here"), (1, texts[0])]
    df = spark.createDataFrame([(*r, "a", 4, 5) for r in rows], "doc_id long, text string, best string, root int, fp int")
    for parts in (1, 3):
        got = sorted(((str(r.doc_id), r.text) for r in keep_one(df.repartition(parts)).collect()))
        assert got == sorted([("1", texts[0]), ("1", texts[1]), ("2", texts[2]), ("None", "lone words without any key here")])
