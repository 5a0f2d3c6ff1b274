import collections
import math
import random
import re

import duckdb
import pytest
from fixtures import words
from pyspark.sql import functions as F
from test_simhash import plain_components, plain_print
from xxhash import xxh3_64_intdigest

from credlake.llm import quality
from credlake.llm.op2_quality import ORACLE, op2_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n


def norm(line):
    return " ".join("".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(line))


def verdicts(rows, min_docs, max_share, min_kept):
    """Plain version of the line rule: (removed words, kept) per row of (host, text)."""
    hashes = lambda l: xxh3_64_intdigest(l.encode()) - (1 << 63)
    lines = [[norm(x) for x in (t or "").split("\n") if norm(x)] for _, t in rows]
    count, hosts = collections.defaultdict(set), collections.defaultdict(set)
    for (host, _), found in zip(rows, lines):
        size = collections.Counter()
        for x in found:
            size[hashes(x)] += len(x.split(" "))
        ordered = sorted(size, key=lambda h: (-math.log((h + 2 ** 63 + 1) / 2 ** 64) / size[h], h))
        if ordered:
            hosts[host or ""].add(ordered[0])
        for h in ordered:
            rest = [x for x in ordered[:2] if x != h]
            count[host or "", h].add(rest[0] if rest else None)
    out = []
    for (host, text), found in zip(rows, lines):
        gone = sum(len(x.split(" ")) for x in found
                   if len(count[host or "", hashes(x)]) >= max(min_docs, max_share * len(hosts[host or ""])))
        n, *_, failed = base(text)
        out.append((gone, not failed and n - gone >= min_kept * n))
    return out


def plain_texts(rows, min_docs, max_share, min_kept):
    """The line rule with distinct texts counted: (removed words, kept) per row of (host, text)."""
    lines = [[norm(x) for x in (t or "").split("\n") if norm(x)] for _, t in rows]
    count, hosts = collections.defaultdict(set), collections.defaultdict(set)
    for (host, text), found in zip(rows, lines):
        if found:
            hosts[host or ""].add(text)
        for x in found:
            count[host or "", x].add(text)
    out = []
    for (host, text), found in zip(rows, lines):
        limit = max(min_docs, max_share * len(hosts[host or ""]))
        gone = sum(len(x.split(" ")) for x in found if len(count[host or "", x]) >= limit)
        n, *_, failed = base(text)
        out.append((gone, not failed and n - gone >= min_kept * n))
    return out


def test_query_equals_plain_version(spark, sf, docs):
    got = sorted(tuple(-1 if x is None else x for x in r) for r in op2_quality_rules(spark, sf).select(
        "doc_id", *quality.MEASURES, "base_failed", "kept", "removed_words").collect())
    rows = docs.collect()
    want = [(-1 if r.doc_id is None else r.doc_id, *base(r.text), kept, gone)
            for r, (gone, kept) in zip(rows, plain_texts([(r.source, r.text) for r in rows], 10, 0.02, 0.5))]
    assert got == sorted(want)


def nearly_equal(spark):
    """200 pages of one host that differ in a word or two, 60 copies of one text, and 40 pages of their own."""
    rng = random.Random(5)
    shared = "\n".join(words(rng, 29) for _ in range(6))
    rows = [(i, f"{shared}\nown {words(rng, 1 + i % 2, 10 ** 6)}", "h") for i in range(200)]
    rows += [(1000 + i, words(random.Random(9), 80), "h") for i in range(60)]
    rows += [(2000 + i, words(rng, 80, 10 ** 6), "h") for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_unit_of_counting(spark):
    pages = nearly_equal(spark)
    rows = pages.collect()
    texts = {r.doc_id: (r.removed_words, r.kept) for r in quality.judge(pages, unit="texts").collect()}
    assert [texts[r.doc_id] for r in rows] == plain_texts([(r.source, r.text) for r in rows], 10, 0.02, 0.5)
    assert all(texts[i] == (174, False) for i in range(200)) and all(texts[1000 + i] == (0, True) for i in range(60))
    classes = {r.doc_id: (r.removed_words, r.kept) for r in quality.judge(pages).collect()}
    assert [classes[r.doc_id] for r in rows] == plain_counts([(r.source, r.text) for r in rows], 10, 0.02, 0.5)
    with pytest.raises(ValueError, match="unit"):
        quality.judge(pages, unit="pages")


def test_query_equals_sql(spark, sf, docs, tmp_path):
    nearly_equal(spark).select("doc_id", "text", F.lit("en").alias("lang"), "source", F.lit(1).cast("long").alias("n_chars")) \
        .unionByName(docs).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = op2_quality_rules(spark, str(tmp_path))
    want = con.execute(ORACLE).fetchall()
    plain = lambda rows: sorted(tuple(-1 if x is None else x for x in r) for r in rows)
    assert got.columns == [c[0] for c in con.description]
    assert plain(got.collect()) == plain(want)


FOOTER = [f"foot {c} line {c * 2} of {c * 3}" for c in "abc"]


def hosts(spark):
    body = lambda i: "\n".join(f"{k} own text {i} {k} number {k} with {i} more {k} words" for k in range(8))
    rows = [(i, "FOOT  a line AA of aaa\n" + body(i) + "\n" + "\n".join(FOOTER), "a") for i in range(30)]
    rows += [(100 + i, "\n".join(FOOTER) + f"\nonly this here is really new {i}", "a") for i in range(5)]
    rows += [(200 + i, body(999) + "\nan end that all copies have in common", "b") for i in range(40)]  # copies of one text
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_frequent_lines_go_and_depleted_documents_are_rejected(spark):
    out = {r.doc_id: r for r in quality.judge(hosts(spark), max_share=0.2).collect()}
    assert not any(r.base_failed for r in out.values())
    assert all(out[i].kept and out[i].removed_words == 24 for i in range(30))
    assert not any(out[100 + i].kept for i in range(5))
    assert all(out[200 + i].kept and out[200 + i].removed_words == 0 for i in range(40))
    cleaned = {r.doc_id: r.text for r in quality.clean(hosts(spark), max_share=0.2).collect()}
    assert set(cleaned) == {*range(30), *range(200, 240)}
    assert "foot" not in cleaned[3].lower() and cleaned[3].count("\n") == 7
    want = {r.doc_id: r.text for r in hosts(spark).collect()}
    assert cleaned[200] == want[200]


def test_equals_plain_version_at_other_limits(spark):
    rows = hosts(spark).collect()
    want = verdicts([(r.source, r.text) for r in rows], 3, 0.05, 0.7)
    got = {r.doc_id: (r.removed_words, r.kept) for r in quality.judge(hosts(spark), min_docs=3, max_share=0.05, min_kept=0.7).collect()}
    assert [got[r.doc_id] for r in rows] == want


def test_empty_table_and_clashing_columns(docs, empty):
    assert quality.judge(empty).count() == 0
    assert quality.clean(empty).columns == empty.columns
    clash = docs.selectExpr("doc_id as kept", "text", "source", "lang as n_words", "n_chars as row", "n_chars as found", "lang as hash")
    out = quality.judge(clash)
    assert dict(out.dtypes)["kept"] == "boolean" and out.count() == docs.count()
    assert quality.clean(clash).columns == clash.columns


def plain_counts(rows, min_docs, max_share, min_kept):
    """The line rule with documents counted as near-duplicate classes, pair by pair: (removed words, kept) per (host, text)."""
    prints = [(i, plain_print(t)) for i, (_, t) in enumerate(rows)]
    classes = plain_components(prints)
    lines = [[norm(x) for x in (t or "").split("\n") if norm(x)] for _, t in rows]
    count, hosts = collections.defaultdict(set), collections.defaultdict(set)
    for (host, _), found, c in zip(rows, lines, classes):
        if found:
            hosts[host or ""].add(c)
        for x in found:
            count[host or "", x].add(c)
    out = []
    for (host, text), found in zip(rows, lines):
        limit = max(min_docs, max_share * len(hosts[host or ""]))
        gone = sum(len(x.split(" ")) for x in found if len(count[host or "", x]) >= limit)
        n, *_, failed = base(text)
        out.append((gone, not failed and n - gone >= min_kept * n))
    return out


def mostly_boilerplate(rng):
    """30 pages of three shared lines (48 words) and 12 own words, amid 100 other documents of the host."""
    shared = "\n".join(words(rng, 16) for _ in range(3))
    rows = [(i, "\n".join((shared, words(rng, 12, 10 ** 6))), "h") for i in range(30)]
    return rows + [(100 + i, words(rng, 50, 10 ** 6) + "\n" + words(rng, 30, 10 ** 6), "h") for i in range(100)]


def test_pages_that_are_mostly_boilerplate_are_depleted(spark):
    """Whatever the hashes of the shared lines are, and counted without any sketch."""
    rows = [(1000 * k + i, t, f"{h}{k}") for k in range(8) for i, t, h in mostly_boilerplate(random.Random(k))]
    got = {r.doc_id: (r.removed_words, r.kept) for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    want = plain_counts([(h, t) for _, t, h in rows], 10, 0.02, 0.5)
    assert [got[i] for i, _, _ in rows] == want
    assert all(got[i] == ((48, False) if i % 1000 < 100 else (0, True)) for i, _, _ in rows)
