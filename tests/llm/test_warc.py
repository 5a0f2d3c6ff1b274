import base64
import gzip
import hashlib
import os

import duckdb
import pytest

from credlake.llm import warc
from credlake.llm.op4_warc import ORACLE, op4_warc_round_trip


def test_url_keys():
    assert warc.url_key("HTTP://www.Example.COM:8080/A/b?q=1#f") == "com,example,www:8080)/A/b?q=1"
    assert warc.url_key("https://example.com") == "com,example)/"
    assert [warc.url_key(u) for u in (None, "", "nonsense", "http://[bad")] == ["", "", "nonsense", "http://[bad"]


def test_payloads_are_measured_not_believed():
    raw = warc.record(7, "http://a.example.com/", b"payload", None, False)
    found = warc.parsed(raw)
    assert (found["payload_bytes"], found["payload_digest"], found["payload"]) == (7, warc.base32_sha1(b"payload"), b"payload")
    for damaged in (raw.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"), raw[:-len(b"payload\r\n\r\n")]):
        assert damaged != raw
        with pytest.raises(ValueError, match="urn:page:7"):
            warc.parsed(damaged)
    again = warc.parsed(warc.record(8, "http://b.example.com/", b"payload", 7, True))
    assert (again["payload_bytes"], again["payload_digest"], again["payload"]) == (7, warc.base32_sha1(b"payload"), None)


def test_query_equals_sql(spark, sf):
    got = sorted(tuple(r) for r in op4_warc_round_trip(spark, sf).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").fillna(-1).collect())
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{sf}/pages.parquet/*.parquet')")
    want = sorted(tuple(-1 if x is None else x for x in r) for r in con.execute(ORACLE).fetchall())
    assert got == want and len(got) == 7


def test_archive_is_plain_gzip_warc(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    folder = warc.write(pages)
    root = folder.removeprefix("file:")
    raw = b"".join(gzip.open(f"{root}/{n}").read() for n in sorted(os.listdir(root)) if n.endswith(".warc.gz"))
    assert raw.count(b"WARC/1.1\r\n") == 7 and b"two\r\n\r\nparts" in raw
    assert not [n for n in os.listdir(root) if n.count(".") > 2 and "warc" in n and not n.endswith(".gz")]


def test_lookup_across_blocks_and_files(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 4)
    rows = [(i, f"http://h{i % 5}.example.com/p/{i % 40}", f"body {i % 60}" * (i % 7)) for i in range(400)] + [(3, "http://hot.example.com/", "x")] * 3
    rows += [(1000 + i, "http://hot.example.com/", f"n{i}") for i in range(150)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    folder = warc.write(pages)
    first = {}
    for i, _, h in rows:
        first[h] = min(i, first.get(h, i))
    found = warc.lookup(spark, folder, pages.select("url", "page_id")).collect()
    assert sorted((r.page_id, r.url) for r in found) == sorted((i, u) for i, u, _ in rows)
    for r in found:
        bodies = [h for i, u, h in rows if (i, u) == (r.page_id, r.url)]
        assert r.payload_digest in {base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() for h in bodies}
        if r.record_type == "response":
            assert bytes(r.payload).decode() in bodies and first[bytes(r.payload).decode()] == r.page_id
        else:
            assert r.refers_to < r.page_id and r.payload is None
    urls = spark.createDataFrame([("https://HOT.example.com/#x",), ("http://h1.example.com/p/1",), ("http://none.example.com/",)], "url string")
    by_url = warc.lookup(spark, folder, urls).collect()
    want = [i for i, u, _ in rows if warc.url_key(u) in ("com,example,hot)/", "com,example,h1)/p/1")]
    assert sorted(r.page_id for r in by_url) == sorted(want)


def test_min_bytes_nulls_and_empty_table(spark):
    pages = spark.createDataFrame([(None, "u", "same text"), (2, None, "same text"), (3, "v", "ab"), (4, "v", "ab"), (5, "w", None), (6, "w", "")],
                                  "page_id long, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc.lookup(spark, warc.write(pages, min_bytes=5), pages.select("url", "page_id")).collect()}
    assert got == {None: ("revisit", 2, 9), 2: ("response", None, 9), 3: ("response", None, 2), 4: ("response", None, 2), 5: ("response", None, 0),
                   6: ("response", None, 0)}
    none = pages.limit(0)
    assert warc.lookup(spark, warc.write(none), none.select("url", "page_id")).count() == 0
