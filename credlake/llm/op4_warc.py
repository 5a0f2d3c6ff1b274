"""Query ``op4_warc_round_trip``: write ``pages`` as an archive, look every capture up through the index."""

from __future__ import annotations

from credlake.llm.common import table
from credlake.llm.warc import lookup, write


def op4_warc_round_trip(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    folder = write(pages, min_bytes=0)
    found = lookup(spark, folder, pages.select("url", "page_id"), with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
h as (select page_id, octet_length(body) as size, sha1(body) as sha, min(page_id) over (partition by body) as first from p)
select page_id, size::bigint as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(sha, 5 * (i // 4) + 1, 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int + 1, 1)), '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from h
"""
