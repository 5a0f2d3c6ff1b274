"""Query ``op6_rendezvous_shards``: 24 equal shards by the ``key`` law."""

from __future__ import annotations

from pyspark.sql import functions as F

from credlake.llm.common import table
from credlake.llm.sharding import assign, with_slots

SHARDS = 24


def op6_rendezvous_shards(spark, sf_dir):
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"))
    placed = assign(rows, "doc_id", [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return with_slots(placed, "shard", ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _best(shards: int) -> str:
    return ("select arg_max(s, -1.0 / ln((('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':' || s), 1, 13))::bigint::double"
            f" + 0.5) / 4503599627370496.0)) from range({shards}) t(s)")


# CRC-32 by its 256-entry table, one byte at a time (DuckDB has no crc32).
ORACLE = f"""
with recursive steps(i, c, k) as (
  select i, i, 0 from range(256) t(i)
  union all select i, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, k + 1 from steps where k < 8),
crc as (select list(c order by i) as t from steps where k = 8),
d as (select doc_id, coalesce(text, '') as body from documents),
b as (select doc_id, octet_length(encode(body)) + 8 as size, hex(encode(body)) as h from d),
x as (select doc_id, size, list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(h) // 2),
        lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)), lambda c, v: xor(c // 256, t[xor(c % 256, v) + 1]::bigint)) as c
      from b, crc)
select doc_id, size::bigint as size, xor(c, 4294967295::bigint) as text_crc32, 'key' as law, shard,
       row_number() over (partition by shard order by doc_id) - 1 as slot, grown_shard
from (select *, ({_best(SHARDS)})::int as shard, ({_best(SHARDS + 1)})::int as grown_shard from x)
"""
