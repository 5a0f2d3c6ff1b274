"""Query ``op12_merkle_manifest``: leaves of whole documents, one tree per lang, one over the langs."""

from __future__ import annotations

from pyspark.sql import functions as F

from credlake.llm.common import table
from credlake.llm.merkle import fold, leaf_of, manifest, proof_digest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle_manifest(spark, sf_dir):
    longer = {c: F.col(c) for c in COLUMNS} | {"n_chars": F.coalesce(F.expr("try_add(n_chars, 1)"), F.col("n_chars"))}
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = F.when(chosen, leaf_of(*longer.values()))
    found = manifest(table(spark, sf_dir, "documents"), "doc_id", "lang", COLUMNS, {"tampered": tampered})
    folded = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                          fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field(c: str) -> str:
    return f"coalesce(octet_length(encode(({c})::varchar))::varchar || ':' || ({c})::varchar, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(n_chars if c == "n_chars" else c) for c in COLUMNS) + ")"


def _tree(name: str, leaves: str) -> str:
    """Nodes (g, level, i, hash, n) over leaves (g, i, hash)."""
    return f"""
{name} as (
  select g, 0 as level, i::bigint as i, hash, count(*) over (partition by g) as n from {leaves}
  union all
  select g, level + 1, i // 2, sha256(string_agg(hash, '' order by i)), (n + 1) // 2 from {name} where n > 1 group by g, level, i // 2, n)"""


def _climb(name: str, start: str, tree: str) -> str:
    """Rows (rid, g, level, i, h, proof) from their start to the top of a tree."""
    return f"""
{name} as (
  select rid, g, 0 as level, i::bigint as i, h, proof from {start}
  union all
  select f.rid, f.g, f.level + 1, f.i // 2, sha256(case when f.i % 2 = 0 then f.h || coalesce(s.hash, '') else s.hash || f.h end), f.proof || coalesce(s.hash, '')
  from {name} f join {tree} me on me.g = f.g and me.level = f.level and me.i = f.i and me.n > 1
  left join {tree} s on s.g = f.g and s.level = f.level and s.i = xor(f.i, 1::bigint))"""


# CRC-32 by its 256-entry table, one byte at a time (DuckDB has no crc32).
ORACLE = f"""
with recursive steps(v, c, k) as (
  select v, v, 0 from range(256) t(v)
  union all select v, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, k + 1 from steps where k < 8),
crc as (select list(c order by v) as t from steps where k = 8),
x as (select *, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda d: ascii(d)::bigint)),
        lambda c, v: xor(c // 256, t[xor(c % 256, v) + 1]::bigint)), 4294967295::bigint) as code from documents, crc),
l as materialized (select row_number() over () as rid, doc_id, coalesce('=' || lang, '-') as g, {_leaf("n_chars")} as hash,
        case when code % 7 = 0 then {_leaf("n_chars + 1")} end as tampered from x),
r as materialized (select *, row_number() over (partition by g order by doc_id nulls first, hash) - 1 as i from l),
{_tree("t", "r")},
s as materialized (select g, hash from t where n = 1),
u as materialized (select '' as g, g as name, hash, row_number() over (order by encode(g)) - 1 as i from s),
{_tree("top", "u")},
b as (select rid, g, i, coalesce(tampered, hash) as h, '' as proof from r),
{_climb("f", "b", "t")},
c as (select f.rid, '' as g, u.i, f.h, f.proof from f join t on t.g = f.g and t.level = f.level and t.i = f.i and t.n = 1 join u on u.name = f.g),
{_climb("e", "c", "top")}
select r.doc_id, r.hash as leaf, s.hash as subroot, z.hash as root, sha256(e.proof) as proof_sha256, e.h as folded_root, e.h = z.hash as verified
from e join top z on z.level = e.level and z.i = e.i and z.n = 1 join r using (rid) join s on s.g = r.g
"""
