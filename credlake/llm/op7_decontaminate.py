"""Query ``op7_winnowing``."""

from __future__ import annotations

from pyspark.sql import functions as F

from credlake.llm.common import table
from credlake.llm.decontaminate import find


def op7_winnowing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.sort_array("items"), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
with w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
k as (select item_id, w, least(13, len(w)) as size from b where len(w) > 0),
windows as (select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as words
            from (select *, unnest(range(1, len(w) - size + 2)) as i from k)),
sizes as (select distinct size from windows),
spans as (select doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') as words
          from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from w, sizes where len(w) >= size)),
hits as (select doc_id, i, s.size, item_id from spans s join windows v on s.size = v.size and s.words = v.words),
covered as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + size)) as p from hits) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
          from (select distinct doc_id, item_id::varchar as id from hits) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from w left join covered using (doc_id) left join named using (doc_id)
"""
