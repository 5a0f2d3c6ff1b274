"""Query ``op13_window_dedup``: windows of 35 words that start more than once."""

from __future__ import annotations

from pyspark.sql import functions as F

from credlake.llm.common import table
from credlake.llm.window_dedup import dedup

LENGTH = 35


def op13_window_dedup(spark, sf_dir):
    found = dedup(table(spark, sf_dir, "documents"), "doc_id", "text", LENGTH)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"), F.size("spans").cast("long").alias("n_spans"))


# Every window is one row of up to a quarter of a kilobyte; small tables only.
ORACLE = rf"""
with w as materialized (
  select row_number() over () as rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as t from documents),
s as (select rid, unnest(range(1, len(t) - {LENGTH - 2})) as i, t from w where len(t) >= {LENGTH}),
h as materialized (select rid, i, sha256(array_to_string(t[i:i + {LENGTH - 1}], ' ')) as h from s),
m as (select rid, i from h qualify count(*) over (partition by h) > 1),
g as (select rid, list(i order by i) as starts from m group by rid),
c as (select rid, list(distinct p) as gone from (select rid, unnest(range(i, i + {LENGTH})) as p from m) group by rid),
k as (select w.rid, w.doc_id, w.t, coalesce(c.gone, []) as gone, coalesce(g.starts, []) as starts from w left join c using (rid) left join g using (rid))
select doc_id, len(t) as n_words, len(gone) as n_removed,
  sha256(array_to_string(list_filter(t, lambda x, i: not list_contains(gone, i)), ' ')) as kept_sha256,
  len(list_filter(starts, lambda x, i: i = 1 or x > starts[i - 1] + {LENGTH})) as n_spans
from k
"""
