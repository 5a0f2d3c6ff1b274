"""Query ``op2_quality_rules`` and its oracle."""

from __future__ import annotations

from credlake.llm.common import table
from credlake.llm.quality import MEASURES, judge

WORD = r"[^\x20\x09-\x0D]+"


def op2_quality_rules(spark, sf_dir):
    found = judge(table(spark, sf_dir, "documents"), "source", "text", carry=["doc_id"], unit="texts")
    return found.select("doc_id", *MEASURES, "base_failed", "kept", "removed_words")


# A line counts once per distinct text of its host.
ORACLE = rf"""
with docs as (
  select row_number() over () as rid, doc_id, coalesce(source, '') as host, coalesce(text, '') as text from documents
), words as (
  select rid, w, generate_subscripts(w, 1) as i from (
    select rid, regexp_extract_all(text, '{WORD}') as w from docs)
), windows as (
  select rid, i, array_to_string(w[i:i + 7], ' ') as shingle from words where i + 7 <= len(w)
), twins as (
  select rid, i from windows qualify count(*) over (partition by rid, shingle) > 1
), repeated as (
  select rid, count(distinct i + k) as n from twins cross join range(8) as offsets(k) group by rid
), lines as (
  select rid, host, text, unnest(string_split(text, chr(10))) as line from docs
), worded as (
  select rid, host, text, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w
  from lines where regexp_matches(line, '{WORD}')
), dups as (
  select rid, cast(sum(n - 1) as bigint) as n from (select rid, line, count(*) as n from worded group by rid, line) group by rid
), sized as (
  select rid, host, text, array_to_string(w, ' ') as line, sum(len(w)) as words from worded group by all
), limits as (
  select host, line from (select host, line, count(distinct text) as docs from sized group by host, line) l
  join (select host, count(distinct text) as texts from sized group by host) h using (host)
  where docs >= 10 and docs >= 0.02e0 * texts
), removed as (
  select rid, cast(sum(words) as bigint) as n from sized join limits using (host, line) group by rid
), measured as (
  select doc_id, cast(len(regexp_extract_all(text, '{WORD}')) as bigint) as n_words,
    cast(length(array_to_string(regexp_extract_all(text, '{WORD}'), '')) as bigint) as word_chars,
    cast(length(text) - length(translate(text, '#*$%&|<>', '')) as bigint) as n_symbols,
    coalesce(dups.n, 0) as n_dup_lines, coalesce(repeated.n, 0) as n_repeat_words, coalesce(removed.n, 0) as removed_words
  from docs left join dups using (rid) left join repeated using (rid) left join removed using (rid)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and n_words - removed_words >= 0.5e0 * n_words as kept, removed_words
from measured"""
