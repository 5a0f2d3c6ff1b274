"""Query ``op10_pii_surrogates``."""

from __future__ import annotations

from credlake.llm.common import table
from credlake.llm.pii import replace

KEY = "op10-surrogates"  # a deployment passes its own secret


def op10_pii_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace(docs, "text", KEY, "n_entities")
