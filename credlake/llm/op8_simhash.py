"""Query ``op8_simhash_components``: 3-word shingles, at most 3 differing bits."""

from __future__ import annotations

from pyspark.sql import functions as F

from credlake.llm.common import table
from credlake.llm.simhash import near_duplicates

SHINGLE, MAX_BITS = 3, 3


def op8_simhash_components(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", SHINGLE, MAX_BITS)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
