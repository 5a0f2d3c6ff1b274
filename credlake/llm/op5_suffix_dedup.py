"""Query ``op5_suffix_dedup``."""

from __future__ import annotations

from pyspark.sql import functions as F

from credlake.llm.common import table
from credlake.llm.suffix_dedup import dedup


def op5_suffix_dedup(spark, sf_dir):
    found = dedup(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
