"""Query ``op3_pu_classifier``."""

from __future__ import annotations

from pyspark.sql import functions as F

from credlake.llm.common import table
from credlake.llm.pu import score

THRESHOLD = 0.3


def op3_pu_classifier(spark, sf_dir):
    found = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "quality", "text")
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
