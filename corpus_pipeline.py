"""The training-data pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all the rows its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from credlake.llm import bpe, decontaminate, pii, quality, simhash
from credlake.llm.common import stored, table
from credlake.llm.op1_bpe import PATTERN, RANKS, digests
from credlake.llm.op10_pii import KEY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _sized(docs):
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def quality_stage(spark, docs, sf_dir):
    """Rejected documents go; lines above their host's limit go from the rest."""
    return _sized(quality.clean(docs, "source", "text"))


def near_duplicate_stage(spark, docs, sf_dir):
    """Of every SimHash component the document with the smallest doc_id stays."""
    return simhash.keep_one(docs, "doc_id", "text", k=3, max_bits=3).select(COLUMNS)


def decontamination_stage(spark, docs, sf_dir):
    """Documents contaminated by ``benchmark`` go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), "text").select(COLUMNS)


def surrogate_stage(spark, docs, sf_dir):
    """Personal data is replaced by surrogates."""
    return _sized(pii.replace(docs, "text", KEY))


def encoding_stage(spark, docs, sf_dir):
    """Every text's packed ids with the digests of the ids and of the bytes decoded from them."""
    coded = docs.select("doc_id", bpe.encode(F.col("text"), RANKS, PATTERN).alias("ids"))
    return digests(coded, keep_ids=True)


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("pii surrogates", surrogate_stage),
    ("byte-level bpe", encoding_stage),
]
ORACLE_SQL = None  # SQL has neither XXH64 nor the encoding; tests hold every stage against brute force


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
