"""Query ``op1_byte_bpe``: encode every document, decode the ids, return digests of both."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from credlake.llm.bpe import decode, encode
from credlake.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return digests(docs.select("doc_id", encode(F.col("text"), RANKS, PATTERN).alias("ids")))


def digests(coded, keep_ids=False):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, ids), with the ids on demand."""
    both = coded.select("doc_id", "ids", decode(F.col("ids"), RANKS).alias("decoded"))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), *(["ids"] if keep_ids else []))
