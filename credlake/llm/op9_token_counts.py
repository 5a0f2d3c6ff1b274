"""Query ``op9_token_counts``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from credlake.llm.common import table, utf8
from credlake.llm.transducer import token_counts

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LIMIT = 2048


def op9_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.octet_length(utf8(F.col("text"))).cast("long").alias("n_bytes"))
    counted = token_counts(docs, TOKENIZER)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
