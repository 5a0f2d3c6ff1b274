import hashlib
import random
from array import array

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from credlake.llm import bpe
from credlake.llm.op1_bpe import PATTERN, RANKS, op1_byte_bpe

ALPHABET = "abcdefgh  ''streSTRE\n\t\r 0123٣ß éñ漢字😀́\x1c\x85   .,!?-_<|>"


@pytest.fixture(scope="module")
def own():
    return bpe.encoder(RANKS, PATTERN)


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.vocabulary.ranks, special_tokens={})


def packed(ids):
    return array("I", ids).tobytes()


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_equals_library_on_random_texts(name):
    own = bpe.encoder(P.path(name), PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.vocabulary.ranks, special_tokens={})
    rng = random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(70)))
        assert own.encode(text) == packed(library.encode_ordinary(text)), text
        assert own.decode(own.encode(text)) == text.encode()


def test_long_pieces(own, library):
    for text in ("a" * 5000, " " * 3000, "!" * 3001 + "a", "ha" * 2000, "漢" * 1000, "<|endoftext|>"):
        assert own.encode(text) == packed(library.encode_ordinary(text))


def test_every_token_and_every_prefix(own, library):
    v = own.vocabulary
    for token in v.tokens[::97]:
        assert bpe.Prefixes(v, token).tokens() == [v.ranks[token]]
    piece = " unbelievably".encode()
    table = bpe.Prefixes(v, piece)
    for end in range(1, len(piece) + 1):
        assert table.last[end] == bpe.Prefixes(v, piece[:end]).tokens()[-1]


def test_appends_and_edits_are_exact_and_local(own, library):
    rng = random.Random(5)
    text, state = "", bpe.EditableText(own)
    for step in range(600):
        a = rng.randint(0, len(text))
        b = len(text) if step % 3 == 0 else min(len(text), a + rng.randint(0, 4))
        a = b if step % 3 == 0 else a
        new = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 9)))
        text = text[:a] + new + text[b:]
        state.replace(a, b, new)
        assert state.ids() == library.encode_ordinary(text)
        if len(text) > 250:
            text, state = "", bpe.EditableText(own)
    table = bpe.Prefixes(own.vocabulary, b"thequickbrown" * 400)
    assert table.replace(500, 505, b"zzz") < 120
    assert table.last == bpe.Prefixes(own.vocabulary, table.piece).last


def test_query_equals_library(spark, sf, docs, library):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op1_byte_bpe(spark, sf).collect())
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id is None, r.doc_id or 0, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_clashing_columns_and_empty_table(spark, empty):
    df = spark.createDataFrame([("ab", "x")], "ids string, text string").withColumn("ids", bpe.encode(F.col("ids"), RANKS, PATTERN))
    assert df.columns == ["ids", "text"] and len(df.first().ids) == 4
    assert empty.select(bpe.encode(F.col("text"), RANKS, PATTERN)).count() == 0
