import random

import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from credlake.llm import transducer
from credlake.llm.op9_token_counts import TOKENIZER, op9_token_counts

ALPHABET = "abcdefgh  ''streSTRE\n\t\r 0123٣ß éñ漢字😀́\x1c\x85   .,!?-_<|>İΣςdž"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def own():
    return transducer.counter(TOKENIZER)


def plain(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def cut(text, width):
    """(part, before, after) at the first border from every multiple of ``width`` on, as the Spark job cuts."""
    letters = regex.compile(f"[{transducer.LETTERS}]")
    plain_marks = regex.compile(f"[{transducer.PUNCTUATION}]")

    def may(i):
        if any(text[i - j:i - j + len(s)] == s for s in ("<|endoftext|>", "<|startoftext|>") for j in range(1, len(s)) if i >= j):
            return False
        return (text[i] in transducer.ENDS or (i >= 4 and all(map(letters.match, text[i - 4:i + 1])))
                or bool(plain_marks.match(text[i - 1]) and plain_marks.match(text[i])))
    bounds = [0]
    for k in range(width, len(text), width):
        bounds += next(([i] for i in range(k, min(k + width, len(text))) if may(i)), [])
    bounds.append(len(text))
    return [(text[a:b], text[max(0, a - transducer.WARM):a], text[b:b + 1]) for a, b in zip(bounds, bounds[1:])]


def test_counts_and_chunk_maps_equal_the_library(own, library):
    rng = random.Random(5)
    start = transducer.packed(transducer.START)
    for i in range(2500):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60)))
        if i % 3 == 0:
            text += "".join(rng.choice("antidsθ" if i % 2 else "ab!.-") for _ in range(rng.randrange(40)))
        if i % 4 == 0:
            k = rng.randrange(len(text) + 1)
            text = text[:k] + rng.choice(["<|endoftext|>", "<|startoftext|>", "<|endof"]) + text[k:]
        want = plain(library, text)
        assert own.text(text) == want, text
        state, total = start, 0
        for part, before, after in cut(text, rng.randint(1, 20)) if text else []:
            begun, goes_on = bool(before) and part[0] not in transducer.ENDS, bool(after) and after not in transducer.ENDS
            [(entry, state, n)] = own.chunk(part, [state], begun, goes_on)
            total += n
        assert total == want and state == start, text


def test_guessed_entries_hold_the_true_state(own):
    text = "internationalisation" * 40
    live = own.transducer.run(transducer.START, own.symbols(text, ends=False))[0]
    assert transducer.packed(live) in own.entries(text[-transducer.WARM:])


def test_full_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(transducer, "STATES", 20)
    monkeypatch.setattr(transducer, "WORDS", 3)
    small = transducer.Counter(TOKENIZER)
    for text in ("the unbelievable truth about tokenization in practice", "a" * 300):
        assert small.text(text) == plain(library, text)


def test_query_equals_library(spark, sf, docs, library):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in op9_token_counts(spark, sf).collect())
    want = []
    for r in docs.collect():
        n = plain(library, r.text or "")
        want.append((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), n, n > 2048))
    assert got == sorted(want)


def test_long_texts_are_cut_and_composed(docs, empty, library):
    got = transducer.token_counts(docs.select("doc_id", "text", "lang"), TOKENIZER, out="lang", chunk=50).collect()
    assert len(got) == docs.count()
    assert all(r.lang == plain(library, r.text or "") for r in got)
    assert transducer.token_counts(empty, TOKENIZER).count() == 0


LONG = ["a" * 700 + " end", "supercalifragilistic" * 60, "x!?;" + "-=" * 300 + "'s", "漢字かな" * 150, "it's " * 90 + "<|endoftext|>" * 20,
        "привет" * 80 + "0123456789" * 20, "😀" * 200 + "e\u0301" * 200, "no" + " \n" * 200, "ab" * 33, "", None]


@pytest.mark.parametrize("warm", [64, 4])
def test_one_word_texts_are_cut_inside_the_word(spark, library, monkeypatch, warm):
    """With four characters to guess from, states are missing at first and chunks are read again."""
    turns, compose = [], transducer.composed
    monkeypatch.setattr(transducer, "WARM", warm)
    monkeypatch.setattr(transducer, "composed", lambda *a: turns.append(a) or compose(*a))
    df = spark.createDataFrame(list(enumerate(LONG)), "doc_id int, text string")
    got = {r.doc_id: r.n_tokens for r in transducer.token_counts(df, TOKENIZER, chunk=60).collect()}
    assert got == {i: plain(library, t or "") for i, t in enumerate(LONG)}
    assert len(turns) > 1 if warm < 64 else len(turns) < 4
    parts = transducer.chunks(df.where("length(text) > 60"), F.col("text"), "doc_id", TOKENIZER, 60).collect()
    for i in (0, 1, 2, 3, 5):
        mine = sorted((r["at"], r["part"]) for r in parts if r["row"] == i)
        assert len(mine) >= 5 and "".join(p for _, p in mine) == LONG[i]


def test_a_state_that_no_guess_gave_is_asked_for(spark):
    """Composition by hand: the second chunk does not know the first one's exit."""
    start = transducer.packed(transducer.START)
    rows = [(1, 0, [(start, b"x", 2, None)]), (1, 1, [(b"y", start, 3, None)]), (1, 2, [(start, start, 4, None)]),
            (2, 0, [(start, b"y", 2, None)]), (2, 1, [(b"z", start, 9, None), (b"y", start, 3, None)])]
    maps = spark.createDataFrame(rows, f"row long, at long, m {transducer.MAP}")
    got = {r["row"]: (r["count"], bytes(r["exit"]), r["lost"]) for r in transducer.composed(maps, 2).collect()}
    assert got == {1: (2, b"x", 1), 2: (5, start, None)}


def test_clashing_columns(spark, library):
    rows = [(1, "some words here " * 9, "c", 1, 2, 3), (2, None, "c", 1, 2, 3), (3, "short", "c", 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, counted string, `row` int, at int, part int")
    for chunk in (10, 10_000):
        got = transducer.token_counts(df, TOKENIZER, chunk=chunk).collect()
        assert sorted((r.doc_id, r.counted, r.row, r.at, r.part, r.n_tokens) for r in got) == [(i, *rest, plain(library, t or "")) for i, t, *rest in rows]
