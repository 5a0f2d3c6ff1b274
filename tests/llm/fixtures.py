"""Small tables with the hard cases, and plain versions of the operators to hold results against."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return " ".join(f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiouéß')}{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=7, plain=40):
    """(doc_id, text, lang, source, n_chars) rows: plain texts, copies, near copies, shared passages, junk, nulls."""
    rng = random.Random(seed)
    texts = [words(rng, rng.randint(1, 160)) + ".\n" + words(rng, rng.randint(1, 60)) for _ in range(plain)]
    passage = words(rng, 60)
    texts += [texts[0], texts[0], texts[3], texts[5][:-8] + "changed", words(rng, 20) + "\n" + passage + "\n" + words(rng, 9),
              passage + " " + words(rng, 30), "x", "", None, None, " \n\t ", "same line\n" * 30, words(rng, 4000), "a" * 5000, "漢字 😀 \r\n ½",
              "İSTANBUL ΣΑΣ don't", "word " * 40, "#$%& | <x> " * 12]
    rows = [(i * 3, t, "en", f"src{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [(0, texts[0], "en", "src0", len(texts[0])), (None, texts[2], None, "src1", None), (None, None, None, None, None)]
    rng.shuffle(rows)
    return rows
