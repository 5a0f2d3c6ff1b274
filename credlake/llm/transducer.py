r"""Token counts by a compiled finite-state transducer.

The tokenizer file describes a lower-casing BPE with word ends: special
strings are cut out first (one token each), the rest is put in NFC, white
space made a space, each character lower-cased, cut by a pattern (white space
dropped) and merged by rank, the last byte of a cut being a symbol of its own.

``CountTransducer`` reads symbols.  A state holds, for every start from which
a vocabulary token may still be running, the place in the token trie, the
last token before that start and the tokens counted there relative to here;
nothing else can matter later.  A transition is annotated with the change of
the number of tokens of what was read, which the one valid last token
determines (see ``bpe``).  States are compiled when first reached and kept in
a bounded table, which is emptied when full; that changes no count.

Long texts are cut into chunks.  A border may lie inside a piece: before a
space, a line feed or a digit a piece has ended, and between plain letters or
plain punctuation one goes on, so the chunks can be normalised and cut into
pieces on their own.  A chunk's map gives, for states that its first piece may
be entered in, the state it is left in and the tokens emitted.  The entries are
those states that the characters before the border lead to, read from each of
``ALIGN`` places; as a rule they meet in one or two.  Neighbours' maps are
composed in pairs, then pairs of pairs, in one Spark aggregation a round.  Where
a chunk is left in a state for which the next has no entry, the composed map
names the chunk and the state; the chunk is read once more from it and the maps
are composed again, so guesses only save rounds and decide no count.  Each such
turn settles at least one more chunk of a text.  A stretch without any border (scripts
without spaces beyond ``LETTERS``) stays in one chunk.

Defined results: null and empty texts have no bytes and no tokens; repeated
rows give repeated results; a column that clashes with an output column is
replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlake.llm.bpe import TOKEN, Merges
from credlake.llm.common import fresh, ship, stored

CHUNK = 1 << 16  # characters
CHUNKS = 256  # chunks of one text: those of a very long one are longer
WARM = 64  # characters before a border that entries are guessed from
ALIGN = 16  # places among them to start reading at
STATES = 1 << 18
WORDS = 1 << 19


# Where a piece has ended, and characters between which it goes on.  Letters that never combine with the one
# before and that lower-case to letters: ASCII, Cyrillic, kana, ideographs, Hangul syllables.
ENDS = " \n0123456789"
LETTERS = "A-Za-z\u0410-\u044f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
PUNCTUATION = r"!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~"


def border(specials: list[str]) -> str:
    """A pattern that matches, empty, where a text may be cut.

    Before four letters no contraction can end, so the piece of the letter
    before goes on; an apostrophe may start one and is no plain punctuation.
    A special string is never cut.
    """
    inside = "|".join(rf"(?<=\Q{s[:i]}\E)\Q{s[i:]}\E" for s in specials for i in range(1, len(s)))
    places = rf"(?=[{ENDS}])|(?<=[{LETTERS}]{{4}})(?=[{LETTERS}])|(?<=[{PUNCTUATION}])(?=[{PUNCTUATION}])"
    return rf"(?:{places})" + (rf"(?!{inside})" if inside else "")


def byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if printable, else the next from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(0x100 + others.index(b)) for b in range(256)]


START = ((0, -1, 0),)  # the state between pieces


class CountTransducer:
    def __init__(self, merges: Merges, spellings: list[tuple[int, ...]]):
        """``spellings``: the symbols of every token number; symbols are the numbers below ``merges.base``."""
        self.apart = merges.apart
        self.trie: list[dict[int, int]] = [{}]
        for number, symbols in enumerate(spellings):
            at = 0
            for s in symbols:
                if (then := self.trie[at].get(s)) is None:
                    then = self.trie[at][s] = len(self.trie)
                    self.trie.append({})
                at = then
            self.trie[at][TOKEN] = number
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple, int] = {START: 0}
        self.live: list[tuple] = [START]
        self.moves: list[dict[int, tuple[int, int]]] = [{}]

    def compile(self, state: int, symbol: int) -> tuple[int, int]:
        """The transition (next state, emitted count), entered into the table."""
        trie, emitted, last, running = self.trie, None, -1, []
        for node, before, count in self.live[state]:  # the earliest start first
            then = trie[node].get(symbol)
            if then is None:
                continue
            token = trie[then].get(TOKEN)
            if emitted is None and token is not None and (before < 0 or self.apart(before, token)):
                emitted, last = count + 1, token
            running.append((then, before, count))
        if emitted is None:
            raise ValueError("a symbol is not in the vocabulary")
        live = tuple((n, b, c - emitted) for n, b, c in running if len(trie[n]) > (TOKEN in trie[n])) + ((0, last, 0),)
        number = self.states.setdefault(live, len(self.live))
        if number == len(self.live):
            self.live.append(live)
            self.moves.append({})
        move = self.moves[state][symbol] = (number, emitted)
        return move

    def run(self, live: tuple, symbols) -> tuple[tuple, int]:
        """The state after ``symbols`` and the tokens emitted, from the state ``live``."""
        if len(self.live) > STATES:
            self.reset()
        state, total = self.states.setdefault(live, len(self.live)), 0
        if state == len(self.live):
            self.live.append(live)
            self.moves.append({})
        moves = self.moves
        for s in symbols:
            move = moves[state].get(s)
            if move is None:
                move = self.compile(state, s)
            state, emitted = move
            total += emitted
        return self.live[state], total

    def count(self, symbols) -> int:
        """Tokens of one piece of symbols."""
        return self.run(START, symbols)[1]


def packed(live: tuple) -> bytes:
    return np.array(live, "<i4").tobytes()


def unpacked(state: bytes) -> tuple:
    return tuple(map(tuple, np.frombuffer(state, "<i4").reshape(-1, 3).tolist()))


class Counter(dict):
    """Token counts by word: what stands between spaces and line feeds."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a lower-casing BPE with word ends")
        letters, vocab = byte_letters(), model["vocab"]
        self.plain = [vocab[c] for c in letters]
        self.final = [vocab[c + "</w>"] for c in letters]
        base = 2 * len(letters)
        merges, spelling = Merges(base), [(i,) for i in range(base)]
        for line in model["merges"]:
            a, b = (vocab[x] for x in (line.split(" ") if isinstance(line, str) else line))
            merges.add(a, b)
            spelling.append(spelling[a] + spelling[b])
        self.transducer = CountTransducer(merges, spelling)
        self.specials = specials_of(spec)
        self.special = re.compile("|".join(map(re.escape, self.specials)) or r"(?!)")
        pattern = steps[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.pattern = regex.compile(pattern)

    def symbols(self, piece: str, ends: bool = True) -> list[int]:
        code = piece.encode()
        plain = [self.plain[b] for b in (code[:-1] if ends else code)]
        return [*plain, self.final[code[-1]]] if ends else plain

    def piece(self, piece: str) -> int:
        return self.transducer.count(self.symbols(piece))

    def word(self, word: str) -> int:
        return sum(1 if p is None else self.piece(p) for p in self.pieces(word))

    def pieces(self, word: str) -> list[str | None]:
        """The pieces of a word, None for a special string."""
        if "<|" not in word:
            return self.normal(word)
        out: list[str | None] = []
        for i, part in enumerate(self.special.split(word)):
            out += ([None] if i else []) + self.normal(part)
        return out

    def normal(self, word: str) -> list[str]:
        if not word.isascii():
            word = unicodedata.normalize("NFC", word)
        if "Σ" in word:  # the library lower-cases every character by itself
            word = "".join(c.lower() for c in word)
        else:
            word = word.lower()
        if word.isalpha():
            return [word]
        return self.pattern.findall(word)

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS:
            self.clear()
        count = self[word] = self.word(word) if word else 0
        return count

    def text(self, text: str) -> int:
        return sum(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def entries(self, before: str) -> list[bytes]:
        """States that the characters before a border inside a piece may lead to."""
        pieces = self.pieces(re.split("[ \n]", before)[-1])
        symbols = self.symbols(pieces[-1], ends=False) if pieces and pieces[-1] else []
        return list(dict.fromkeys(packed(self.transducer.run(START, symbols[i:])[0]) for i in range(min(ALIGN, len(symbols) + 1))))

    def chunk(self, text: str, entries: list[bytes], begun: bool, goes_on: bool) -> list[tuple[bytes, bytes, int]]:
        """The map of a chunk: (entry state, exit state, tokens emitted).

        ``begun``: its first piece began before it; ``goes_on``: its last piece
        goes on after it.
        """
        run, start = self.transducer.run, packed(START)
        words = text.replace("\n", " ").split(" ")
        ends = [self.pieces(words[0])] + ([self.pieces(words[-1])] if len(words) > 1 else [])
        total = sum(map(self.__getitem__, words[1:-1]))
        first = ends[0].pop(0) if begun else None
        if begun and goes_on and len(words) == 1 and not ends[0]:
            found = [(e, run(unpacked(e), self.symbols(first, ends=False))) for e in entries]
            return [(e, packed(live), n) for e, (live, n) in found]
        leave = start
        if goes_on:
            live, n = run(START, self.symbols(ends[-1].pop(), ends=False))
            leave, total = packed(live), total + n
        total += sum(1 if p is None else self.piece(p) for pieces in ends for p in pieces)
        if not begun:
            return [(e, leave, total) for e in entries]
        return [(e, leave, total + run(unpacked(e), self.symbols(first))[1]) for e in entries]


def specials_of(spec: dict) -> list[str]:
    return [t["content"] for t in spec["added_tokens"] if t["special"]]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """The compiled tokenizer of a file, kept by the worker."""
    return Counter(path)


def count(text: Column, path: str) -> Column:
    """Tokens of a text.  ``path`` must exist on every node."""
    ship()

    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        use = counter(path)
        for texts in batches:
            yield pa.array([use.text(t.as_py()) for t in texts], pa.int64())
    return run(F.coalesce(text.cast("string"), F.lit("")))


MAP = "array<struct<entry: binary, exit: binary, count: bigint, lost: bigint>>"
ENTRIES = pa.list_(pa.struct([("entry", pa.binary()), ("exit", pa.binary()), ("count", pa.int64()), ("lost", pa.int64())]))


def mapper(path: str):
    """A column function: a chunk's map from its text, the characters before and after it, and an entry to read it from
    (null: those that the characters before suggest)."""
    ship()

    @F.arrow_udf(MAP)
    def run(parts: pa.Array, befores: pa.Array, nexts: pa.Array, asked: pa.Array) -> pa.Array:
        use, rows = counter(path), []
        for part, before, after, entry in zip(*(x.to_pylist() for x in (parts, befores, nexts, asked))):
            begun, goes_on = bool(before) and part[0] not in ENDS, bool(after) and after not in ENDS
            entries = [entry] if entry is not None else use.entries(before) if begun else [packed(START)]
            rows.append([{"entry": e, "exit": x, "count": n, "lost": None} for e, x, n in use.chunk(part, entries, begun, goes_on)])
        return pa.array(rows, ENTRIES)
    return run


def chunks(long: DataFrame, body: Column, row: str, path: str, chunk: int) -> DataFrame:
    """The chunks of the texts: row, at, text, characters before, character after."""
    with open(path, encoding="utf-8") as f:
        specials = specials_of(json.load(f))
    look = max([WARM, *map(len, specials)])
    cut_at = rf"(?s)^(.{{{look}}}.*?){border(specials)}"
    size = F.length(body)
    step = F.greatest(F.lit(chunk), F.ceil(size / CHUNKS).cast("int"))

    def cut(k):
        """The first border at or after the k-th step, NULL if the next step comes first."""
        before = F.lpad(F.substr(body, F.greatest(F.lit(1), k * step - look + 1), F.least(F.lit(look), k * step)), look, " ")
        window = F.concat(before, F.substr(body, k * step + 1, step + look))
        off = F.length(F.regexp_extract(window, cut_at, 1)) - look
        return F.when((off >= 0) & (off < step) & (k * step + off < size), k * step + off)

    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(size / step).cast("int") - 1))
    cuts = F.filter(F.transform(steps, cut), lambda c: c.isNotNull())
    bounds = F.concat(F.array(F.lit(0)), cuts, F.array(size))
    spans = F.transform(F.sequence(F.lit(0), F.size("_bounds") - 2), lambda i: F.struct(
        i.cast("long").alias("at"), F.get("_bounds", i).alias("a"), F.get("_bounds", i + 1).alias("b")))
    # Generate nodes: the borders are looked for once per text, the texts of the chunks made one by one.
    bounded = long.select(F.col(row).alias("row"), body.alias("_body"), F.explode(F.array(bounds)).alias("_bounds"))
    spread = bounded.select("row", "_body", F.explode(spans).alias("s")).select("row", "_body", "s.*")
    a, b, whole = F.col("a"), F.col("b"), F.col("_body")
    return spread.select("row", "at", F.substr(whole, a + 1, b - a).alias("part"),
                         F.substr(whole, F.greatest(F.lit(1), a - WARM + 1), F.least(F.lit(WARM), a)).alias("before"),
                         F.substr(whole, b + 1, F.lit(1)).alias("after")).repartition("row", "at")


def composed(maps: DataFrame, rounds: int) -> DataFrame:
    """One map per row, from those of its chunks: neighbours' maps are composed, an aggregation a round.

    An entry that leaves a chunk in a state unknown to the next keeps that state
    as its exit and the next chunk's place in ``lost``.
    """
    out = maps.select("row", "at", F.col("at").alias("start"), "m")
    for _ in range(rounds):
        side = lambda c, right: F.first(F.when(F.col("at") % 2 == right, F.col(c)), ignorenulls=True)
        pairs = out.groupBy("row", F.shiftright("at", 1).alias("up")).agg(
            side("m", 0).alias("left"), side("m", 1).alias("right"), side("start", 0).alias("start"), side("start", 1).alias("next"))

        def through(e):
            hit = F.get(F.filter("right", lambda r: r["entry"] == e["exit"]), 0)
            both = F.struct(e["entry"].alias("entry"), hit["exit"].alias("exit"), (e["count"] + hit["count"]).alias("count"), hit["lost"].alias("lost"))
            stray = F.struct(e["entry"].alias("entry"), e["exit"].alias("exit"), e["count"].alias("count"), F.col("next").alias("lost"))
            return F.when(e["lost"].isNotNull(), e).when(hit.isNull(), stray).otherwise(both)

        m = F.when(F.col("right").isNull(), F.col("left")).otherwise(F.transform("left", through))
        out = pairs.select("row", F.col("up").alias("at"), "start", m.alias("m"))
    return out.select("row", F.filter("m", lambda e: e["entry"] == F.lit(packed(START)))[0].alias("m")).select("row", "m.*")


def long_counts(long: DataFrame, body: Column, row: str, path: str, chunk: int) -> DataFrame:
    """``row`` and ``n`` of the stored texts ``long``, by composing the maps of their chunks."""
    read = mapper(path)
    pieces = chunks(long, body, row, path, chunk)
    maps = stored(pieces.select("row", "at", read("part", "before", "after", F.lit(None).cast("binary")).alias("m")), "chunk_maps")
    rounds = int(maps.agg(F.max("at")).first()[0] or 0).bit_length()
    while True:
        whole = stored(composed(maps, rounds), "text_maps")
        lost = whole.where(F.col("lost").isNotNull()).select("row", F.col("lost").alias("at"), F.col("exit").alias("asked"))
        if lost.isEmpty():
            return whole.select(F.col("row").alias(row), F.col("count").alias("n"))
        again = pieces.join(lost, ["row", "at"]).select("row", "at", read("part", "before", "after", "asked").alias("more"))
        maps = stored(maps.join(again, ["row", "at"], "left").select("row", "at", F.concat("m", F.coalesce("more", F.array().cast(MAP))).alias("m")), "chunk_maps")


def token_counts(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens", chunk: int = CHUNK) -> DataFrame:
    """``df`` with the token counts of ``text`` in the column ``out``.

    Texts of more than ``chunk`` characters are cut, their chunks dealt over
    the cluster, and the chunks' maps composed.
    """
    ship()
    body, keep = F.col(text).cast("string"), [c for c in df.columns if c != out]
    size = F.length(F.coalesce(body, F.lit("")))
    short = df.where(size <= chunk).withColumn(out, count(body, path)).select(*keep, out)
    row, counted = (fresh(df, c) for c in ("row", "counted"))
    long = stored(df.where(size > chunk).withColumn(row, F.monotonically_increasing_id()), "long_texts")
    if long.isEmpty():
        return short
    counts = long_counts(long, body, row, path, chunk).withColumnRenamed("n", counted)
    found = long.select(*keep, row).join(counts, row).withColumn(out, F.col(counted))
    return short.unionAll(found.select(*keep, out))
