r"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece there is exactly one token that a BPE encoding of
the prefix can end in.  ``Prefixes`` stores that token per prefix: a token t
that ends the prefix is the one if the stored token of what stands before t
may stand left of t, which ``Merges.apart`` decides by undoing merges along
the border.  So encoding is linear in the piece for a bounded token length,
appending bytes only extends the table, and an edit recomputes from the edit
until the longest token's length of entries agrees with the old table.

A piece is a match of the pattern that splits texts.  ``Encoder`` keeps the
packed ids of pieces it has met (a bounded table that is emptied when full,
which changes no result); ``EditableText`` keeps a text's pieces and their
tables for appends and edits.

In Spark, ``encode`` gives a text's ids as binary (little-endian unsigned
32-bit), and ``decode`` the bytes of ids.  Defined results: null and empty
texts have no ids, null ids no bytes; a text is encoded whole whatever its
length; repeated rows give equal results; other columns are not touched.
Special tokens are never produced.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from credlake.llm.common import ship

CACHED = 1 << 18  # entries of each table that a worker remembers
SHORT = 64  # bytes of a piece whose table is filled on demand
TOKEN = -1  # the key of a trie node's token


class Merges:
    """Merges over token numbers: below ``base`` symbols, above it the results of merges in their order."""

    def __init__(self, base: int):
        self.base = base
        self.left: list[int] = [-1] * base
        self.right: list[int] = [-1] * base
        self.pair: dict[tuple[int, int], int] = {}

    def add(self, left: int, right: int) -> int:
        """Append the merge of two tokens; its number."""
        self.pair[left, right] = token = len(self.left)
        self.left.append(left)
        self.right.append(right)
        return token

    def apart(self, a: int, b: int) -> bool:
        """Whether BPE, having made a and b side by side, leaves the border between them.

        Goes back in time: whichever of the two tokens at the border was made
        last is undone.  A merge across the border that ranks before the step
        just undone would have come first.  Of equal ranks the left one comes first.
        """
        before = len(self.left)
        while True:
            if self.pair.get((a, b), before) < before:
                return False
            if a > b:
                if a < self.base:
                    return True
                before, a = a, self.right[a]
            else:
                if b < self.base:
                    return True
                before, b = b + 1, self.left[b]


class Vocabulary:
    """Ranks of byte strings, with the merges that they imply."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
        self.ranks = ranks
        if sorted(ranks.values()) != list(range(len(ranks))) or any(len(t) != 1 for t in self.tokens[:256]):
            raise ValueError("ranks must be 0, 1, 2, ... with the single bytes first")
        self.merges = Merges(256)
        for number, token in enumerate(self.tokens[256:], 256):
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut], number), ranks.get(token[cut:], number)
                if a < number and b < number and self.merges.apart(a, b):
                    self.merges.add(a, b)
                    break
            else:
                raise ValueError(f"no merge makes token {number}")
        self.longest = max(map(len, self.tokens))
        self.trie: dict = {}  # byte -> node; TOKEN -> the token that ends here
        for number, token in enumerate(self.tokens):
            node = self.trie
            for byte in token:
                node = node.setdefault(byte, {})
            node[TOKEN] = number
        self.known: dict[tuple[int, int], bool] = {}

    def apart(self, a: int, b: int) -> bool:
        """``Merges.apart``, remembered (in a bounded table)."""
        if (found := self.known.get((a, b))) is None:
            if len(self.known) >= CACHED:
                self.known.clear()
            found = self.known[a, b] = self.merges.apart(a, b)
        return found

    def extend(self, piece: bytes, last: list[int], start: int) -> Iterator[int]:
        """Fill ``last`` (-1: unknown) from the tokens that start at ``start`` or after; yields each place once its entry is final.

        ``last[i]`` is the last token of the first i bytes.  Tokens are met by
        their starts, so all that end at a place are met before it is used.
        """
        trie, apart, size = self.trie, self.apart, len(piece)
        for at in range(start, size):
            before, node = last[at], trie
            for end in range(at, size):
                if (node := node.get(piece[end])) is None:
                    break
                if last[end + 1] < 0 and (token := node.get(TOKEN)) is not None and (not at or apart(before, token)):
                    last[end + 1] = token
            yield at + 1

    def last_of(self, piece: bytes, end: int, last: list[int]) -> int:
        """The last token of the first ``end`` bytes, filling ``last`` only where it is needed, longest tokens first."""
        ranks, known = self.ranks, self.known
        for start in range(max(0, end - self.longest), end):
            if (token := ranks.get(piece[start:end])) is not None:
                if not start:
                    break
                before = last[start]
                if before < 0:
                    before = self.last_of(piece, start, last)
                fits = known.get((before, token))
                if fits or fits is None and self.apart(before, token):
                    break
        last[end] = token
        return token


class Prefixes:
    """The last token of every prefix of a piece."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary = vocabulary
        self.piece = b""
        self.last: list[int] = [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        start, self.piece = len(self.piece), self.piece + more
        self.last += [-1] * len(more)
        for _ in self.vocabulary.extend(self.piece, self.last, max(0, start - self.vocabulary.longest)):
            pass

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of the bytes [start, stop); how many entries were computed."""
        old, shift, longest = self.last, len(new) - (stop - start), self.vocabulary.longest
        self.piece = self.piece[:start] + new + self.piece[stop:]
        self.last = old[:start + 1] + [-1] * (len(self.piece) - start)
        agreed = count = 0
        for end in self.vocabulary.extend(self.piece, self.last, max(0, start - longest)):
            if end <= start:
                continue
            count += 1
            agreed = agreed + 1 if end - shift > stop and old[end - shift] == self.last[end] else 0
            if agreed >= longest:
                self.last[end:] = old[end - shift:]
                break
        return count

    def tokens(self) -> list[int]:
        out, end, sizes = [], len(self.piece), self.vocabulary.tokens
        while end:
            out.append(self.last[end])
            end -= len(sizes[out[-1]])
        return out[::-1]


class _Memo(dict):
    """Packed ids by piece text."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHED:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Encoder:
    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex
        # The ranks' library takes white space as Unicode's property, which leaves out U+001C to U+001F.
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.vocabulary = vocabulary
        self.pieces = _Memo(lambda piece: self._piece(piece.encode()))
        self.spaced = _Memo(lambda word: self.pieces[" " + word] if word.isalpha() else self._whole(" " + word))
        # A space next to white space, where a text can't be cut before the space.
        self.joint = re.compile(r"[\s\x1c-\x1f] | [\s\x1c-\x1f]")
        self.own_space = r"\p{L}" in pattern and r" ?\p{L}+" in pattern and r" ?\p{N}+" in pattern and r" ?[^\s\p{L}\p{N}]+" in pattern

    def _piece(self, piece: bytes) -> bytes:
        v, end = self.vocabulary, len(piece)
        if end > SHORT:
            return array("I", Prefixes(v, piece).tokens()).tobytes()
        last, out = [-1] * (end + 1), []
        while end:
            token = last[end]
            if token < 0:
                token = v.last_of(piece, end, last)
            out.append(token)
            end -= len(v.tokens[token])
        return array("I", out[::-1]).tobytes()

    def _whole(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> bytes:
        """The ids, packed.  Where every single space belongs to the word after it, words are looked up whole."""
        if not self.own_space or self.joint.search(text):
            return self._whole(text)
        first, *rest = text.split(" ")
        return self._whole(first) + b"".join(map(self.spaced.__getitem__, rest))

    def decode(self, packed: bytes) -> bytes:
        return joined(self.vocabulary.tokens, packed)


def joined(tokens: list[bytes], packed: bytes) -> bytes:
    """The bytes of packed ids."""
    ids = array("I")
    ids.frombytes(packed)
    return b"".join(map(tokens.__getitem__, ids))


class EditableText:
    """A text whose ids stay exact under appends and edits, at the cost of what lies near the change.

    A match of the pattern looks at most one character past its end, so
    matches that end two characters before a change stay; after the change
    the old matches are taken up again where a new one ends at the same place.
    """

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder = encoder
        self.text = text
        self.pieces = self._tables(encoder.pattern.findall(text))

    def _tables(self, pieces: list[str]) -> list[tuple[str, Prefixes]]:
        return [(p, Prefixes(self.encoder.vocabulary, p.encode())) for p in pieces]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        shift = len(new) - (stop - start)
        self.text = self.text[:start] + new + self.text[stop:]
        kept, at = 0, 0
        while kept < len(self.pieces) and at + len(self.pieces[kept][0]) < start - 1:
            at += len(self.pieces[kept][0])
            kept += 1
        ends, end = {}, at
        for i, (piece, _) in enumerate(self.pieces[kept:], kept):
            end += len(piece)
            if end >= stop:
                ends[end + shift] = i + 1
        made, rest = [], len(self.pieces)
        for match in self.encoder.pattern.finditer(self.text, at):
            piece = match.group()
            reuse = self.pieces[kept] if not made and kept < len(self.pieces) else None
            if reuse and piece.startswith(reuse[0]) and piece != reuse[0]:  # an append to a piece extends its table
                reuse[1].append(piece[len(reuse[0]):].encode())
                made.append((piece, reuse[1]))
            else:
                made += self._tables([piece])
            if match.end() >= start + len(new) and match.end() in ends:
                rest = ends[match.end()]
                break
        self.pieces[kept:rest] = made

    def ids(self) -> list[int]:
        return [t for _, table in self.pieces for t in table.tokens()]


def ranks_of(path: str) -> dict[bytes, int]:
    """A file of ranks: a base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """The encoder for a file of ranks, kept by the worker."""
    return Encoder(Vocabulary(ranks_of(path)), pattern)


@lru_cache(maxsize=4)
def tokens_of(path: str) -> list[bytes]:
    """The tokens by id: all that decoding needs."""
    return sorted(ranks := ranks_of(path), key=ranks.get)


def encode(text: Column, path: str, pattern: str) -> Column:
    """A text's ids as binary, little-endian unsigned 32-bit each.  ``path`` must exist on every node."""
    ship()

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        use = encoder(path, pattern)
        for texts in batches:
            yield pa.array([use.encode(t.as_py()) for t in texts], pa.binary())
    return run(F.coalesce(text.cast("string"), F.lit("")))


def decode(ids: Column, path: str) -> Column:
    """The bytes that packed ids stand for."""
    ship()

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = tokens_of(path)
        for packed in batches:
            yield pa.array([joined(tokens, p.as_py()) for p in packed], pa.binary())
    return run(F.coalesce(ids, F.lit(b"")))
