"""Token lookups for fixed-length model inputs, as Arrow UDFs that see each distinct word of a batch once."""

from __future__ import annotations

import functools
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lists(like: pa.Array, counts, values: pa.Array) -> pa.Array:
    offsets = pa.array([0, *counts.cumsum().tolist()], pa.int32())
    return pa.ListArray.from_arrays(offsets, values, mask=like.is_null())


@functools.lru_cache(maxsize=4)
def _built(sent, build):
    """What a worker builds from a broadcast value, kept for the batches that follow."""
    return build(sent.value)


def _lookup_table(table: tuple[list[str], list[int]]) -> tuple[pa.Array, pa.Array]:
    return pa.array(table[0], pa.string()), pa.array(table[1], pa.int32())


def token_id_udf(sent, unknown: int):
    """UDF: token array -> id array by a broadcast (terms, ids); unknown tokens get the given id."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def token_ids(tokens: pa.Array) -> pa.Array:
        terms, ids = _built(sent, _lookup_table)
        flat = tokens.flatten()
        places = pc.index_in(flat, value_set=terms.cast(flat.type))
        found = pc.fill_null(ids.take(places), unknown)
        counts = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return _lists(tokens, counts, found)

    return token_ids


def _is_mark(ch: str) -> bool:
    ascii_mark = 33 <= ord(ch) <= 47 or 58 <= ord(ch) <= 64 or 91 <= ord(ch) <= 96 or 123 <= ord(ch) <= 126
    return ascii_mark or unicodedata.category(ch).startswith("P")


def basic_words(chunk: str) -> list[str]:
    """Lower-case, drop accents and split a whitespace-free chunk around punctuation marks."""
    words, current = [], ""
    for ch in unicodedata.normalize("NFD", chunk.lower()):
        if unicodedata.category(ch) == "Mn":
            continue
        if _is_mark(ch):
            words += [current] * bool(current) + [ch]
            current = ""
        else:
            current += ch
    return words + [current] * bool(current)


class PieceTrie:
    """Longest-match splitting in one pass over a word (Song et al., 2021).

    One trie holds the pieces that may start a word, one those that may go on in it, without their ##. Every node knows
    which pieces are certain once no child fits the next character, and the node of the second trie that stands for the
    characters left over. So a character is never read again.
    """

    def __init__(self, vocab):
        self.children: list[dict[str, int]] = [{}, {}]
        self.piece: list[str | None] = [None, None]
        for term in vocab:
            self._add(0, term, term)
            if term.startswith("##") and len(term) > 2:
                self._add(1, term[2:], term)
        self.back: list[int] = [-1] * len(self.children)
        self.certain: list[tuple[str, ...]] = [()] * len(self.children)
        level = [(root, ch, node) for root in (0, 1) for ch, node in self.children[root].items()]
        while level:
            for parent, ch, node in level:
                self._link(parent, ch, node)
            level = [(node, ch, child) for _, _, node in level for ch, child in self.children[node].items()]

    def _add(self, root: int, text: str, piece: str) -> None:
        node = root
        for ch in text:
            if ch not in self.children[node]:
                self.children[node][ch] = len(self.children)
                self.children.append({})
                self.piece.append(None)
            node = self.children[node][ch]
        if text:
            self.piece[node] = piece

    def _link(self, parent: int, ch: str, node: int) -> None:
        if self.piece[node] is not None:
            self.back[node], self.certain[node] = 1, (self.piece[node],)
            return
        found, at = self.certain[parent], self.back[parent]
        while at >= 0 and ch not in self.children[at]:
            found, at = found + self.certain[at], self.back[at]
        if at >= 0:
            self.back[node], self.certain[node] = self.children[at][ch], found

    def split(self, word: str) -> list[str] | None:
        """The pieces of a word, or None if it can't be put together."""
        out: list[str] = []
        node = 0
        for ch in word:
            while ch not in self.children[node]:
                if self.back[node] < 0:
                    return None
                out += self.certain[node]
                node = self.back[node]
            node = self.children[node][ch]
        while node > 1:
            if self.back[node] < 0:
                return None
            out += self.certain[node]
            node = self.back[node]
        return out


def word_pieces(word: str, trie: PieceTrie, unknown: str = "[UNK]", longest: int = 200) -> list[str]:
    """Greedy longest-match split into vocabulary pieces; inner pieces carry a leading ##.

    A word of more than `longest` characters is unknown as a whole: that is the sub-word tokenizer's own rule."""
    pieces = trie.split(word) if len(word) <= longest else None
    return [unknown] if pieces is None else pieces


def word_piece_udf(sent):
    """UDF: array of whitespace-free chunks -> array of pieces of a broadcast vocabulary."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def pieces(chunks: pa.Array) -> pa.Array:
        trie = _built(sent, PieceTrie)
        words = chunks.flatten().dictionary_encode()
        split = [[p for w in basic_words(c) for p in word_pieces(w, trie)] for c in words.dictionary.to_pylist()]
        per_word = pa.array(split, pa.list_(pa.string())).take(words.indices)
        lengths = per_word.value_lengths().to_numpy(zero_copy_only=False)
        ends = chunks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).cumsum()
        upto = [0, *lengths.cumsum().tolist()]
        offsets = pa.array([0, *[upto[e] for e in ends]], pa.int32())
        return pa.ListArray.from_arrays(offsets, per_word.flatten(), mask=chunks.is_null())

    return pieces
