"""Token counts by finite-state tokenizer compilation.

Two deterministic transducers are composed. The first cuts a text into pieces (`pretokens`): its chunk state maps
compose by a parallel prefix scan. The second reads the bytes of a piece and annotates every transition with the number
of tokens it emits. It is the byte-pair vocabulary itself, determinised as far as the texts need it:

* The encoding of a prefix p is the encoding of some shorter prefix q plus one last token, and q and that token are the
  only ones whose neighbouring tokens survive the merges as they are.
* So a state needs, for every q whose remaining bytes may still grow into a token, these bytes, the last token of q and
  the count of q relative to the count of p. There are finitely many such states.
* A transition reads a byte, finds the one q that the new last token continues, and emits count(q) + 1 - count(p),
  which may be negative: reading on can join tokens.

Counts of a path add up to the count of the piece, so a piece of any length takes time in proportion to its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusloom.llm.pretokens import BYTE_BPE, Remembered, Splitter, byte_symbols, special_strings, tokenizer_file

STATES_KEPT = 250_000  # memory bound of the compiled part; the rest is compiled again when needed
_compiled: dict[str, TokenCounter] = {}


class CountingTransducer:
    """Byte transducer with emitted token counts, determinised lazily from a vocabulary and its ranked merges.

    Tokens are numbered single bytes first, then in the order of the merges that make them. The bytes read since q are
    held as a node of the trie of all tokens. An item of a state is (node, last token of q or -1, relative count).
    """

    def __init__(self, tokens: list[bytes], merges: list[tuple[bytes, bytes]], kept: int = STATES_KEPT):
        listed, seen = [t for t in tokens if len(t) == 1], set()
        for a, b in merges:
            if a + b not in seen:
                seen.add(a + b)
                listed.append(a + b)
        number = {t: i for i, t in enumerate(listed)}
        self.singles = sum(len(t) == 1 for t in listed)
        self.merge = {}  # pair -> number of the token that it makes
        self.parts = [(i, i) for i in range(self.singles)]
        for a, b in merges:
            made = number[a + b]
            if made == len(self.parts):
                self.parts.append((number[a], number[b]))
            self.merge.setdefault(number[a] << 20 | number[b], made)
        self.child, self.token, self.grows = {}, [-1], [True]
        for t in listed:
            node = 0
            for byte in t:
                self.grows[node] = True
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.grows.append(False)
                node = self.child[key]
            self.token[node] = number[t]
        self.kept = kept
        self._forget()

    def _forget(self) -> None:
        root = ((0, -1, 0),)
        self.number, self.items, self.moves, self.fits = {root: 0}, [root], {}, {}

    def _neighbours(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart: no merge across their border comes before the merges that made them.

        The merges are undone from the last one back; `limit` is what a merge across the border has to come before.
        """
        key = left << 20 | right
        if (known := self.fits.get(key)) is not None:
            return known
        merge, parts, singles, limit, fit = self.merge, self.parts, self.singles, len(self.parts), True
        while True:
            if merge.get(left << 20 | right, limit) < limit:
                fit = False
                break
            if left < singles and right < singles:
                break
            if left > right:
                limit, left = left, parts[left][1]
            else:  # of two equal merges the left one is done first
                limit, right = right + 1, parts[right][0]
        self.fits[key] = fit
        return fit

    def _expand(self, state: int, byte: int) -> tuple[int, int]:
        child, token, fits = self.child, self.token, self.fits
        grown, chosen = [], -1
        for node, last, count in self.items[state]:
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            grown.append((node, last, count))
            if chosen < 0 and (t := token[node]) >= 0:
                if last < 0 or (fits.get(last << 20 | t) or self._neighbours(last, t)):
                    chosen, emitted = t, count + 1
        grows = self.grows
        new = tuple([(node, last, count - emitted) for node, last, count in grown if grows[node]] + [(0, chosen, 0)])
        to = self.number.setdefault(new, len(self.items))
        if to == len(self.items):
            self.items.append(new)
        move = self.moves[state << 8 | byte] = (to, emitted)
        return move

    def count(self, piece: bytes) -> int:
        if len(self.moves) > self.kept or len(self.fits) > self.kept:
            self._forget()
        state = total = 0
        moves = self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte) or self._expand(state, byte)
            state = move[0]
            total += move[1]
        return total


class TokenCounter(Remembered):
    """Piece -> number of its tokens; texts -> number of theirs."""

    def __init__(self, name: str = BYTE_BPE, splitter: Splitter | None = None):
        super().__init__(300_000)
        spec = tokenizer_file(name)
        symbol = byte_symbols()
        raw = lambda s: bytes(symbol[c] for c in s)
        self.special = special_strings(spec)
        tokens = [raw(t) for t in spec["model"]["vocab"] if t not in self.special]
        merges = [tuple(map(raw, m if isinstance(m, list) else m.split(" "))) for m in spec["model"]["merges"]]
        self.machine, self.splitter = CountingTransducer(tokens, merges), splitter or Splitter()

    def compute(self, piece: str) -> int:
        return self.machine.count(piece.encode())

    def _split(self, text: str) -> list[str]:
        parts = [text]
        for special in self.special:
            parts = [p for part in parts for p in part.split(special)]
        return parts

    def counts(self, texts: list[str]) -> list[int]:
        parts = [self._split(t) if any(s in t for s in self.special) else [t] for t in texts]
        each = (sum(map(self.__getitem__, words)) for words in self.splitter.pieces([p for ps in parts for p in ps]))
        return [sum(next(each) for _ in ps) + len(ps) - 1 for ps in parts]


def token_counter(name: str) -> TokenCounter:
    """One compiled transducer per worker."""
    if name not in _compiled:
        _compiled[name] = TokenCounter(name)
    return _compiled[name]


def count_tokens(docs: DataFrame, text: str = "text", tokenizer: str = BYTE_BPE, limit: int = 1024) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit to every row; needs no shuffle.

    A null text counts as empty: 0 bytes, 0 tokens. Rows, repeated rows and further columns stay as they are; columns
    with one of the three new names are replaced. An empty table gives an empty table.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("n_bytes", "n_tokens", "over_limit")]
    new = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(tokenizer)
        for batch in rows:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            n = counter.counts(texts)
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([c > limit for c in n])]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in [*kept, *new]])

    return docs.mapInArrow(run, T.StructType([*kept, *new]))
