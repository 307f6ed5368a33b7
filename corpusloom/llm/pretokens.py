"""Splitting of texts into the pieces a byte-level BPE works on, as a table-driven finite-state transducer.

The splitting rule of the public byte-level vocabularies is compiled into one deterministic transducer over eleven
character classes. A transition carries the cuts it emits: before the current character, or before the previous one
where the rule has to look one character ahead. Long texts are cut into chunks. A chunk whose entry state is unknown is
run from every state at once; these state maps compose by an associative scan, which gives every chunk its entry state,
and one more pass emits the cuts of all chunks side by side.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from tokenizers import Tokenizer

BYTE_BPE = "byte_bpe_50k.json"
CHUNK = 1024
HEAD = 24  # after so many characters nearly every entry state has led to the same state
CHARS_AT_ONCE = 2_000_000
WORDS_KEPT = 200_000  # memory bound of the per-worker tables; what has been dropped is computed anew

STMD, R, V, ELL, E, LETTER, NUMBER, APOSTROPHE, MARK, BLANK, SPACE = range(11)
START, IN_LETTERS, IN_NUMBERS, IN_MARKS, AFTER_BLANK, AFTER_SPACE, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, SHORTENED = range(11)
CUT_HERE, CUT_BEFORE = 1, 2
CLASSES = STATES = 11


def character_classes(name: str = BYTE_BPE) -> np.ndarray:
    """Class of every code point. Unicode versions differ in young letters and digits: those are asked of the library."""
    points = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    classes = np.full(0x110000, MARK, np.uint8)
    for pattern, cls in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        classes[[ord(c) for c in regex.findall(pattern, points)]] = cls
    cut = Tokenizer.from_file(public_tokenizers.path(name)).pre_tokenizer.pre_tokenize_str
    for point in np.flatnonzero(np.isin(classes, (LETTER, NUMBER))).tolist():
        c = chr(point)
        if unicodedata.category(c) == "Cn":
            classes[point] = LETTER if len(cut("a" + c)) == 1 else NUMBER if len(cut("1" + c)) == 1 else MARK
    for chars, cls in (("stmd", STMD), ("r", R), ("v", V), ("l", ELL), ("e", E), ("'", APOSTROPHE), (" ", BLANK)):
        classes[[ord(c) for c in chars]] = cls
    return classes


def compile_splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state, times CLASSES, and emitted cuts for state * CLASSES + class."""
    letters = {STMD, R, V, ELL, E, LETTER}
    entered = {NUMBER: IN_NUMBERS, APOSTROPHE: QUOTE, MARK: IN_MARKS, BLANK: AFTER_BLANK, SPACE: AFTER_SPACE}
    entered |= dict.fromkeys(letters, IN_LETTERS)
    follow = np.zeros(STATES * CLASSES, np.uint8)
    cuts = np.zeros(STATES * CLASSES, np.uint8)
    for state in range(STATES):
        for cls in range(CLASSES):
            to, cut = entered[cls], CUT_HERE
            white = cls in (BLANK, SPACE)
            if state == IN_LETTERS and cls in letters or state == IN_NUMBERS and cls == NUMBER:
                cut = 0
            elif state in (IN_MARKS, QUOTE) and cls in (MARK, APOSTROPHE):
                to, cut = IN_MARKS, 0
            elif state in (AFTER_BLANK, AFTER_SPACE) and white:
                cut = 0  # one run of white space
            elif state == AFTER_BLANK:  # the last blank of a run belongs to what follows
                to, cut = (IN_MARKS if cls == APOSTROPHE else to), CUT_BEFORE
            elif state == AFTER_SPACE:  # the last other white space of a run stands alone
                cut = CUT_BEFORE | CUT_HERE
            elif state == QUOTE and cls in (STMD, R, V, ELL):
                to, cut = {STMD: SHORTENED, R: QUOTE_R, V: QUOTE_V, ELL: QUOTE_L}[cls], 0
            elif state in (QUOTE_R, QUOTE_V) and cls == E or state == QUOTE_L and cls == ELL:
                to, cut = SHORTENED, 0
            elif state in (QUOTE_R, QUOTE_V, QUOTE_L):  # no short form after all: the letter began a word
                cut = CUT_BEFORE | (0 if cls in letters else CUT_HERE)
            follow[state * CLASSES + cls], cuts[state * CLASSES + cls] = to * CLASSES, cut
    return follow, cuts


def compose_scan(maps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Inclusive scan of chunk state maps: row i becomes the map from the first chunk of its text through chunk i.

    `first` is the row of the first chunk of each row's text. log2 rounds, each composing rows twice as far apart.
    """
    maps, rows, step = maps.copy(), np.arange(len(maps)), 1
    while step < len(maps):
        later = rows[rows - step >= first]
        if not len(later):
            break
        maps[later] = np.take_along_axis(maps[later], maps[later - step], axis=1)
        step *= 2
    return maps


class Splitter:
    """Finds where the pieces of texts begin."""

    def __init__(self, chunk: int = CHUNK):
        self.classes, self.chunk = character_classes(), chunk
        self.follow, self.cuts = compile_splitter()

    def _run(self, classes, begins, lengths, states, read=None) -> np.ndarray:
        """Advance all chunks side by side; states are held times CLASSES. `read` gets state and class of each place."""
        order = np.argsort(-lengths, kind="stable")
        at, states, lengths = begins[order], states[order], lengths[order]
        active = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
        for n in active.tolist():
            key = states[:n] + (classes[at[:n]] if states.ndim == 1 else classes[at[:n]][:, None])
            states[:n] = self.follow[key]
            if read is not None:
                read[at[:n]] = key
            at[:n] += 1
        out = np.empty_like(states)
        out[order] = states
        return out

    def _entries(self, classes, begins, lengths, first, read) -> np.ndarray:
        """State in which each chunk is entered; fills `read` behind the place from which the entry no longer matters."""
        every = np.tile(np.arange(STATES, dtype=np.uint8) * CLASSES, (len(begins), 1))
        head = np.minimum(HEAD, lengths)
        maps = self._run(classes, begins, head, every)
        settled = (maps == maps[:, :1]).all(axis=1)
        same, open_ = np.flatnonzero(settled), np.flatnonzero(~settled)
        maps[same] = self._run(classes, (begins + head)[same], (lengths - head)[same], maps[same, 0], read)[:, None]
        maps[open_] = self._run(classes, (begins + head)[open_], (lengths - head)[open_], maps[open_])
        through = compose_scan(maps // CLASSES, first) * CLASSES
        rows = np.arange(len(begins))
        entry = np.where(rows > first, through[rows - 1, START], np.uint8(START))
        rest = np.where(settled, head, lengths)
        self._run(classes, begins, rest, entry, read)
        return np.where(rows >= first, through[rows, START], 0)

    def places(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the texts joined: the code points, where each text begins, where each piece begins, and each text's first piece.
        The second and the fourth have one more entry, for the end."""
        sizes = np.array([len(t) for t in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        classes = self.classes[points]
        begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        chunks = -(-sizes // self.chunk)
        text_of = np.repeat(np.arange(len(texts)), chunks)
        first = np.repeat(np.cumsum(chunks) - chunks, chunks)
        number = np.arange(len(text_of)) - first
        begins = begin[text_of] + number * self.chunk
        lengths = np.minimum(self.chunk, begin[text_of + 1] - begins)
        read = np.zeros(len(classes) + 1, np.uint8)
        ends = self._entries(classes, begins, lengths, first, read)
        emitted = self.cuts[read]
        emitted[-1] = 0
        cut = (emitted & CUT_HERE).astype(bool)
        cut[:-1] |= (emitted[1:] & CUT_BEFORE).astype(bool)
        last = np.flatnonzero(number == chunks[text_of] - 1)
        open_quote = last[np.isin(ends[last] // CLASSES, (QUOTE_R, QUOTE_V, QUOTE_L))]
        cut[begins[open_quote] + lengths[open_quote] - 1] = True
        places = np.flatnonzero(cut[:-1])
        return points, begin, places, np.searchsorted(places, begin)

    def starts(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, the positions of its pieces' first characters."""
        _, begin, places, bounds = self.places(texts)
        return [places[bounds[i] : bounds[i + 1]] - begin[i] for i in range(len(texts))]

    def pieces(self, texts: list[str]) -> Iterator[list[str]]:
        """The pieces of each text; texts are taken in groups of about CHARS_AT_ONCE characters."""
        for group in batches(texts, len, CHARS_AT_ONCE):
            for text, starts in zip(group, self.starts(group), strict=True):
                at = starts.tolist()
                yield [text[a:b] for a, b in zip(at, [*at[1:], len(text)], strict=False)]  # no start in an empty text


def batches(items: list, size, most: int) -> Iterator[list]:
    """Consecutive items, in groups of at most `most` in total size, or of one larger item."""
    group, total = [], 0
    for item in items:
        n = size(item)
        if group and total + n > most:
            yield group
            group, total = [], 0
        group.append(item)
        total += n
    if group:
        yield group


def tokenizer_file(name: str = BYTE_BPE) -> dict:
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return json.load(file)


def special_strings(spec: dict) -> list[str]:
    return [t["content"] for t in spec["added_tokens"]]


def byte_symbols() -> dict[str, int]:
    """The printable character that a byte-level vocabulary writes for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


class Remembered(dict):
    """Values by key, computed once while kept. Holds two generations of at most `most` keys, dropping the older."""

    def __init__(self, most: int = WORDS_KEPT):
        super().__init__()
        self.most, self.older = most, {}

    def compute(self, key):
        raise KeyError(key)

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordIds(Remembered):
    """Piece -> its ids as little-endian bytes, from the tokenizers library, kept for the worker's lifetime."""

    def __init__(self, name: str = BYTE_BPE, dtype: str = "<u4"):
        super().__init__()
        self.model = Tokenizer.from_file(public_tokenizers.path(name)).model
        spec = tokenizer_file(name)
        self.special = {t["content"]: np.array([t["id"]], dtype).tobytes() for t in spec["added_tokens"]}
        self.pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.splitter = Splitter()
        self.symbols = {b: c for c, b in byte_symbols().items()}
        self.width = np.dtype(dtype).itemsize
        self.packed = [n.to_bytes(self.width, "little") for n in range(max(spec["model"]["vocab"].values()) + 1)]

    def compute(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isprintable()
        symbols = piece.replace(" ", self.symbols[32]) if plain else "".join(map(self.symbols.__getitem__, piece.encode()))
        return b"".join([self.packed[t.id] for t in self.model.tokenize(symbols)])

    def _plain(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, all of them together: a piece that comes more than once is looked up once, and its ids are copied
        to all its places."""
        points, _, places, bounds = self.splitter.places(texts)
        data, offsets = "".join(texts).encode(), np.append(places, len(points)).astype(np.int64)
        if len(data) > len(points):  # places of bytes in place of those of characters
            size = (points >= 0x80).view(np.uint8) + (points >= 0x800).view(np.uint8) + (points >= 0x10000).view(np.uint8)
            offsets += np.concatenate([[0], np.cumsum(size, dtype=np.int64)])[offsets]
        found = pa.Array.from_buffers(pa.large_string(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        ids = [self[piece] for piece in found.dictionary.to_numpy(zero_copy_only=False).tolist()]
        lengths = np.array(list(map(len, ids)), np.int64) // self.width
        which = found.indices.to_numpy(zero_copy_only=False)
        count = lengths[which]
        upto = np.concatenate([[0], np.cumsum(count)])
        source = np.repeat((np.cumsum(lengths) - lengths)[which] - upto[:-1], count) + np.arange(upto[-1])
        every = np.frombuffer(b"".join(ids), f"<u{self.width}")[source]
        for a, b in zip(upto[bounds[:-1]], upto[bounds[1:]], strict=True):
            yield every[a:b].tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text. A special string in a text is one id, as the library has it by default."""
        for group in batches(texts, len, CHARS_AT_ONCE):
            parts = [self.pattern.split(t) if any(s in t for s in self.special) else [t] for t in group]
            plain = self._plain([p for split in parts for p in split[::2]])
            for split in parts:
                yield b"".join(next(plain) if i % 2 == 0 else self.special[p] for i, p in enumerate(split))


_encoders: dict[tuple[str, str], WordIds] = {}


def word_ids(name: str = BYTE_BPE, dtype: str = "<u4") -> WordIds:
    """One encoder per worker."""
    if (name, dtype) not in _encoders:
        _encoders[name, dtype] = WordIds(name, dtype)
    return _encoders[name, dtype]
