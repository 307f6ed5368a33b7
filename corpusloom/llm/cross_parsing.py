"""Language identification by cross-parsing entropy (Ziv and Merhav, 1993).

Per language a suffix automaton holds every string that occurs in a sample of its labelled text. A text is parsed against
it from left to right: each phrase is the longest string that occurs in the sample, or a single unknown byte. The fewer
phrases a text needs, the closer it is to the language; phrases times log2 of the sample's size, per byte of the text,
estimate the bits that the language leaves per byte. The language with the fewest bits wins.

Texts are lower-cased and reduced to their runs of letters with one blank around each, as UTF-8. They are parsed in
stretches, at whose ends a phrase ends too, so that very many stretches walk through an automaton in step and a long text
takes no longer than many short ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.pretokens import batches
from corpusloom.operators.ranking import top_n_per_group

LETTERS = regex.compile(r"\p{L}+")
UNDETERMINED = "und"
LANGUAGE_BYTES, ALL_BYTES = 64 << 10, 1 << 20  # bounds of the labelled sample: of one language, of all together
SAMPLE_CHARS = 2_048  # the sample is drawn in pieces of texts of so many characters
SPARE = 3  # so many times more pieces are drawn than needed, as copies count once
SHARES = 1 << 30
LEAST_SIZE = 4_096  # a smaller sample counts as one of so many bytes: its phrases are short, which must not make them cheap
BREAK = b"\xff"  # in no UTF-8 text, so no phrase runs from one piece of the sample into another
STRETCH = 1_024
BYTES_AT_ONCE = 4_000_000


def letters(text: str | None) -> bytes:
    """The runs of letters of a text, each with a blank before and behind it; empty without a letter."""
    words = LETTERS.findall((text or "").lower())
    return f" {' '.join(words)} ".encode() if words else b""


def suffix_automaton(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions (from, byte, to) of the smallest automaton that reads every string of `text` from state 0."""
    moves: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for byte in text:
        new = len(moves)
        moves.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        state, last = last, new
        while state >= 0 and byte not in moves[state]:
            moves[state][byte] = new
            state = link[state]
        if state < 0:
            continue
        onto = moves[state][byte]
        if longest[onto] == longest[state] + 1:
            link[new] = onto
            continue
        twin = len(moves)
        moves.append(dict(moves[onto]))
        longest.append(longest[state] + 1)
        link.append(link[onto])
        link[onto] = link[new] = twin
        while state >= 0 and moves[state].get(byte) == onto:
            moves[state][byte] = twin
            state = link[state]
    counts = [len(m) for m in moves]
    flat = np.array([x for m in moves for x in m.items()], np.int32).reshape(-1, 2)
    return np.repeat(np.arange(len(moves), dtype=np.int32), counts), flat[:, 0].astype(np.uint8), flat[:, 1]


@dataclass
class Language:
    name: str
    size: int  # bytes of the sample
    documents: int
    transitions: tuple[np.ndarray, np.ndarray, np.ndarray]

    def tables(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Column of each byte (0: unknown), next state by state and column (0: none; no transition leads to state 0), columns."""
        source, byte, target = self.transitions
        used = np.unique(byte)
        column = np.zeros(256, np.int32)
        column[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        states = int(max(source.max(initial=0), target.max(initial=0))) + 1
        table = np.zeros(states * width, np.int32)
        table[source.astype(np.int64) * width + column[byte]] = target
        return column, table, width


def phrases(flat: np.ndarray, start: np.ndarray, length: np.ndarray, tables: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Phrases of the stretches flat[start : start + length], which come longest first."""
    column, table, width = tables
    symbols = column[flat]
    count, state, place = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), start.copy()
    going = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")  # stretches longer than t
    for n in going.tolist():
        symbol, now = symbols[place[:n]], state[:n]
        onto = table[now * width + symbol]
        stop = onto == 0
        # a phrase ends before this byte, or the byte is unknown
        count[:n] += stop & (now > 0)
        again = table[symbol]
        count[:n] += again == 0
        state[:n] = np.where(stop, again, onto)
        place[:n] += 1
    return count + (state > 0)


def bits(texts: list[bytes], languages: list[Language], tables: list[tuple]) -> np.ndarray:
    """Texts x languages: bits per byte. An empty text has none."""
    sizes = np.array([len(t) for t in texts], np.int64)
    pieces = -(-sizes // STRETCH)
    owner = np.repeat(np.arange(len(texts)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = (np.cumsum(sizes) - sizes)[owner] + nth * STRETCH
    length = np.minimum(sizes[owner] - nth * STRETCH, STRETCH)
    order = np.argsort(-length, kind="stable")
    flat = np.frombuffer(b"".join(texts), np.uint8)
    out = np.zeros((len(texts), len(languages)))
    for k, (language, own) in enumerate(zip(languages, tables, strict=True)):
        found = np.bincount(owner[order], phrases(flat, start[order], length[order], own), len(texts))
        out[:, k] = found * math.log2(max(LEAST_SIZE, language.size)) / np.maximum(sizes, 1)
    return out


def train_languages(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = LANGUAGE_BYTES, every: int = ALL_BYTES) -> list[Language]:
    """Automata of the labelled texts, by name of the language.

    A language has at most `most` bytes of sample, all together at most `every`, in pieces of SAMPLE_CHARS characters that a
    hash of the text and the place picks from whole texts; equal pieces at equal places of equal texts count once. Rows
    without language or letters teach nothing. The languages themselves are gathered: there are few of them.
    """
    known = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    n_pieces = F.ceil(F.length("text") / SAMPLE_CHARS).cast("int")
    sizes = {r["lang"]: (r.n, r.docs) for r in known.groupBy("lang").agg(F.sum(n_pieces).alias("n"), F.count("*").alias("docs")).collect()}
    if not sizes:
        return []
    share = min(most, every // len(sizes))
    want = max(1, share // SAMPLE_CHARS + 1)
    cuts = [(name, min(SHARES, math.ceil(SHARES * SPARE * want / n))) for name, (n, _) in sizes.items()]
    cut = docs.sparkSession.createDataFrame(cuts, "lang string, cut long")
    named = known.join(F.broadcast(cut), "lang").withColumn("name", F.xxhash64("text"))
    drawn = lambda i: F.pmod(F.xxhash64("name", i), F.lit(SHARES))
    places = F.filter(F.sequence(F.lit(0), n_pieces - 1), lambda i: drawn(i) < F.col("cut"))
    picked = named.select("lang", "name", "text", places.alias("places")).where(F.size("places") > 0).select("lang", "name", "text", F.explode("places").alias("i"))
    pieces = picked.groupBy("lang", drawn(F.col("i")).alias("key"), "name", "i").agg(F.first(F.substring(F.col("text"), F.col("i") * SAMPLE_CHARS + 1, F.lit(SAMPLE_CHARS))).alias("piece"))
    rows = top_n_per_group(pieces, ["lang"], [F.col("key"), F.col("name"), F.col("i")], SPARE * want).select("lang", "rank", "piece").collect()
    out = []
    for name, (_, documents) in sorted(sizes.items()):
        own = [letters(r.piece) for r in sorted((r for r in rows if r["lang"] == name), key=lambda r: r["rank"])]
        sample = BREAK.join(p for p in own if p)[:share]
        if sample:
            out.append(Language(name, len(sample), documents, suffix_automaton(sample)))
    return out


def choose(costs: np.ndarray, languages: list[Language]) -> tuple[np.ndarray, np.ndarray]:
    """Per text the language with the fewest bits, and how much of the runner-up's bits it saves (of 8 bits, if there is no other).

    Of equal languages the one with more labelled documents wins, then the one with the smaller name.
    """
    order = sorted(range(len(languages)), key=lambda k: (-languages[k].documents, languages[k].name))
    ranked = costs[:, order]
    at = ranked.argmin(axis=1)
    best = ranked[np.arange(len(ranked)), at]
    others = ranked.copy()
    others[np.arange(len(ranked)), at] = np.inf
    second = others.min(axis=1) if len(languages) > 1 else np.full(len(ranked), 8.0)
    return np.array(order)[at], np.clip(1 - best / np.maximum(second, 1e-12), 0, 1)


def identify_languages(docs: DataFrame, languages: list[Language], text: str = "text") -> DataFrame:
    """Adds lang_pred, score and bits (per byte of letters, of the winner) to every row; needs no shuffle.

    A null text, one without letters, or any text if no language was learned, is `und` with score 0 and null bits. Rows and further
    columns stay as they are; columns named like a new one are replaced.
    """
    new = T._parse_datatype_string("lang_pred string, score double, bits double").fields
    kept = [f for f in docs.schema.fields if f.name not in {n.name for n in new}]
    schema = T.StructType([*kept, *new])
    sent = docs.sparkSession.sparkContext.broadcast(languages)  # bounded by ALL_BYTES

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = sent.value
        tables = [language.tables() for language in languages]
        for batch in rows:
            names, scores, least = [], [], []
            for group in batches(batch.column(text).to_pylist(), lambda t: len(t or ""), BYTES_AT_ONCE):
                reduced = [letters(t) for t in group]
                costs = bits(reduced, languages, tables) if languages else np.zeros((len(group), 0))
                if languages:
                    best, score = choose(costs, languages)
                for i, r in enumerate(reduced):
                    if r and languages:
                        names.append(languages[best[i]].name)
                        scores.append(float(score[i]))
                        least.append(float(costs[i, best[i]]))
                    else:
                        names.append(UNDETERMINED)
                        scores.append(0.0)
                        least.append(None)
            columns = [batch.column(f.name) for f in kept] + [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(least, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema)


def fifth(id_col: str = "doc_id") -> Column:
    """Every fifth of the ids, by their checksum; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))
