"""Quality rules by line sequence labelling: a linear-chain conditional random field marks lines as content or boilerplate.

Lines of documents labelled as good are content, those of documents labelled as bad are boilerplate. The field learns
from both what such lines look like and how they follow each other. Viterbi decoding labels the lines of every
document; the share of its words that stand in content lines decides whether it is retained. Base rules come first.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import crf
from corpusloom.operators.ranking import sample_n

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
TRAIN_DOCS = 3_000  # bound of the labelled sample, with TRAIN_LINES per document
TRAIN_LINES = 2_000
CONTENT_SHARE = 0.5
LINES_AT_ONCE = 200_000

CONTENT, BOILERPLATE = 0, 1  # a tie is content
# What a line is asked; each question has a fixed number of answers, and a line has one feature per question.
QUESTIONS = {
    "words": 8, "symbols": 5, "exclaims": 5, "capitals": 5, "digits": 4, "bars": 4, "variety": 5, "length": 5,
    "ending": 4, "opening": 4, "earlier": 2, "notice": 2, "place": 4,
}
N_FEATURES = sum(QUESTIONS.values())
_FIRST = dict(zip(QUESTIONS, np.cumsum([0, *QUESTIONS.values()])[:-1].tolist(), strict=True))
CAPITALS, DIGITS = re.compile(r"[A-ZÀ-ÖØ-ÞĀ-ŽΑ-ΩА-Я]"), re.compile(r"\d")
NOTICES = ("license", "licence", "copyright", "rights reserved", "cookie", "privacy", "terms of", "subscribe", "click here", "http", "www.", "@")


def _step(value: float, *bounds: float) -> int:
    return sum(value >= b for b in bounds)


def line_features(line: str, words: list[str], earlier: bool, place: int) -> list[int]:
    """The feature of every question about one line."""
    n, chars, low = len(words), sum(map(len, words)) or 1, line.lower()
    symbols = sum(map(line.count, SYMBOLS))
    end, begin = (line.rstrip() or " ")[-1], (line.lstrip() or " ")[0]
    answers = {
        "words": _step(n, 1, 2, 4, 8, 16, 32, 64),
        "symbols": _step(symbols / chars, 1e-9, 0.02, 0.08, 0.2),
        "exclaims": _step(line.count("!") / chars, 1e-9, 0.01, 0.05, 0.15),
        "capitals": _step(len(CAPITALS.findall(line)) / chars, 0.02, 0.15, 0.4, 0.7),
        "digits": _step(len(DIGITS.findall(line)) / chars, 1e-9, 0.05, 0.3),
        "bars": _step(line.count("|") / max(n, 1), 1e-9, 0.1, 0.3),
        "variety": _step(len(set(words)) / max(n, 1), 0.1, 0.3, 0.5, 0.8),
        "length": _step(chars / max(n, 1), 3, 5, 8, 14),
        "ending": 3 if end in ".?!" else 2 if end.isalnum() else 1 if end != " " else 0,
        "opening": 3 if begin.isupper() else 2 if begin.islower() else 1 if begin != " " else 0,
        "earlier": int(earlier), "notice": int(any(map(low.__contains__, NOTICES))), "place": place,
    }
    return [_FIRST[q] + a for q, a in answers.items()]


def document_lines(text: str) -> tuple[list[list[int]], list[int], int, list[str]]:
    """Features and number of words of each line, how many lines with a word repeat an earlier line, and all words."""
    lines, seen, features, sizes, repeats, all_words = text.split("\n"), set(), [], [], 0, []
    for i, line in enumerate(lines):
        words = WORDS.findall(line)
        again = bool(words) and line in seen
        repeats += again
        seen.add(line)
        place = 3 if len(lines) == 1 else 0 if i == 0 else 2 if i == len(lines) - 1 else 1
        features.append(line_features(line, words, again, place))
        sizes.append(len(words))
        all_words += words
    return features, sizes, repeats, all_words


def repeated_words(words: list[str], run: int = 3) -> int:
    """Words inside runs of so many words that occur twice or more in the text, the first time included."""
    runs = list(zip(*(words[i:] for i in range(run)), strict=False))
    counts = Counter(runs)
    if len(counts) == len(runs):
        return 0
    again = np.array([counts[r] > 1 for r in runs] + [False] * (run - 1))
    inside = again.copy()
    for k in range(1, run):
        inside[k:] |= again[:-k]
    return int(inside.sum())


def train_line_model(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality", most: int = TRAIN_DOCS
) -> crf.Model:
    """Fit the field on at most `most` labelled documents, chosen by a hash of their ids, of at most TRAIN_LINES lines.

    A label other than 0 and 1, or a null id, is no label; of several labels of one id the lowest counts. Without
    labelled documents all weights are zero, and every line then counts as content.
    """
    one = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(label).alias("_label"))
    chosen = F.broadcast(sample_n(one, most, 0, id_col))
    texts = docs.select(id_col, F.coalesce(text, F.lit("")).alias("_text")).join(chosen, id_col)
    schema = "id string, label int, features array<int>, n int"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for key, body, y in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if body.count("\n") < TRAIN_LINES:
                    features, *_ = document_lines(body)
                    out.append((str(key), y, [f for line in features for f in line], len(features)))
            types = (pa.string(), pa.int32(), pa.list_(pa.int32()), pa.int32())
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["id", "label", "features", "n"])

    rows = sorted(texts.mapInArrow(run, schema).collect(), key=lambda r: (r["id"], r["features"]))
    lengths = np.array([r["n"] for r in rows], np.int64)
    features = np.array([f for r in rows for f in r["features"]], np.int64)
    wanted = np.repeat([CONTENT if r["label"] else BOILERPLATE for r in rows], lengths).astype(np.int64)
    shares = np.bincount([r["label"] for r in rows], minlength=2)
    by_label = np.where(shares > 0, len(rows) / np.maximum(2 * shares, 1), 0)
    weight = np.repeat([by_label[r["label"]] / r["n"] for r in rows], lengths)  # labels and documents count alike
    counts = np.full(len(wanted), len(QUESTIONS), np.int64)
    return crf.train(features, counts, wanted, lengths, N_FEATURES, weight=weight if len(weight) else None)


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"


def judge_documents(docs: DataFrame, model: crf.Model, text: str = "text", share: float = CONTENT_SHARE) -> DataFrame:
    """Adds the base counts, the share of words in content lines and the verdict to every row; needs no shuffle.

    A null text has no words; no words, fewer than 50, or more than half of them in repeated runs of three fail the base
    rules. Otherwise a document is kept if at least `share` of its words stand in content lines. Rows, repeated rows and
    further columns stay; columns named like a new one are replaced.
    """
    new = T._parse_datatype_string(COLUMNS).fields
    kept = [f for f in docs.schema.fields if f.name not in {n.name for n in new}]
    schema = T.StructType([*kept, *new])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            facts, waiting, verdicts = [], [], []

            def decode() -> None:
                lengths = np.array([len(s) for _, s in waiting], np.int64)
                features = np.array([f for lines, _ in waiting for line in lines for f in line], np.int64)
                counts = np.full(lengths.sum(), len(QUESTIONS), np.int64)
                labels = crf.viterbi(model.scores(features, counts), lengths, model.moves)
                at = 0
                for _, sizes in waiting:
                    marked = labels[at : at + len(sizes)]
                    verdicts.append(float(np.dot(marked == CONTENT, sizes)) / max(1, sum(sizes)))
                    at += len(sizes)
                waiting.clear()

            held = 0
            for body in batch.column(text).to_pylist():
                body = body or ""
                features, sizes, repeats, words = document_lines(body)
                again = repeated_words(words)
                failed = len(words) < 50 or 100 * again > 50 * len(words)
                facts.append((len(words), sum(map(len, words)), sum(map(body.count, SYMBOLS)), repeats, again, failed))
                waiting.append((features, sizes))
                held += len(sizes)
                if held >= LINES_AT_ONCE:
                    decode()
                    held = 0
            if waiting:
                decode()
            rows_out = [(*f, v, not f[5] and v >= share) for f, v in zip(facts, verdicts, strict=True)]
            columns = list(zip(*rows_out, strict=True)) or [[]] * len(new)
            types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            arrays = [batch.column(f.name) for f in kept] + [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.mapInArrow(run, schema)
