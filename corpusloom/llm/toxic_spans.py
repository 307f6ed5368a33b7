"""Toxicity by span tagging: a linear-chain conditional random field tags the words of a text as toxic or not.

Labels come per document. They are brought to the tokens by contrast: a word of a toxic document counts as toxic if the
word, or its beginning or end, is far more frequent in toxic documents than in others. The field is trained on these
labelled tokens. Forward-backward gives each token its probability; the highest one and the sum of the noticeable ones
make the score of the document, on a scale fitted to the same documents, and tokens of at least 0.5 are the spans.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import crf
from corpusloom.llm.pretokens import Remembered, batches
from corpusloom.operators.ranking import sample_n

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TRAIN_DOCS = {1: 600, 0: 2_400}  # bound of the labelled sample by label, with TRAIN_CHARS per document
TRAIN_CHARS = 6_000
BUCKETS = 1 << 18
PREFIXES, SUFFIXES = (3, 4, 5), (3, 4)
LEAST_DOCS, LEAST_SHARE, LEAST_ODDS = 3, 0.015, 4.0  # a telling feature: toxic documents with it, log of the odds ratio
ROUNDS = 40
NOTICEABLE, SPAN = 0.1, 0.5
CLEAN, TOXIC = 0, 1
TOKENS_AT_ONCE = 500_000


def word_features(word: str) -> list[int]:
    """Numbers of the word itself and of its beginnings and ends; the weights are kept by these numbers mod BUCKETS."""
    word = word.lower()
    n, out = len(word), [zlib.crc32(word.encode())]
    for k in PREFIXES:
        if n > k:
            out.append(zlib.crc32(word[:k].encode(), k))
    for k in SUFFIXES:
        if n > k:
            out.append(zlib.crc32(word[-k:].encode(), -k & 0xFF))
    return out


@dataclass
class Tagger:
    field: crf.Model
    scale: np.ndarray  # of a constant, the highest probability and the log of the noticeable sum

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.scale, -500, 500)))


def evidence(toxic: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per document a constant, the highest probability, and log(1 + sum) of those that are at least NOTICEABLE."""
    out = np.zeros((len(lengths), 3))
    out[:, 0] = 1
    ends = np.cumsum(lengths)
    for i, (a, b) in enumerate(zip(ends - lengths, ends, strict=True)):
        if b > a:
            own = toxic[a:b]
            out[i, 1:] = own.max(), np.log1p(own[own >= NOTICEABLE].sum())
    return out


def _fit_scale(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    scale, ridge = np.zeros(x.shape[1]), 0.05 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ scale, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ scale)
        scale = scale + step
        if np.abs(step).max() < 1e-9:
            break
    return scale


def token_labels(kinds: list[list[int]], docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """For each kind of word whether it is telling: label of its tokens in toxic documents."""
    counts = np.array([len(k) for k in kinds])
    every, place = np.unique(np.array([f for k in kinds for f in k]), return_inverse=True)
    parts = np.split(place, np.cumsum(counts)[:-1])
    with_, without = np.zeros(len(every)), np.zeros(len(every))
    for words, label in zip(docs, y, strict=True):
        if len(words):
            seen = np.unique(np.concatenate([parts[k] for k in np.unique(words)]))
            (with_ if label else without)[seen] += 1
    n_toxic, n_clean = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    odds = np.log((with_ + 0.5) / (n_toxic + 1)) - np.log((without + 0.5) / (n_clean + 1))
    telling = (with_ >= max(LEAST_DOCS, LEAST_SHARE * n_toxic)) & (odds >= LEAST_ODDS)
    return np.array([bool(telling[p].any()) for p in parts], bool)


def train_tagger(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "toxic", most: dict[int, int] = TRAIN_DOCS
) -> Tagger:
    """Fit on at most `most[label]` documents, chosen by a hash of their ids, of at most TRAIN_CHARS characters.

    A label other than 0 and 1, or a null id, is no label; of several labels of one id the highest counts. Without
    labelled documents every score is 0.5.
    """
    one = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label).cast("int").alias("_label"))
    chosen = [sample_n(one.where(F.col("_label") == k), most[k], k, id_col) for k in (0, 1)]
    texts = docs.select(id_col, F.coalesce(text, F.lit("")).alias("_text")).where(F.length("_text") <= TRAIN_CHARS)
    rows = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), id_col).select("_label", "_text").collect()
    rows = sorted(set(map(tuple, rows)))
    number: dict[str, int] = {}
    words = [np.array([number.setdefault(w.lower(), len(number)) for w in WORD.findall(t)], np.int64) for _, t in rows]
    kinds, y = [word_features(w) for w in number], np.array([k for k, _ in rows], np.int64)
    if not number:
        return Tagger(crf.Model(np.zeros((BUCKETS, 2)), np.zeros((2, 2))), np.zeros(3))
    lengths = np.array([len(w) for w in words], np.int64)
    tokens = np.concatenate(words)
    tags = (token_labels(kinds, words, y)[tokens] & (np.repeat(y, lengths) == TOXIC)).astype(np.int64)
    features, counts = np.array([f % BUCKETS for k in kinds for f in k], np.int64), np.array([len(k) for k in kinds], np.int64)
    field = crf.train(features, counts, tags, lengths, BUCKETS, rounds=ROUNDS, rate=0.3, penalty=1e-6, rows=tokens)
    toxic = crf.marginals(field.scores(features, counts)[tokens], lengths, field.moves)[:, TOXIC]
    return Tagger(field, _fit_scale(evidence(toxic, lengths), y))


class _Scores(Remembered):
    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.lead = (weights[:, TOXIC] - weights[:, CLEAN]).tolist()

    def compute(self, word: str) -> float:
        return sum([self.lead[f % BUCKETS] for f in word_features(word)])


COLUMNS = "score double, predicted int, toxic_spans array<struct<start:int,end:int,probability:double>>"


def score_documents(docs: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """Adds score, predicted and the toxic spans (character offsets, end exclusive) to every row; needs no shuffle.

    A null or empty text, or one without words, has no span and the score that no evidence gets. Rows and further
    columns stay as they are; columns named like a new one are replaced.
    """
    new = T._parse_datatype_string(COLUMNS).fields
    kept = [f for f in docs.schema.fields if f.name not in {n.name for n in new}]
    schema = T.StructType([*kept, *new])
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
    # the weights are as many as BUCKETS says, whatever the corpus
    sent = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = sent.value
        known = _Scores(tagger.field.weights)
        for batch in rows:
            scores, spans = [], []
            for group in batches(batch.column(text).to_pylist(), lambda t: len(t or ""), 4 * TOKENS_AT_ONCE):
                words = [WORD.findall(t or "") for t in group]
                lengths = np.array([len(w) for w in words], np.int64)
                lead = np.fromiter((known[w] for ws in words for w in ws), np.float64, lengths.sum())
                toxic = crf.marginals_of_two(lead, lengths, tagger.field.moves)
                scores += tagger.score(evidence(toxic, lengths)).tolist()
                ends = np.cumsum(lengths)
                for t, a, b in zip(group, ends - lengths, ends, strict=True):
                    own = toxic[a:b]
                    hit = set(np.flatnonzero(own >= SPAN).tolist())
                    places = enumerate(WORD.finditer(t or "")) if hit else ()
                    spans.append([{"start": m.start(), "end": m.end(), "probability": float(own[i])} for i, m in places if i in hit])
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(spans, span_type)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema)
