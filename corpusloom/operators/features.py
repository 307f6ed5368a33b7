"""Bag-of-words, TF-IDF and n-gram features.

One pass over the corpus yields the term statistics (one shuffle, partial counts per map task). The vocabulary is
bounded by `max_features`, so it can live on the driver; turning documents into vectors is then map-only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, NGram, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SEP = "\x01"


def ngrams(df: DataFrame, col: str = "tokens", longest: int = 1) -> DataFrame:
    """Replace the tokens by all their n-grams for n = 1..longest."""
    parts = [F.col(col)]
    for n in range(2, longest + 1):
        df = NGram(n=n, inputCol=col, outputCol=f"_grams{n}").transform(df)
        parts.append(F.col(f"_grams{n}"))
    return df.withColumn(col, F.concat(*parts)).drop(*[f"_grams{n}" for n in range(2, longest + 1)])


def document_frequency(df: DataFrame, col: str = "tokens") -> DataFrame:
    """term, tf (occurrences) and df (documents); a document's distinct terms are found inside its own row."""
    both = df.select(F.posexplode(F.array(F.col(col), F.array_distinct(col))).alias("_kind", "_terms"))
    terms = both.select("_kind", F.explode("_terms").alias("term"))
    return terms.groupBy("term").agg(F.count_if(F.col("_kind") == 0).alias("tf"), F.count_if(F.col("_kind") == 1).alias("df"))


@dataclass
class Vocabulary:
    """Terms in alphabetical order with their statistics over n_docs documents."""

    terms: list[str]
    tf: list[int]
    df: list[int]
    n_docs: int

    def table(self, spark) -> DataFrame:
        rows = list(zip(range(len(self.terms)), self.terms, self.tf, self.df))
        return spark.createDataFrame(rows, "idx int, term string, tf bigint, df bigint")

    def idf(self) -> list[float]:
        return [math.log((1 + self.n_docs) / (1 + d)) + 1 for d in self.df]


def top_vocabulary(stats: DataFrame, max_features: int) -> DataFrame:
    return stats.orderBy(F.desc("tf"), "term").limit(max_features)


def vocabulary(
    df: DataFrame, col: str = "tokens", max_features: int = 1500, min_df: int = 1, max_df: float = 1.0
) -> Vocabulary:
    """The max_features most frequent terms found in at least min_df and at most a share max_df of the documents."""
    n_docs = df.count()
    stats = document_frequency(df, col).where(F.col("df").between(min_df, max_df * n_docs))
    rows = sorted(top_vocabulary(stats, max_features).collect(), key=lambda r: r.term)
    return Vocabulary([r.term for r in rows], [r.tf for r in rows], [r.df for r in rows], n_docs)


def count_features(df: DataFrame, vocab: Vocabulary, col: str = "tokens", out: str = "features") -> DataFrame:
    """Term counts per document as a sparse vector in vocabulary order."""
    return CountVectorizerModel.from_vocabulary(vocab.terms, inputCol=col, outputCol=out).transform(df)


def tfidf_features(df: DataFrame, vocab: Vocabulary, col: str = "tokens", out: str = "features") -> DataFrame:
    """tf * (ln((1 + n) / (1 + df)) + 1) per term, every row scaled to length 1."""
    counted = count_features(df, vocab, col, "_counts")
    scaling = ElementwiseProduct(scalingVec=Vectors.dense(vocab.idf()), inputCol="_counts", outputCol="_weighted")
    scaled = Normalizer(p=2.0, inputCol="_weighted", outputCol=out).transform(scaling.transform(counted))
    return scaled.drop("_counts", "_weighted")


def ngram_tfidf(
    df: DataFrame, col: str = "tokens", longest: int = 2, max_features: int = 1500
) -> tuple[DataFrame, Vocabulary]:
    """TF-IDF over one vocabulary of all n-grams up to `longest`."""
    grams = ngrams(df, col, longest)
    vocab = vocabulary(grams, col, max_features)
    return tfidf_features(grams, vocab, col), vocab


def long_form(df: DataFrame, vocab: Vocabulary, id_col: str, col: str = "features", out: str = "weight") -> DataFrame:
    """One (document, term, weight) row per non-zero cell of sparse vectors."""
    raw = F.unwrap_udt(col)
    cells = df.select(id_col, F.explode(F.arrays_zip(raw["indices"].alias("i"), raw["values"].alias("v"))).alias("c"))
    terms = F.split(F.lit(_SEP.join(vocab.terms)), _SEP)  # folded to one constant array
    return cells.select(id_col, F.get(terms, F.col("c.i")).alias("term"), F.col("c.v").alias(out))
