"""How the given tables play the parts of the corpus, the label sheet, the articles and the topic weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.storage import spread
from corpusloom.operators.text import clean_tokens, tokenize, vectoriser_tokens
from corpusloom.sources.articles import flatten_articles
from corpusloom.sources.labels import label_sheet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_number"), "text"), "paper_number")


def metadata(spark, sf_dir) -> DataFrame:
    """Label-sheet rows of the corpus, preset to label 1."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("paper_id"),
        F.concat_ws(" ", "source", "lang").alias("title"),
        F.lit("").alias("authors"),
        F.col("doc_id").alias("paper_number"),
        F.lit(1).alias("label"),
    )


def labels(spark, sf_dir) -> DataFrame:
    return spread(label_sheet(table(spark, sf_dir, "labels"), "doc_id", "quality"), "paper_number")


def tokens(spark, sf_dir) -> DataFrame:
    return tokenize(corpus(spark, sf_dir), "text").drop("text")


def cleaned(spark, sf_dir, only: DataFrame | None = None) -> DataFrame:
    """Cleaned tokens, of the documents in `only` if given; those are picked before any text is touched."""
    texts = corpus(spark, sf_dir)
    if only is not None:
        texts = texts.join(only.select("paper_number"), "paper_number", "left_semi")
    return clean_tokens(texts, "text").drop("text")


def vector_input(spark, sf_dir, only: DataFrame | None = None) -> DataFrame:
    """Cleaned tokens as a vectoriser sees them."""
    return vectoriser_tokens(cleaned(spark, sf_dir, only))


def scores(spark, sf_dir) -> DataFrame:
    """A deterministic score with many ties, in place of a fitted model's."""
    score = (F.length("text") % 97 - 48).cast("double")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("paper_number"), score.alias("score"), (score > 0).cast("int").alias("prediction")
    )


def clusters(spark, sf_dir) -> DataFrame:
    """Document languages as cluster ids."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_number"), F.col("lang").alias("cluster"))


def doc_topics(spark, sf_dir) -> DataFrame:
    """Embeddings as a fixed weight matrix."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("paper_number"), F.col("embedding").alias("weights"))


def article_turns(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").withColumn("paper_id", F.col("conv_id").cast("string"))


def nested_articles(spark, sf_dir) -> DataFrame:
    """Conversations as nested articles: system turns are the abstract, the others the body, user turns the keywords.

    One conversation is one article, and an article is one row, as it is one file in the input.
    """
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    grouped = article_turns(spark, sf_dir).groupBy("paper_id").agg(turns.alias("turns"))
    abstract = F.filter("turns", lambda t: t["role"] == "system")
    body = F.filter("turns", lambda t: t["role"] != "system")
    section = lambda t: F.when(t["role"] == "user", F.lit("Keywords")).otherwise(t["role"])
    author = lambda t: F.struct(t["role"].alias("first"), t["turn"].cast("string").alias("last"))
    return grouped.select(
        "paper_id",
        F.struct(
            F.get("turns.text", F.lit(0)).alias("title"),
            F.transform("turns", author).alias("authors"),
        ).alias("metadata"),
        F.when(F.size(abstract) > 0, F.transform(abstract, lambda t: F.struct(t["text"].alias("text")))).alias("abstract"),
        F.transform(body, lambda t: F.struct(t["text"].alias("text"), section(t).alias("section"))).alias("body_text"),
    )


def articles(spark, sf_dir) -> DataFrame:
    return flatten_articles(nested_articles(spark, sf_dir))
