"""Nested article documents and the flat tables made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.words import mentions_any
from corpusloom.operators.ranking import with_dense_index

_PARAGRAPH = T.StructType([T.StructField("text", T.StringType()), T.StructField("section", T.StringType())])
_AUTHOR = T.StructType([T.StructField("first", T.StringType()), T.StructField("last", T.StringType())])

# Only the fields that are read; the parser skips everything else.
ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("paper_id", T.StringType()),
        T.StructField(
            "metadata",
            T.StructType([T.StructField("title", T.StringType()), T.StructField("authors", T.ArrayType(_AUTHOR))]),
        ),
        T.StructField("abstract", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))),
        T.StructField("body_text", T.ArrayType(_PARAGRAPH)),
    ]
)


def scan_articles(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """All `*.json` articles below a folder, one document per file or, packed, one document per line.

    Packed files split and batch far better; a corpus of many millions of articles should be stored that way.
    """
    return (
        spark.read.schema(ARTICLE_SCHEMA)
        .option("multiLine", one_per_file)
        .option("mode", "FAILFAST")  # a broken file is an error, not an article of nulls
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(path)
    )


def abstract_text() -> Column:
    return F.coalesce(F.array_join(F.col("abstract.text"), " "), F.lit(""))


def body_text() -> Column:
    """Body paragraphs, a space, then the abstract: the space stays when there is no abstract."""
    return F.concat(F.coalesce(F.array_join(F.col("body_text.text"), " "), F.lit("")), F.lit(" "), abstract_text())


def all_authors() -> Column:
    """"First Last, First Last"."""
    names = F.transform("metadata.authors", lambda a: F.concat_ws(" ", a["first"], a["last"]))
    return F.coalesce(F.array_join(names, ", "), F.lit(""))


def author_names() -> Column:
    """The authors as the article table has them: an article without body paragraphs reports none."""
    return F.when(F.size("body_text") > 0, all_authors()).otherwise("")


def flatten_articles(nested: DataFrame) -> DataFrame:
    """One flat row per article: paper_id, title, authors, abstract, body."""
    return nested.select(
        "paper_id",
        F.coalesce("metadata.title", F.lit("")).alias("title"),
        author_names().alias("authors"),
        abstract_text().alias("abstract"),
        body_text().alias("body"),
    )


def article_keywords(nested: DataFrame) -> DataFrame:
    """Text of the sections named "Keywords", accumulated within the article: sections a, b give rows a, ab."""
    texts = F.filter("body_text", lambda p: p["section"] == "Keywords")["text"]
    return (
        nested.select("paper_id", texts.alias("_texts"))
        .where(F.size("_texts") > 0)
        .select("paper_id", "_texts", F.posexplode("_texts").alias("seq", "_text"))
        .select("paper_id", "seq", F.array_join(F.slice("_texts", 1, F.col("seq") + 1), "").alias("keywords"))
    )


def number_articles(articles: DataFrame, key: str = "paper_id") -> DataFrame:
    """Add paper_number: the consecutive 0-based rank of the article by its key."""
    numbers = with_dense_index(articles.select(key), [F.col(key)], "paper_number")
    return articles.join(numbers, key)


def article_metadata(articles: DataFrame) -> DataFrame:
    """Label-sheet row of every article, preset to label 1."""
    rows = articles.select("paper_id", "title", "authors")
    return with_dense_index(rows, [F.col("paper_id")], "paper_number").withColumn("label", F.lit(1))


def article_lookup(nested: DataFrame, paper_number: int) -> DataFrame:
    """Authors and abstract of one article, or its body where there is no abstract."""
    keys = with_dense_index(nested.select("paper_id"), [F.col("paper_id")], "paper_number")
    found = keys.where(F.col("paper_number") == paper_number)
    text = F.when(abstract_text() != "", abstract_text()).otherwise(body_text())
    return nested.join(F.broadcast(found), "paper_id").select(
        "paper_number", "paper_id", all_authors().alias("authors"), text.alias("text")
    )


def with_abstract(articles: DataFrame) -> DataFrame:
    return articles.where(F.col("abstract") != "")


def related_abstracts(articles: DataFrame, terms: list[str]) -> DataFrame:
    """Articles that have an abstract and mention any of the terms."""
    return with_abstract(articles).where(mentions_any(F.col("body"), terms))


def corpus_counts(articles: DataFrame, keywords: DataFrame) -> DataFrame:
    """Number of documents, abstracts and keyword entries."""
    docs = articles.agg(
        F.count("*").alias("documents"),
        F.count_if(F.col("abstract") != "").alias("abstracts"),
    )
    return docs.withColumn("keyword_entries", keywords.agg(F.count("*")).scalar())


def running_keywords(paragraphs: DataFrame) -> DataFrame:
    """article_keywords from flat (paper_id, pos, text) keyword paragraphs."""
    upto = Window.partitionBy("paper_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return paragraphs.select(
        "paper_id",
        (F.count("*").over(upto) - 1).cast("int").alias("seq"),
        F.array_join(F.collect_list("text").over(upto), "").alias("keywords"),
    )
