"""Writers. Each takes a target path and returns the written rows as read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.labels import CSV_OPTIONS, SHEET_SCHEMA

SHEET_COLUMNS = ["paper_id", "title", "authors", "paper_number", "label"]
def write_csv(df: DataFrame, path: str) -> DataFrame:
    """A sheet for people; titles may hold line breaks, so a file is read as a whole."""
    df.write.options(**CSV_OPTIONS).csv(path)
    return df.sparkSession.read.schema(df.schema).options(multiLine=True, **CSV_OPTIONS).csv(path)


def first_n_articles(metadata: DataFrame, n: int = 200) -> DataFrame:
    return metadata.select(*SHEET_COLUMNS).orderBy("paper_number").limit(n)


def write_label_csv(metadata: DataFrame, path: str, n: int = 200) -> DataFrame:
    """Sheet with the first n articles for a person to label."""
    return write_csv(first_n_articles(metadata, n), path)


def write_predictions(metadata: DataFrame, predictions: DataFrame, path: str) -> DataFrame:
    """All articles with the predicted label in place of the preset one."""
    predicted = predictions.select("paper_number", F.col("prediction").cast("int").alias("label"))
    rows = metadata.drop("label").join(predicted, "paper_number").select(*SHEET_COLUMNS)
    rows.write.parquet(path)
    return metadata.sparkSession.read.schema(SHEET_SCHEMA).parquet(path)


def write_review_batch(metadata: DataFrame, selected: DataFrame, path: str) -> DataFrame:
    """Sheet rows of the selected articles, label preset to 1; a paper selected twice is written twice."""
    rows = metadata.drop("label").join(selected.select("paper_number"), "paper_number")
    return write_csv(rows.withColumn("label", F.lit(1)).select(*SHEET_COLUMNS), path)


def write_topic_reports(doc_topics: DataFrame, distribution: DataFrame, keywords: DataFrame, path: str) -> DataFrame:
    """The three topic reports as Parquet tables below `path`, and how many rows each one holds."""
    spark = doc_topics.sparkSession
    tables = {"doc_topics": doc_topics, "topic_distribution": distribution, "topic_keywords": keywords}
    written = None
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}")
        rows = spark.read.parquet(f"{path}/{name}").agg(F.count("*").alias("rows"))
        rows = rows.select(F.lit(name).alias("report"), "rows")
        written = rows if written is None else written.unionByName(rows)
    return written
