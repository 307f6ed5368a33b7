"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, line_chunks, line_quality, prob_minhash, sum_of_squares
from corpusloom.operators.storage import load_artifact, save_artifact, scratch_path
from corpusloom.plans.inputs import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are mostly content."""
    model = line_quality.train_line_model(docs, table(spark, sf_dir, "labels"))
    return line_quality.judge_documents(docs, model).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; n_chars follows the text."""
    left = line_chunks.dedup_lines(docs)
    changed = F.col("n_removed_lines") > 0
    n_chars = F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return left.withColumn("n_chars", n_chars).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return prob_minhash.keep_one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontaminate.contained_items(docs, table(spark, sf_dir, "benchmark"))
    return found.where("n_hit = 0").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 tokens."""
    return sum_of_squares.pack(sum_of_squares.token_pieces(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None  # the field, the sketches and the tokenizer are beyond SQL; tests compare with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save_artifact(stage(spark, docs, sf_dir), scratch_path(spark, f"pipeline-{name}"))
    return docs
