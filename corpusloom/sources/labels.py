"""Label sheets: (paper_number, label) rows that people filled in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.ranking import with_dense_index

SHEET_SCHEMA = "paper_id string, title string, authors string, paper_number bigint, label int"

# Quote every value, double embedded quotes and keep blanks, so that any title survives the round trip.
CSV_OPTIONS = {
    "header": True, "quoteAll": True, "escape": '"', "emptyValue": "", "nullValue": "\\N", "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Labels from a CSV sheet with a header row, or from a Parquet table with the same two columns."""
    if path.endswith(".parquet"):
        sheet = spark.read.parquet(path)
    else:
        sheet = spark.read.schema(SHEET_SCHEMA).options(multiLine=True, **CSV_OPTIONS).csv(path)
    return label_sheet(sheet)


def label_sheet(sheet: DataFrame, number: str = "paper_number", label: str = "label") -> DataFrame:
    return sheet.select(F.col(number).cast("bigint").alias("paper_number"), F.col(label).cast("int").alias("label"))


def with_row_no(labels: DataFrame) -> DataFrame:
    """Position in the sheet ordered by paper number, then label; 1-based because row 0 is the header.

    A DataFrame has no order of its own, so the order of lines in a file plays no part.
    """
    return with_dense_index(labels, [F.col("paper_number"), F.col("label")], "_idx").select(
        *labels.columns, (F.col("_idx") + 1).alias("row_no")
    )


def label_rows_at(labels: DataFrame, positions: DataFrame) -> DataFrame:
    """Labels at the given sheet positions (`row_no`), one row per requested position."""
    return with_row_no(labels).join(positions.select("row_no"), "row_no")


def label_ids(labels: DataFrame) -> DataFrame:
    return labels.select("paper_number").distinct()
