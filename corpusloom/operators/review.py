"""Picking the next documents for manual labelling from a scored corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.ranking import with_dense_index
from corpusloom.operators.storage import settle


def join_features_labels(features: DataFrame, labels: DataFrame, id_col: str = "paper_number") -> DataFrame:
    """Labelled feature rows; the key keeps features and labels together."""
    return features.join(labels, id_col)


def join_predictions_metadata(metadata: DataFrame, predictions: DataFrame, id_col: str = "paper_number") -> DataFrame:
    return metadata.join(predictions, id_col)


def anti_join_labeled(scores: DataFrame, labeled: DataFrame, id_col: str = "paper_number") -> DataFrame:
    return scores.join(labeled.select(id_col), id_col, "left_anti")


def rank_by_score(scores: DataFrame, id_col: str = "paper_number", score: str = "score") -> DataFrame:
    """0-based rank, lowest score first, ties by document number."""
    return with_dense_index(scores, [F.col(score), F.col(id_col)], "rank")


def review_batch(
    scores: DataFrame,
    labeled: DataFrame,
    low: int = 67,
    high: int = 67,
    mid: int = 33,
    middle: str = "reference",
    id_col: str = "paper_number",
) -> DataFrame:
    """Unlabelled documents at the bottom, at the top and around the middle of the ranking.

    The middle is half the size of the full corpus applied to the unlabelled ranking, or with middle="centred" half
    of the unlabelled documents. The slices are concatenated: in a small corpus they overlap and repeat documents.
    """
    rows = settle(anti_join_labeled(scores.select(id_col, "score"), labeled, id_col))
    n = rows.count()
    centre = (scores.count() if middle == "reference" else n) // 2
    up, down = [F.col("score"), F.col(id_col)], [F.desc("score"), F.desc(id_col)]
    nth = lambda order: F.row_number().over(Window.orderBy(*order)).cast("bigint")  # noqa: E731  over the few rows of an end
    ends = [
        rows.orderBy(*up).limit(low).withColumn("rank", nth(up) - 1).withColumn("slice", F.lit("low")),
        rows.orderBy(*down).limit(high).withColumn("rank", n - nth(down)).withColumn("slice", F.lit("high")),
    ]
    around = _ranked_between(rows, n, max(centre - mid, 0), min(centre + mid, n), id_col)
    name = F.when(F.col("rank") >= centre, "mid_up").otherwise("mid_down")
    return ends[0].unionByName(ends[1]).unionByName(around.withColumn("slice", name)).select(id_col, "score", "rank", "slice")


def _ranked_between(rows: DataFrame, n: int, first: int, last: int, id_col: str) -> DataFrame:
    """Rows of ranks first..last-1. Only scores near these ranks are ordered; approximate quantiles say which."""
    spread, lower, upper, below = 0.005, None, None, 0
    if first < last:
        shares = [max(first / n - spread, 0.0), min(last / n + spread, 1.0)]
        lower, upper = rows.approxQuantile("score", shares, spread / 2)
        under = F.coalesce(F.col("score") < lower, F.lit(True))  # null scores come first
        below, inside = rows.agg(F.count_if(under), F.count_if(F.col("score").between(lower, upper))).first()
        if below <= first and below + inside >= last:
            rows = rows.where(F.col("score").between(lower, upper))
        else:
            below = 0
    ranked = rank_by_score(rows if first < last else rows.limit(0), id_col).withColumn("rank", F.col("rank") + below)
    return ranked.where((F.col("rank") >= first) & (F.col("rank") < last))
