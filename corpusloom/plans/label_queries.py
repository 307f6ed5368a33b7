"""Joins, samples, set operations and metrics over labels and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import evaluate, review, sampling
from corpusloom.operators.text import word_count
from corpusloom.plans import inputs, sql
from corpusloom.plans.registry import query

_SHEET = sql.with_(sql.LABELS)
_SCORED = sql.with_(sql.LABELS, sql.SCORES)
_WORDS = r"(SELECT doc_id AS paper_number, len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS n_words FROM documents)"


@query("join_features_labels", _SHEET + f"SELECT paper_number, n_words, label FROM {_WORDS} JOIN sheet USING (paper_number)")
def join_features_labels(spark, sf_dir):
    words = word_count(inputs.corpus(spark, sf_dir), "text").drop("text")
    return review.join_features_labels(words, inputs.labels(spark, sf_dir))


@query(
    "anti_join_labeled",
    _SCORED + "SELECT paper_number, score FROM scores WHERE paper_number NOT IN (SELECT paper_number FROM sheet)",
)
def anti_join_labeled(spark, sf_dir):
    scores = inputs.scores(spark, sf_dir).select("paper_number", "score")
    return review.anti_join_labeled(scores, inputs.labels(spark, sf_dir))


@query(
    "join_predictions_metadata",
    sql.with_(sql.META, sql.SCORES)
    + "SELECT paper_number, paper_id, title, score, prediction FROM metadata JOIN scores USING (paper_number)",
)
def join_predictions_metadata(spark, sf_dir):
    meta = inputs.metadata(spark, sf_dir).select("paper_number", "paper_id", "title")
    return review.join_predictions_metadata(meta, inputs.scores(spark, sf_dir))


@query("class_counts", _SHEET + "SELECT label, count(*) AS n FROM sheet GROUP BY label")
def class_counts(spark, sf_dir):
    return evaluate.class_counts(inputs.labels(spark, sf_dir))


@query("score_range", sql.with_(sql.SCORES) + "SELECT min(score) AS lo, max(score) AS hi FROM scores")
def score_range(spark, sf_dir):
    return evaluate.score_range(inputs.scores(spark, sf_dir))


@query(
    "minmax_normalize",
    sql.with_(sql.SCORES)
    + "SELECT paper_number, round((score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()), 6) AS normalized FROM scores",
)
def minmax_normalize(spark, sf_dir):
    scaled = evaluate.minmax_normalize(inputs.scores(spark, sf_dir), "score", "normalized")
    return scaled.select("paper_number", F.round("normalized", 6).alias("normalized"))


@query(
    "confusion_metrics",
    _SCORED
    + """, joined AS (SELECT lang, label, prediction FROM sheet JOIN scores USING (paper_number) JOIN documents ON doc_id = paper_number),
cells AS (SELECT lang, count(*) AS n, count(*) FILTER (label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn,
  count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM joined GROUP BY lang)
SELECT *, round((tp + tn) / n, 6) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM cells""",
)
def confusion_metrics(spark, sf_dir):
    lang = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_number"), "lang")
    rows = inputs.labels(spark, sf_dir).join(inputs.scores(spark, sf_dir), "paper_number").join(lang, "paper_number")
    metrics = evaluate.confusion_metrics(rows, by=["lang"])
    return metrics.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")})


@query(
    "roc_curve",
    _SCORED
    + """, points AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label <> 1) AS n
  FROM sheet JOIN scores USING (paper_number) GROUP BY score),
curve AS (SELECT score AS threshold, sum(p) OVER w AS tps, sum(n) OVER w AS fps FROM points
  WINDOW w AS (ORDER BY score DESC) UNION ALL SELECT max(score) + 1, 0, 0 FROM points)
SELECT threshold, round(fps / (SELECT sum(n) FROM points), 6) AS fpr, round(tps / (SELECT sum(p) FROM points), 6) AS tpr FROM curve""",
)
def roc_curve(spark, sf_dir):
    rows = inputs.labels(spark, sf_dir).join(inputs.scores(spark, sf_dir), "paper_number")
    return evaluate.roc_curve(rows).withColumns({c: F.round(c, 6) for c in ("fpr", "tpr")})


@query(
    "curve_summary",
    f"""SELECT doc_id % 11 AS size_idx, lang AS split, 'words' AS metric, min(n_words) AS lo,
  cast(list_sort(list(n_words))[count(*) // 2 + 1] AS DOUBLE) AS mid, max(n_words) AS hi
FROM documents JOIN {_WORDS} ON paper_number = doc_id GROUP BY 1, 2""",
)
def curve_summary(spark, sf_dir):
    docs = word_count(inputs.table(spark, sf_dir, "documents"), "text")
    values = docs.select(
        (F.col("doc_id") % 11).alias("size_idx"), F.col("lang").alias("split"), F.lit("words").alias("metric"),
        F.col("n_words").alias("value"),
    )
    return evaluate.curve_summary(values)


@query("rank_by_score", sql.with_(sql.SCORES) + "SELECT paper_number, score, row_number() OVER (ORDER BY score, paper_number) - 1 AS rank FROM scores")
def rank_by_score(spark, sf_dir):
    return review.rank_by_score(inputs.scores(spark, sf_dir).select("paper_number", "score"))


_BATCH = sql.with_(sql.LABELS, sql.SCORES, sql.RANKED, sql.BATCH)


@query("review_batch", _BATCH + "SELECT paper_number, score, rank, slice FROM batch")
def review_batch(spark, sf_dir):
    return review.review_batch(inputs.scores(spark, sf_dir), inputs.labels(spark, sf_dir))


@query("union_review_slices", _BATCH + "SELECT slice, count(*) AS n, min(rank) AS first_rank, max(rank) AS last_rank FROM batch GROUP BY slice")
def union_review_slices(spark, sf_dir):
    picked = review.review_batch(inputs.scores(spark, sf_dir), inputs.labels(spark, sf_dir))
    return picked.groupBy("slice").agg(
        F.count("*").alias("n"), F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank")
    )


@query("shuffle_subset", "SELECT doc_id AS paper_number FROM documents ORDER BY md5('subset:' || doc_id), doc_id LIMIT 10000")
def shuffle_subset(spark, sf_dir):
    return sampling.shuffle_subset(inputs.corpus(spark, sf_dir).select("paper_number"))


@query(
    "holdout_sample",
    "SELECT doc_id AS paper_number FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) "
    "ORDER BY md5('holdout:' || doc_id), doc_id LIMIT 200",
)
def holdout_sample(spark, sf_dir):
    return sampling.holdout_sample(inputs.corpus(spark, sf_dir).select("paper_number"), inputs.labels(spark, sf_dir))


@query("except_labeled", "SELECT doc_id AS paper_number FROM documents EXCEPT SELECT doc_id FROM labels")
def except_labeled(spark, sf_dir):
    return sampling.except_labeled(inputs.corpus(spark, sf_dir).select("paper_number"), inputs.labels(spark, sf_dir))


@query(
    "label_split",
    _SHEET
    + """, ranked AS (SELECT *, row_number() OVER (ORDER BY md5('split:' || paper_number), paper_number) AS rn FROM sheet)
SELECT paper_number, label, CASE WHEN rn <= 2500 THEN 'train' WHEN rn <= 3000 THEN 'dev' ELSE 'test' END AS part
FROM ranked WHERE rn <= 3200""",
)
def label_split(spark, sf_dir):
    return sampling.label_split(inputs.labels(spark, sf_dir), {"train": 2500, "dev": 500, "test": 200})


@query(
    "balanced_dev_set",
    _SHEET
    + "SELECT paper_number, label FROM (SELECT *, row_number() OVER (PARTITION BY label "
    "ORDER BY md5('dev:' || paper_number), paper_number) AS rn FROM sheet) WHERE rn <= 100",
)
def balanced_dev_set(spark, sf_dir):
    return sampling.balanced_dev_set(inputs.labels(spark, sf_dir), 100)


_CURVE = sql.with_(sql.LABELS, sql.curve_cells(10, 40, 100, "curve"))


@query("incremental_samples", _CURVE + "SELECT size_idx, repeat, paper_number, label FROM drawn")
def incremental_samples(spark, sf_dir):
    drawn = sampling.incremental_samples(inputs.labels(spark, sf_dir), 10, 40, 100, "curve")
    return drawn.select("size_idx", "repeat", "paper_number", "label")


@query(
    "union_training",
    _CURVE
    + "SELECT size_idx, repeat, paper_number, label FROM dev WHERE size_idx = 0 UNION ALL "
    "SELECT size_idx, r.repeat, paper_number, label FROM dev, (SELECT cast(unnest(range(0, 40)) AS INT) AS repeat) r WHERE size_idx > 0 "
    "UNION ALL SELECT size_idx, repeat, paper_number, label FROM drawn",
)
def union_training(spark, sf_dir):
    return sampling.union_training(inputs.labels(spark, sf_dir), 10, 40, 100, "curve")
