"""Topic and cluster reports over fixed weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import clusters, topics
from corpusloom.operators.text import term_counts
from corpusloom.plans import inputs, sql
from corpusloom.plans.registry import query

_WEIGHTS = sql.with_(sql.WEIGHTS)
_DOMINANT = """dominant AS (SELECT paper_number, cast(min(topic) AS INT) AS dominant_topic FROM rounded r
  WHERE weight = (SELECT max(weight) FROM rounded m WHERE m.paper_number = r.paper_number) GROUP BY paper_number)
"""


@query("doc_topic_round", _WEIGHTS + "SELECT paper_number, cast(topic AS INT) AS topic, weight FROM rounded")
def doc_topic_round(spark, sf_dir):
    return topics.doc_topic_round(inputs.doc_topics(spark, sf_dir))


@query("dominant_topic", _WEIGHTS.rstrip() + ", " + _DOMINANT + "SELECT paper_number, dominant_topic FROM dominant")
def dominant_topic(spark, sf_dir):
    return topics.dominant_topic(inputs.doc_topics(spark, sf_dir))


@query("topic_highlight", _WEIGHTS + "SELECT paper_number, cast(topic AS INT) AS topic, weight, weight > 0.1 AS highlight FROM rounded")
def topic_highlight(spark, sf_dir):
    return topics.topic_highlight(inputs.doc_topics(spark, sf_dir))


@query(
    "topic_distribution",
    _WEIGHTS.rstrip() + ", " + _DOMINANT
    + "SELECT dominant_topic, count(*) AS documents FROM dominant GROUP BY dominant_topic",
)
def topic_distribution(spark, sf_dir):
    return topics.topic_distribution(topics.dominant_topic(inputs.doc_topics(spark, sf_dir)))


@query(
    "grid_results_by_decay",
    r"""WITH results AS (SELECT 10 + 5 * (doc_id % 5) AS k, [0.5, 0.7, 0.9][doc_id % 3 + 1] AS d,
  -len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS score FROM documents)
SELECT cast(k AS INT) AS k, round_even(avg(score) FILTER (d = 0.5), 0) AS decay_0_5,
  round_even(avg(score) FILTER (d = 0.7), 0) AS decay_0_7, round_even(avg(score) FILTER (d = 0.9), 0) AS decay_0_9
FROM results GROUP BY k""",
)
def grid_results_by_decay(spark, sf_dir):
    # Word counts of all documents stand in for the fold scores of a search.
    decays = [0.5, 0.7, 0.9]
    results = inputs.table(spark, sf_dir, "documents").select(
        (10 + 5 * (F.col("doc_id") % 5)).cast("int").alias("k"),
        F.get(F.array(*[F.lit(d) for d in decays]), (F.col("doc_id") % 3).cast("int")).alias("learning_decay"),
        (-F.regexp_count("text", F.lit(r"[\p{L}\p{N}_]+"))).alias("score"),
    )
    return topics.grid_results_by_decay(results, decays)


# Languages as topics, occurrences as weights.
_LANG_WORDS = sql.with_(sql.CORPUS, sql.LISTS, sql.TOKENS).rstrip() + """,
topic_words AS (SELECT lang AS topic, term, count(*) AS weight FROM tokens JOIN documents ON doc_id = paper_number GROUP BY 1, 2),
ranked AS (SELECT *, cast(row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS INT) AS rank FROM topic_words)
"""


def _topic_words(spark, sf_dir):
    clustered = inputs.clusters(spark, sf_dir).withColumnRenamed("cluster", "topic")
    counts = term_counts(inputs.tokens(spark, sf_dir).join(clustered, "paper_number"), by=["topic"])
    return counts.withColumnRenamed("n", "weight")


@query("top_words_per_topic", _LANG_WORDS + "SELECT topic, term, weight, rank FROM ranked WHERE rank <= 15")
def top_words_per_topic(spark, sf_dir):
    return topics.top_words_per_topic(_topic_words(spark, sf_dir))


@query(
    "topic_keyword_pivot",
    _LANG_WORDS
    + "SELECT topic, " + ", ".join(f"max(term) FILTER (rank = {i + 1}) AS word_{i}" for i in range(15))
    + " FROM ranked GROUP BY topic",
)
def topic_keyword_pivot(spark, sf_dir):
    return topics.topic_keyword_pivot(topics.top_words_per_topic(_topic_words(spark, sf_dir)))


_CLUSTER_WORDS = sql.CLEANED.rstrip() + f""",
heads AS (SELECT paper_number, term FROM (SELECT *, row_number() OVER (PARTITION BY paper_number ORDER BY pos) AS place FROM clean)
  WHERE place <= 3000),
counts AS (SELECT lang AS cluster, term, count(*) AS n FROM heads JOIN documents ON doc_id = paper_number
  WHERE term NOT IN ({sql.STOP}) GROUP BY 1, 2),
ranked AS (SELECT *, cast(row_number() OVER (PARTITION BY cluster ORDER BY n DESC, term) AS INT) AS rank FROM counts)
"""


@query(
    "cluster_word_frequencies",
    _CLUSTER_WORDS
    + "SELECT cluster, term, n, rank, round(n / max(n) OVER (PARTITION BY cluster), 6) AS frequency FROM ranked WHERE rank <= 200",
)
def cluster_word_frequencies(spark, sf_dir):
    cloud = clusters.cluster_word_frequencies(inputs.clusters(spark, sf_dir), inputs.cleaned(spark, sf_dir))
    return cloud.withColumn("frequency", F.round("frequency", 6))


@query("top_words_per_cluster", _CLUSTER_WORDS + "SELECT cluster, term, n, rank FROM ranked WHERE rank <= 15")
def top_words_per_cluster(spark, sf_dir):
    cloud = clusters.cluster_word_frequencies(inputs.clusters(spark, sf_dir), inputs.cleaned(spark, sf_dir), top=15)
    return clusters.top_words_per_cluster(cloud)
