"""Scans, article rows, label sheets and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.words import RELATED_TERMS
from corpusloom.operators.ranking import sample_n
from corpusloom.operators.review import review_batch
from corpusloom.operators.storage import load_artifact, save_artifact, scratch_path, settle
from corpusloom.operators.text import clean_tokens, term_counts, word_frequencies
from corpusloom.operators.topics import doc_topic_round, dominant_topic, top_words_per_topic, topic_distribution
from corpusloom.plans import inputs, sql
from corpusloom.plans.registry import query
from corpusloom.sources import articles as art
from corpusloom.sources import labels as lab
from corpusloom.sources import sinks

_WITH_ARTICLES = sql.with_(sql.ARTICLES)
_WITH_NUMBERED = sql.with_(sql.ARTICLES, sql.NUMBERED)


@query("scan_articles", _WITH_ARTICLES + "SELECT paper_id, title, authors, abstract, body FROM articles")
def scan_articles(spark, sf_dir):
    # The articles are stored packed, one document per line, and read back through the JSON scan.
    path = scratch_path(spark, "articles")
    inputs.nested_articles(spark, sf_dir).write.json(path)
    return art.flatten_articles(art.scan_articles(spark, path, one_per_file=False))


@query("scan_article_files", _WITH_ARTICLES + "SELECT paper_id, title, authors, abstract, body FROM articles")
def scan_article_files(spark, sf_dir):
    """The layout of one file per article."""
    path = scratch_path(spark, "article-files")
    inputs.nested_articles(spark, sf_dir).write.option("maxRecordsPerFile", 1).json(path)
    return art.flatten_articles(art.scan_articles(spark, path))


@query("filter_json_files", _WITH_ARTICLES + "SELECT count(*) AS documents FROM articles")
def filter_json_files(spark, sf_dir):
    # The folder holds the articles twice, as .json and as .txt files; the scan has to see the former only.
    path = scratch_path(spark, "mixed")
    nested = inputs.nested_articles(spark, sf_dir)
    nested.write.json(f"{path}/a")
    nested.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{path}/b")
    return art.scan_articles(spark, path, one_per_file=False).agg(F.count("*").alias("documents"))


@query("article_numbering", _WITH_NUMBERED + "SELECT paper_id, paper_number FROM numbered")
def article_numbering(spark, sf_dir):
    rows = inputs.nested_articles(spark, sf_dir).select("paper_id")
    return art.with_dense_index(rows, [F.col("paper_id")], "paper_number")


@query("article_abstract", _WITH_ARTICLES + "SELECT paper_id, abstract FROM articles")
def article_abstract(spark, sf_dir):
    return inputs.articles(spark, sf_dir).select("paper_id", "abstract")


@query("article_authors", _WITH_ARTICLES + "SELECT paper_id, authors FROM articles")
def article_authors(spark, sf_dir):
    return inputs.articles(spark, sf_dir).select("paper_id", "authors")


@query("article_body", _WITH_ARTICLES + "SELECT paper_id, body FROM articles")
def article_body(spark, sf_dir):
    return inputs.articles(spark, sf_dir).select("paper_id", "body")


@query("article_keywords", sql.with_(sql.KEYWORDS) + "SELECT paper_id, seq, keywords FROM keywords")
def article_keywords(spark, sf_dir):
    return art.article_keywords(inputs.nested_articles(spark, sf_dir))


_KEYWORD_TEXTS = "corpus AS (SELECT paper_id || ':' || seq AS paper_number, keywords AS text FROM keywords)"


@query(
    "keyword_cloud",
    sql.with_(sql.KEYWORDS, _KEYWORD_TEXTS, sql.LISTS, sql.TOKENS, sql.KEPT, sql.STEMS, sql.CLEAN).rstrip()
    + f""",
counts AS (SELECT term, count(*) AS n FROM clean WHERE term NOT IN ({sql.STOP}) GROUP BY term)
SELECT term, n, round(n / max(n) OVER (), 6) AS frequency FROM (SELECT * FROM counts ORDER BY n DESC, term LIMIT 200)""",
)
def keyword_cloud(spark, sf_dir):
    """Word-cloud table of the cleaned keyword strings."""
    cloud = word_frequencies(clean_tokens(art.article_keywords(inputs.nested_articles(spark, sf_dir)), "keywords"), top=200)
    return cloud.withColumn("frequency", F.round("frequency", 6))


@query("running_keywords", sql.with_(sql.KEYWORDS) + "SELECT paper_id, seq, keywords FROM keywords")
def running_keywords(spark, sf_dir):
    """The same accumulation from flat paragraph rows."""
    return art.running_keywords(
        inputs.article_turns(spark, sf_dir).where(F.col("role") == "user").select(
            "paper_id", F.col("turn").alias("pos"), "text"
        )
    )


@query("article_metadata", _WITH_NUMBERED + "SELECT paper_id, title, authors, paper_number, 1 AS label FROM numbered")
def article_metadata(spark, sf_dir):
    return art.article_metadata(inputs.articles(spark, sf_dir))


@query(
    "article_lookup",
    _WITH_NUMBERED
    + "SELECT paper_number, paper_id, authors, CASE WHEN abstract <> '' THEN abstract ELSE body END AS text "
    "FROM numbered WHERE paper_number = 42",
)
def article_lookup(spark, sf_dir):
    return art.article_lookup(inputs.nested_articles(spark, sf_dir), 42)


@query("filter_has_abstract", _WITH_ARTICLES + "SELECT paper_id, abstract FROM articles WHERE abstract <> ''")
def filter_has_abstract(spark, sf_dir):
    return art.with_abstract(inputs.articles(spark, sf_dir)).select("paper_id", "abstract")


@query(
    "filter_related_terms",
    _WITH_ARTICLES
    + f"SELECT paper_id, abstract FROM articles WHERE abstract <> '' AND ({sql.RELATED} OR contains(body, 'tion'))",
)
def filter_related_terms(spark, sf_dir):
    # The invented prose never mentions the fixed terms, so one frequent syllable is added to the list.
    found = art.related_abstracts(inputs.articles(spark, sf_dir), [*RELATED_TERMS, "tion"])
    return found.select("paper_id", "abstract")


@query(
    "corpus_counts",
    sql.with_(sql.ARTICLES, sql.KEYWORDS)
    + "SELECT count(*) AS documents, count(*) FILTER (abstract <> '') AS abstracts, "
    "(SELECT count(*) FROM keywords) AS keyword_entries FROM articles",
)
def corpus_counts(spark, sf_dir):
    nested = inputs.nested_articles(spark, sf_dir)
    return art.corpus_counts(art.flatten_articles(nested), art.article_keywords(nested))


_SHEET = sql.with_(sql.LABELS)


@query("read_labels", _SHEET + "SELECT paper_number, label FROM sheet")
def read_labels(spark, sf_dir):
    sheet = inputs.labels(spark, sf_dir).select(
        F.col("paper_number").cast("string").alias("paper_id"), F.lit("").alias("title"), F.lit("").alias("authors"),
        "paper_number", "label",
    )
    path = scratch_path(spark, "sheet")
    sinks.write_csv(sheet, path)
    return lab.read_labels(spark, path)


@query(
    "label_rows_at",
    _SHEET.rstrip()
    + ", rows AS (SELECT *, row_number() OVER (ORDER BY paper_number) AS row_no FROM sheet), "
    "picked AS (SELECT row_no FROM rows ORDER BY md5('positions:' || row_no), row_no LIMIT 200) "
    "SELECT row_no, paper_number, label FROM rows JOIN picked USING (row_no)",
)
def label_rows_at(spark, sf_dir):
    sheet = inputs.labels(spark, sf_dir)
    positions = sample_n(lab.with_row_no(sheet), 200, "positions", "row_no")
    return lab.label_rows_at(sheet, positions)


@query("label_ids", "SELECT DISTINCT doc_id AS paper_number FROM labels")
def label_ids(spark, sf_dir):
    return lab.label_ids(inputs.labels(spark, sf_dir))


@query("distinct_label_ids", "SELECT count(DISTINCT doc_id) AS label_ids FROM labels")
def distinct_label_ids(spark, sf_dir):
    return lab.label_ids(inputs.labels(spark, sf_dir)).agg(F.count("*").alias("label_ids"))


_TOKEN_TEXT = sql.with_(sql.CORPUS, sql.LISTS) + "SELECT paper_number, array_to_string(tokens, ' ') AS tokens FROM lists"


@query("save_artifact", _TOKEN_TEXT)
def save_tokens(spark, sf_dir):
    saved = save_artifact(inputs.tokens(spark, sf_dir), scratch_path(spark, "tokens"))
    return saved.select("paper_number", F.array_join("tokens", " ").alias("tokens"))


@query("load_artifact", _SHEET + "SELECT paper_number, label FROM sheet")
def load_labels(spark, sf_dir):
    path = scratch_path(spark, "labels")
    save_artifact(inputs.labels(spark, sf_dir), path, ["label"])
    return load_artifact(spark, path).select("paper_number", "label")


_FIRST = (
    sql.with_(sql.META)
    + "SELECT paper_id, title, authors, paper_number, label FROM metadata ORDER BY paper_number LIMIT 200"
)


@query("first_n_articles", _FIRST)
def first_n_articles(spark, sf_dir):
    return sinks.first_n_articles(inputs.metadata(spark, sf_dir), 200)


@query("write_label_csv", _FIRST)
def write_label_csv(spark, sf_dir):
    return sinks.write_label_csv(inputs.metadata(spark, sf_dir), scratch_path(spark, "first"), 200)


_FIRST_ARTICLES = (
    _WITH_NUMBERED
    + "SELECT paper_id, title, authors, paper_number, 1 AS label FROM numbered ORDER BY paper_number LIMIT 200"
)


@query("write_label_sheet", _FIRST_ARTICLES)
def write_label_sheet(spark, sf_dir):
    first = inputs.articles(spark, sf_dir).orderBy("paper_id").limit(200)  # numbers follow the ids, so these come first
    return sinks.write_label_csv(art.article_metadata(settle(first)), scratch_path(spark, "sheet"), 200)


@query(
    "write_predictions",
    sql.with_(sql.META, sql.SCORES)
    + "SELECT paper_id, title, authors, paper_number, prediction AS label FROM metadata JOIN scores USING (paper_number)",
)
def write_predictions(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    return sinks.write_predictions(inputs.metadata(spark, sf_dir), inputs.scores(spark, sf_dir), path)


@query(
    "write_review_batch",
    sql.with_(sql.META, sql.LABELS, sql.SCORES, sql.RANKED, sql.BATCH)
    + "SELECT paper_id, title, authors, paper_number, 1 AS label FROM metadata JOIN batch USING (paper_number)",
)
def write_review_batch(spark, sf_dir):
    picked = review_batch(inputs.scores(spark, sf_dir), inputs.labels(spark, sf_dir))
    return sinks.write_review_batch(inputs.metadata(spark, sf_dir), picked, scratch_path(spark, "review"))


@query(
    "write_topic_reports",
    sql.with_(sql.WEIGHTS).rstrip() + """,
top AS (SELECT arg_max(topic, (weight, -topic)) AS t FROM rounded GROUP BY paper_number),
""" + sql.CORPUS + ",\n" + sql.LISTS + ",\n" + sql.TOKENS + """,
words AS (SELECT raw.topic, term, n, row_number() OVER (PARTITION BY raw.topic ORDER BY n DESC, term) AS rank FROM (
  SELECT lang AS topic, term, count(*) AS n FROM tokens JOIN documents ON doc_id = paper_number GROUP BY 1, 2) raw)
SELECT 'doc_topics' AS report, cast(paper_number AS VARCHAR) AS key, cast(topic AS VARCHAR) AS item, cast(weight AS DOUBLE) AS value FROM rounded
UNION ALL SELECT 'topic_distribution', cast(t AS VARCHAR), 'documents', cast(count(*) AS DOUBLE) FROM top GROUP BY t
UNION ALL SELECT 'topic_keywords', topic, term, cast(rank AS DOUBLE) FROM words WHERE rank <= 15""",
)
def write_topic_reports(spark, sf_dir):
    """The three reports as they were written: topics of a fixed weight matrix, and words of the languages."""
    topics, path = inputs.doc_topics(spark, sf_dir), scratch_path(spark, "reports")
    long = doc_topic_round(topics)
    languages = inputs.clusters(spark, sf_dir).withColumnRenamed("cluster", "topic")
    counts = term_counts(inputs.tokens(spark, sf_dir).join(languages, "paper_number"), by=["topic"])
    keywords = top_words_per_topic(counts.withColumnRenamed("n", "weight"))
    sinks.write_topic_reports(long, topic_distribution(dominant_topic(topics)), keywords, path)
    cells = {"doc_topics": ("paper_number", "topic", "weight"), "topic_keywords": ("topic", "term", "rank")}
    parts = [
        load_artifact(spark, f"{path}/{name}").select(
            F.lit(name).alias("report"), F.col(key).cast("string").alias("key"), F.col(item).cast("string").alias("item"),
            F.col(value).cast("double").alias("value"),
        )
        for name, (key, item, value) in cells.items()
    ]
    spread = load_artifact(spark, f"{path}/topic_distribution").select(
        F.lit("topic_distribution").alias("report"), F.col("dominant_topic").cast("string").alias("key"),
        F.lit("documents").alias("item"), F.col("documents").cast("double").alias("value"),
    )
    return parts[0].unionByName(spread).unionByName(parts[1])
