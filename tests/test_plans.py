"""The physical plans keep the properties the operators are built on."""

import re

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import evaluate, features, ranking, review, sampling, storage, text
from corpusloom.plans import inputs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"(?<!Broadcast)Exchange (?!.*REPARTITION_BY_NUM)", plan(df)))


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_number"), "text")


def test_cleaning_and_vectors_are_map_only(docs):
    clean = text.clean_tokens(docs, "text")
    assert shuffles(clean) == 0
    seen = text.vectoriser_tokens(clean)
    vocab = features.vocabulary(seen, max_features=50)
    cells = features.long_form(features.tfidf_features(seen, vocab), vocab, "paper_number")
    assert shuffles(cells) == 0
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(cells)


def test_one_shuffle_per_term_statistic(docs):
    tokens = text.tokenize(docs, "text")
    stats = features.document_frequency(tokens)
    assert shuffles(stats) == 1
    assert "partial_count" in plan(stats)
    assert "TakeOrderedAndProject" in plan(text.top_terms(text.term_counts(tokens), 10))


def test_tokens_are_computed_once(spark, docs):
    tokens = text.tokenize(docs, "text").select("paper_number", "tokens")
    vocab = spark.createDataFrame([("the",)], "term string")
    for df in (text.term_counts(tokens), text.word_frequencies(tokens), features.document_frequency(tokens),
               text.within_token_budget(tokens), text.vocab_filter(tokens, vocab, "paper_number")):
        assert plan(df).count("regexp_extract_all") == 1
    stems = text.clean_tokens(docs, "text").select("paper_number", "tokens")
    clusters = docs.select("paper_number", (F.col("paper_number") % 3).alias("cluster"))
    words = text.group_word_frequencies(text.cluster_tokens(clusters, stems, "paper_number"), "cluster")
    for df in (text.term_counts(stems), features.document_frequency(text.vectoriser_tokens(stems)), words):
        assert plan(df).count("ArrowEvalPython") == 1 and plan(df).count("regexp_extract_all") == 1


def test_groups_are_cut_before_the_shuffle(spark, sf_dir, docs):
    dev = sampling.balanced_dev_set(inputs.labels(spark, sf_dir), 10)
    assert plan(dev).count("WindowGroupLimit") == 2
    words = text.tokenize(docs, "text").withColumn("cluster", F.col("paper_number") % 3)
    assert plan(text.group_word_frequencies(words, "cluster", top=20)).count("WindowGroupLimit") == 2


def test_no_cross_joins_and_no_single_task_sort(spark, sf_dir):
    scores = inputs.scores(spark, sf_dir)
    ranked = ranking.with_dense_index(scores, [F.col("score"), F.col("paper_number")], "rank")
    scaled = evaluate.minmax_normalize(scores, "score", "x")
    sample = sampling.holdout_sample(scores.select("paper_number"), inputs.labels(spark, sf_dir), 50)
    for df in (ranked, scaled, sample):
        assert "Cartesian" not in plan(df) and "BroadcastNestedLoopJoin" not in plan(df)
    assert "SinglePartition" not in plan(sample)


def test_wide_scans_are_not_repartitioned(spark):
    few, many = spark.range(0, 100, 1, 2), spark.range(0, 100, 1, 64)
    assert "REPARTITION_BY_NUM" in plan(storage.spread(few, "id"))
    assert "Exchange" not in plan(storage.spread(many, "id"))


def test_no_job_and_no_single_task_behind_a_label_join(spark, sf_dir):
    labels, scores = inputs.labels(spark, sf_dir), inputs.scores(spark, sf_dir)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    joined = [review.join_features_labels(scores, labels), review.anti_join_labeled(scores, labels), sampling.except_labeled(scores, labels)]
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert not any("SinglePartition" in plan(df) for df in joined)


def test_checkpoint_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert storage.scratch_path(spark, "x").startswith((folder or storage.shared_folder(spark)).rstrip("/"))
