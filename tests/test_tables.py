import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import evaluate, many_svms, ranking, review, sampling, topics


def labels(spark, ones=30, zeros=6):
    rows = [(i, 1) for i in range(ones)] + [(ones + i, 0) for i in range(zeros)]
    return spark.createDataFrame(rows, "paper_number bigint, label int")


def test_dense_index_and_totals_match_a_sort(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1.0, 2.0, 3.0]), i, rng.randrange(5)) for i in range(500)]  # one score may hold a third of all rows
    df = spark.createDataFrame(rows, "score double, id int, n int").repartition(7)
    want = {row[1]: place for place, row in enumerate(sorted(rows))}
    got = ranking.with_dense_index(df, [F.col("score"), F.col("id")], "rank").collect()
    assert {r.id: r["rank"] for r in got} == want
    total, sums = 0, {}
    for row in sorted(rows):
        total += row[2]
        sums[row[1]] = total
    got = ranking.with_running_totals(df, [F.col("score"), F.col("id")], {"n": "upto"}).collect()
    assert {r.id: r.upto for r in got} == sums


def test_hash_rank_sample_and_cells(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(300)], "paper_number bigint, label int")
    ranks = sorted(r["rank"] for r in ranking.with_hash_rank(df, "s", "paper_number", "rank").collect())
    assert ranks == list(range(300))
    by = ranking.with_hash_rank(df, "s", "paper_number", "rank", ["label"])
    assert sorted((r.label, r["rank"]) for r in by.collect()) == [(c, i) for c in (0, 1) for i in range(150)]
    first = {r.paper_number for r in by.where("false").unionByName(
        ranking.with_hash_rank(df, "s", "paper_number", "rank").where("rank < 40")).collect()}
    for n, want in ((40, first), (0, set()), (1000, set(range(300)))):
        got = [r.paper_number for r in ranking.sample_n(df, n, "s", "paper_number").collect()]
        assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("rows", [200, 10**6, 10**12])
def test_cell_samples_are_exact(spark, rows):
    df = spark.createDataFrame([(c, i) for c in range(3) for i in range(200)], "cell int, id int")
    df = df.withColumn("h", ranking.hash_order(F.col("cell"), F.col("id")))
    cuts = ranking.cell_cuts(df, ["cell"], "h", {(0,): 0, (1,): 7, (2,): 500}, rows)
    got = [(r.cell, r.id) for r in df.collect() if r.h <= cuts[r.cell,]]
    first = {r.id for r in ranking.sample_n(df.where("cell = 1"), 7, "1", "id").collect()}
    assert {i for c, i in got if c == 1} == first and len(first) == 7
    assert [c for c, _ in got].count(2) == 200 and [c for c, _ in got].count(0) == 0


def test_top_n_beyond_the_group_limit(spark):
    df = spark.createDataFrame([("g", i) for i in range(3000)], "g string, v int")
    got = ranking.top_n_per_group(df, ["g"], [F.desc("v")], 1500)
    assert sorted(r.v for r in got.collect()) == list(range(1500, 3000))


def test_splits_and_dev_sets(spark):
    sheet = labels(spark)
    parts = sampling.label_split(sheet, {"train": 20, "dev": 10, "test": 50}).groupBy("part").count()
    assert {r.part: r["count"] for r in parts.collect()} == {"train": 20, "dev": 10, "test": 6}
    dev = {r.label: r["count"] for r in sampling.balanced_dev_set(sheet, 10).groupBy("label").count().collect()}
    assert dev == {1: 10, 0: 6}  # a class with fewer rows gives all of them
    same = [sorted(map(tuple, sampling.balanced_dev_set(sheet, 4, "x").collect())) for _ in range(2)]
    assert same[0] == same[1]


def test_learning_curve_samples(spark):
    sheet = labels(spark, 40, 20)
    drawn = sampling.incremental_samples(sheet, steps=4, repeats=3, per_class=5)
    counts = {(r.size_idx, r.repeat): r["count"] for r in drawn.groupBy("size_idx", "repeat").count().collect()}
    assert counts == {(k, r): 50 // 4 * k for k in range(1, 5) for r in range(3)}
    train = sampling.union_training(sheet, steps=4, repeats=3, per_class=5)
    sizes = {(r.size_idx, r.repeat): (r.n, r.d) for r in train.groupBy("size_idx", "repeat").agg(
        F.count("*").alias("n"), F.countDistinct("paper_number").alias("d")).collect()}
    assert sizes == {(k, r): (10 + 12 * k,) * 2 for k in range(5) for r in range(3)}
    first, second = ({r.paper_number for r in drawn.where(f"size_idx = 1 and repeat = {i}").collect()} for i in (0, 1))
    assert first != second
    cells = sampling.curve_cells(sheet, steps=4, repeats=30, per_class=5)  # 150 cells: three words of bits
    words = {r.paper_number: r.bits for r in sheet.select("paper_number", cells.bits().alias("bits")).collect()}
    member = many_svms.member_bits([words[i] for i in sorted(words)], 150)
    long = {(r.size_idx * 30 + r.repeat, r.paper_number) for r in sampling.union_training(sheet, 4, 30, 5).collect()}
    assert {(c, i) for i in range(60) for c in range(150) if member[i, c]} == long


def test_holdout_is_unlabelled(spark):
    corpus = spark.range(100).withColumnRenamed("id", "paper_number")
    out = {r.paper_number for r in sampling.holdout_sample(corpus, labels(spark), 50).collect()}
    assert len(out) == 50 and min(out) >= 36


def test_confusion_edges(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "label int, prediction int")
    m = evaluate.confusion_metrics(df).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (0, 0, 2, 1)
    assert (m.precision, m.recall, m.f1) == (0, 0, 0) and m.accuracy == pytest.approx(1 / 3)
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 0), (1, 1)], "label int, prediction int")
    m = evaluate.confusion_metrics(df).first()
    assert (m.precision, m.recall, m.f1) == pytest.approx((2 / 3, 2 / 3, 2 / 3))
    assert evaluate.metrics_long(evaluate.confusion_metrics(df, by=["label"]), ["label"]).count() == 8


def test_roc_and_normalisation(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "label int, score double")
    got = [(round(r.threshold, 6), r.fpr, r.tpr) for r in evaluate.roc_curve(df).orderBy(F.desc("threshold")).collect()]
    assert got == [(1.9, 0, 0), (0.9, 0, 0.5), (0.5, 0.5, 1), (0.1, 1, 1)]
    flat = spark.createDataFrame([(1, 2.0), (0, 2.0)], "label int, score double")
    assert [(r.fpr, r.tpr) for r in evaluate.roc_curve(flat).orderBy("fpr").collect()] == [(0, 0), (1, 1)]
    assert [r.x for r in evaluate.minmax_normalize(flat, "score", "x").collect()] == [None, None]
    assert sorted(r.x for r in evaluate.minmax_normalize(df, "score", "x").collect()) == pytest.approx([0, 0.5, 0.5, 1])


def test_upper_median(spark):
    rows = [(0, "test", "f1", v) for v in (0.1, 0.2, 0.3, 0.4)] + [(1, "test", "f1", v) for v in (3.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "size_idx int, split string, metric string, value double")
    got = {r.size_idx: (r.lo, r.mid, r.hi) for r in evaluate.curve_summary(df).collect()}
    assert got == {0: (0.1, 0.3, 0.4), 1: (1.0, 2.0, 3.0)}


@pytest.mark.parametrize("n, labelled", [(1000, 300), (150, 40)])
def test_review_batch_against_slices(spark, n, labelled):
    scores = [(i, float((i * 37) % 101)) for i in range(n)]
    known = set(range(0, 3 * labelled, 3))
    df = spark.createDataFrame(scores, "paper_number bigint, score double")
    sheet = spark.createDataFrame([(i,) for i in known], "paper_number bigint")
    order = [i for s, i in sorted((s, i) for i, s in scores) if i not in known]
    mid = n // 2
    want = order[:67] + order[-67:] + order[mid : mid + 33] + order[max(mid - 33, 0) : mid]
    assert sorted(r.paper_number for r in review.review_batch(df, sheet).collect()) == sorted(want)
    centred = review.review_batch(df, sheet, low=0, high=0, mid=2, middle="centred").collect()
    half = len(order) // 2
    assert sorted(r.paper_number for r in centred) == sorted(order[half - 2 : half + 2])


def test_topic_tables(spark):
    rows = [(1, [0.125, 0.135, 0.74]), (2, [0.401, 0.404, 0.195]), (3, [0.1, 0.8, 0.1])]
    df = spark.createDataFrame(rows, "paper_number int, weights array<double>")
    long = {(r.paper_number, r.topic): r.weight for r in topics.doc_topic_round(df).collect()}
    assert long[1, 0] == 0.12 and long[1, 1] == 0.14
    dominant = topics.dominant_topic(df)
    assert {r.paper_number: r.dominant_topic for r in dominant.collect()} == {1: 2, 2: 0, 3: 1}
    assert [(r.dominant_topic, r.documents) for r in topics.topic_distribution(dominant).collect()] == [(0, 1), (1, 1), (2, 1)]
    marked = {(r.paper_number, r.topic): r.highlight for r in topics.topic_highlight(df).collect()}
    assert marked[3, 1] and not marked[3, 0]
    words = spark.createDataFrame([(0, "b", 2.0), (0, "a", 2.0), (0, "c", 1.0), (1, "z", 9.0)], "topic int, term string, weight double")
    wide = topics.topic_keyword_pivot(topics.top_words_per_topic(words, 2), 2)
    assert {r.topic: (r.word_0, r.word_1) for r in wide.collect()} == {0: ("a", "b"), 1: ("z", None)}
