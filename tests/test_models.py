import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from corpusloom.operators import classify, clusters, curves, topics
from corpusloom.operators.evaluate import confusion_metrics, roc_curve
from corpusloom.operators.features import Vocabulary
from corpusloom.plans import model_queries

GRID = [{"kernel": "linear", "C": 0.01}, {"kernel": "linear", "C": 10.0}]


@pytest.fixture(scope="module")
def separable(spark):
    """Label 1 uses feature 0, label 0 uses feature 1; feature 2 is noise."""
    rng = random.Random(7)
    rows = []
    for i in range(120):
        label = int(i % 4 != 0)
        rows.append((i, label, Vectors.sparse(3, {1 - label: 1.0, 2: rng.random() * 0.2})))
    return spark.createDataFrame(rows, ["paper_number", "label", "features"])


def f1(scored):
    return confusion_metrics(scored).first().f1


def test_planted_signal(spark, separable):
    for options in ({"kernel": "linear"}, {"kernel": "rbf", "gamma": 1.0, "n_features": 100}):
        for mode in ("balanced", "count", None):
            model = classify.svm_fit(separable, C=10.0, weight_mode=mode, max_iter=30, **options)
            scored = classify.svm_score(model, separable, ["paper_number", "label"])
            assert f1(scored) == pytest.approx(1.0)
            assert scored.where((F.col("score") > 0) != (F.col("prediction") == 1)).count() == 0


def test_registered_searches_and_curves_are_whole(spark, monkeypatch):
    seen = {}
    call = lambda name, at: lambda *args, **options: seen.update({name: (args[at:], options)}) or 1 / 0
    monkeypatch.setattr(classify, "holdout_evaluation", call("holdout_evaluation", 3))
    monkeypatch.setattr(classify, "active_learning_round", call("active_learning_round", 3))
    monkeypatch.setattr(model_queries, "tfidf", lambda *args, **options: spark.range(1))
    for name in ("holdout_evaluation", "active_learning_round", "learning_curve", "learning_curve_grid"):
        monkeypatch.setattr(curves, "learning_curve", call(name, 3))
        with pytest.raises(ZeroDivisionError):
            getattr(model_queries, name)(spark, "/root/testdata/sf0.001")
    assert len(classify.FULL_GRID) == 42
    assert seen["holdout_evaluation"] == seen["active_learning_round"] == ((classify.FULL_GRID,), {})
    assert seen["learning_curve"] == ((), {"steps": 10, "repeats": 40})
    assert "store" in seen["learning_curve_grid"][1] and seen["learning_curve_grid"][1].pop("store")
    assert seen["learning_curve_grid"] == ((), {"steps": 10, "repeats": 40, "grid": classify.FULL_GRID})


def test_class_weights(separable):
    assert classify.class_weights(separable, "count")[1] == 90.0
    balanced = classify.class_weights(separable, "balanced")
    assert balanced[0] == pytest.approx(2.0) and balanced["total"] == pytest.approx(120.0)


def test_fourier_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(12, 5)) * 0.4
    rows = [(i, Vectors.dense(x) if i % 2 else Vectors.sparse(5, list(range(5)), x)) for i, x in enumerate(data)]
    df = spark.createDataFrame(rows, ["paper_number", "features"])
    mapped = classify.fourier_features(df, 0.5, 5, 4000, seed=3).orderBy("paper_number").collect()
    z = np.array([r.features.toArray() for r in mapped])
    exact = np.exp(-0.5 * ((data[:, None] - data[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < 0.08


def test_folds_are_stratified(separable):
    counts = classify.stratified_folds(separable, 3).groupBy("fold", "label").count().collect()
    assert {(r.fold, r.label): r["count"] for r in counts} == {(f, c): n for f in range(3) for c, n in ((1, 30), (0, 10))}


def test_grid_search_picks_the_best_mean(separable):
    results, model = classify.svm_grid_search(separable, GRID, folds=2, max_iter=15)
    rows = results.collect()
    assert len(rows) == 4
    means = {c: sum(r.f1 for r in rows if r.C == c) / 2 for c in (0.01, 10.0)}
    assert means[model.C] == max(means.values())
    assert f1(classify.svm_score(model, separable, ["paper_number", "label"])) == pytest.approx(1.0)


def test_full_grid_size():
    assert len(classify.FULL_GRID) == 42


def test_holdout_and_active_learning(spark, separable):
    features = separable.select("paper_number", "features")
    sheet = separable.select("paper_number", "label")
    train, test = sheet.where("paper_number < 80"), sheet.where("paper_number >= 80")
    metrics, curve = classify.holdout_evaluation(features, train, test, GRID, folds=2, max_iter=15)
    assert metrics.first().f1 == pytest.approx(1.0)
    assert {(r.fpr, r.tpr) for r in curve.collect()} >= {(0.0, 0.0), (1.0, 1.0)}
    meta = features.select("paper_number", F.lit("t").alias("title"))
    sizes = {"low": 3, "high": 3, "mid": 2}
    predictions, batch = classify.active_learning_round(features, train, meta, GRID, 2, batch=sizes, max_iter=15)
    assert predictions.count() == 120
    picked = batch.collect()
    # the middle of the full corpus (60) lies beyond the 40 unlabelled papers
    assert sorted(r.slice for r in picked) == ["high"] * 3 + ["low"] * 3
    assert all(r.paper_number >= 80 for r in picked)


@pytest.mark.parametrize("grid", [None, GRID[1:]])
def test_learning_curve(separable, grid):
    features = separable.select("paper_number", "features")
    sheet = separable.select("paper_number", "label")
    train, test = sheet.where("paper_number < 90"), sheet.where("paper_number >= 90")
    metrics, scores = curves.learning_curve(
        features, train, test, steps=1, repeats=2, per_class=8, C=10.0, grid=grid, folds=2, max_iter=10
    )
    rows = metrics.collect()
    assert len(rows) == 2 * 2 * 2 * 4  # sizes, repeats, splits, metrics
    assert {r.n_train for r in rows} == {16, 16 + 74}
    assert min(r.value for r in rows) == pytest.approx(1.0)
    last = scores.where("size_idx = 1 and split = 'test'")
    assert last.count() == 30 and roc_curve(last).count() >= 3


@pytest.fixture(scope="module")
def bags(spark):
    """Two topics: documents use either the first or the last three of six terms; one document is empty."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        start = 0 if i % 2 else 3
        rows.append((i, Vectors.sparse(6, {start + j: float(rng.randrange(3, 9)) for j in range(3)})))
    return spark.createDataFrame([*rows, (60, Vectors.sparse(6, {}))], ["paper_number", "features"])


def test_lda(spark, bags, tmp_path):
    model = topics.lda_fit(bags, 2, max_iter=20, seed=1)
    weights = {r.paper_number: r.weights for r in topics.lda_doc_topics(model, bags).collect()}
    assert all(sum(w) == pytest.approx(1.0) for i, w in weights.items() if i < 60)
    vocab = Vocabulary(list("abcdef"), [1] * 6, [1] * 6, 61)
    words = topics.lda_topic_words(model, vocab)
    assert words.count() == 12
    top = {}
    for r in topics.top_words_per_topic(words, 3).collect():
        top.setdefault(r.topic, set()).add(r.term)
    assert sorted(map(sorted, top.values())) == [list("abc"), list("def")]
    sweep = topics.lda_sweep(bags, [2, 3], str(tmp_path / "k"), max_iter=5).collect()
    assert [r.k for r in sweep] == [2, 3] and all(r.perplexity > 1 and r.score < 0 for r in sweep)
    assert spark.read.parquet(str(tmp_path / "k")).groupBy("k").count().count() == 2


def test_lda_grid(bags):
    results, best, chosen = topics.lda_grid_search(bags, [2, 4], [0.5, 0.9], folds=2, max_iter=5)
    rows = results.collect()
    assert len(rows) == 8 and best.spec.k == chosen["k"] and best.counts.shape[1] == 6
    means = {}
    for r in rows:
        means.setdefault((r.k, r.learning_decay), []).append(r.score)
    best_mean = max(sum(v) / 2 for v in means.values())
    assert chosen["score"] == pytest.approx(best_mean)
    wide = topics.grid_results_by_decay(results, [0.5, 0.9])
    assert wide.columns == ["k", "decay_0_5", "decay_0_9"] and wide.count() == 2


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    centres = [(0, 0), (8, 8), (0, 9)]
    rows = [(i, Vectors.dense(rng.normal(centres[i % 3], 0.5))) for i in range(150)]
    return spark.createDataFrame(rows, ["paper_number", "features"])


def test_gmm(spark, blobs):
    fit = clusters.gmm_fit_predict(blobs, 3, seed=2)
    groups = {}
    for r in fit.clusters.collect():
        groups.setdefault(r.cluster, set()).add(r.paper_number % 3)
    assert sorted(map(len, groups.values())) == [1, 1, 1]
    free = 3 * 2 + 3 * 3 + 2
    assert fit.bic == pytest.approx(free * math.log(150) - 2 * fit.log_likelihood)
    assert fit.aic == pytest.approx(2 * free - 2 * fit.log_likelihood)
    assert [r.cluster for r in clusters.gmm_means(fit).orderBy("cluster").collect()] == [0, 1, 2]
    sweep = {r.k: r.bic for r in clusters.gmm_sweep(blobs, [2, 3], seed=2).collect()}
    assert sweep[3] < sweep[2]
    assert clusters.gmm_bic_aic(fit, spark).first().k == 3


def test_dimension_reduction_and_cluster_words(spark, blobs):
    assert len(clusters.reduce_dimensions(blobs, 1).first().features) == 1
    tokens = spark.createDataFrame([(0, ["cell", "cell", "wall"]), (1, ["gene"])], "paper_number bigint, tokens array<string>")
    ids = spark.createDataFrame([(0, 5), (1, 9)], "paper_number bigint, cluster int")
    cloud = clusters.cluster_word_frequencies(ids, tokens)
    top = {r.cluster: r.term for r in clusters.top_words_per_cluster(cloud, 1).collect()}
    assert top == {5: "cell", 9: "gene"}
