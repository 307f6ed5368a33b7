"""The fits that share their scans, against direct computations on small tables."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from corpusloom.functions import special
from corpusloom.functions.kernel import KernelMap, rbf
from corpusloom.operators import artifacts, blocks, classify, clusters, curves, evaluate, many_mixtures, many_svms, many_topics, ranking, sampling, topics
from corpusloom.operators.features import Vocabulary
from corpusloom.operators.many_svms import Entry
from corpusloom.operators.many_topics import Spec, TopicModel
from corpusloom.operators.storage import settle_for_fits


def sparse(x):
    places = np.flatnonzero(x)
    return Vectors.sparse(len(x), places.tolist(), x[places].tolist())


@pytest.fixture(scope="module")
def rows():
    """Noisy labels of a plane in 6 dimensions, folds, and bits of three cells."""
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(90, 6)) * (rng.random((90, 6)) < 0.7), 3)
    y = (x @ rng.normal(size=6) + 0.5 * rng.normal(size=90) > -0.4).astype(int)
    return x, y, np.arange(90) % 3, rng.random((90, 3)) < 0.6


def table(spark, rows):
    x, y, fold, member = rows
    bits = [[int(sum(1 << c for c in range(3) if m[c]))] for m in member]
    data = [(i, sparse(x[i]), int(y[i]), int(fold[i]), bits[i], False) for i in range(len(x))]
    return spark.createDataFrame(data, ["paper_number", "features", "label", "fold", "bits", "test"])


def loss(x, y, weights, C):
    """The objective by its definition, over rows of one training set with balanced weights."""
    share = np.where(y == 1, len(y) / (2 * max(1, y.sum())), len(y) / (2 * max(1, (1 - y).sum())))
    gap = 1 - np.where(y == 1, 1, -1) * (x @ weights[:-1] + weights[-1])
    h = many_svms.SMOOTH
    hinge = np.where(gap <= -h, 0, np.where(gap >= h, gap, (gap + h) ** 2 / (4 * h)))
    return (weights[:-1] ** 2).sum() / (2 * C * share.sum()) + (share * hinge).sum() / share.sum()


ENTRIES = [Entry("linear", C, None, cell, fold) for C in (0.1, 10) for cell in range(3) for fold in (-1, 0, 2)] + [Entry("rbf", 1.0, 0.3, 1, 1)]


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_many_svms_minimise_their_own_loss(spark, rows, monkeypatch, block_rows):
    monkeypatch.setattr(many_svms, "BLOCK_ROWS", block_rows)
    x, y, folds, member = rows
    df = table(spark, rows).repartition(4)
    maps = {0.3: KernelMap.fourier(0.3, 6, 40, 0)}
    held = many_svms.make_blocks(df, [("linear", None), ("rbf", 0.3)], maps, cells=3, folds=3)
    assert (held.blocks == 1) == (block_rows == 4096)
    weights = many_svms.fit_many(held, ENTRIES, max_iter=400)
    counts = many_svms.count_many(held, ENTRIES, weights)
    rng = np.random.default_rng(2)
    for e, w, c in zip(ENTRIES, weights, counts, strict=True):
        mapped = x if e.kernel == "linear" else maps[0.3].apply(x)
        seen = member[:, e.cell] & ((folds != e.fold) | (e.fold == -1))
        assert held.sizes(e) == (int((seen & (y == 0)).sum()), int((seen & (y == 1)).sum()))
        least = loss(mapped[seen], y[seen], w, e.C)
        for step in (1e-1, 1e-2, 1e-3):
            for _ in range(20):
                other = w + step * rng.normal(size=len(w)) * max(1e-2, np.abs(w).max())
                assert loss(mapped[seen], y[seen], other, e.C) > least - 2e-5
        hit = mapped @ w[:-1] + w[-1] > 0
        inside = member[:, e.cell] & (folds == e.fold)
        for place, over in ((many_svms.HELD, inside), (many_svms.SEEN, seen)):
            assert c[place].tolist() == [int((over & a & b).sum()) for a, b in ((y == 1, hit), (y == 0, hit), (y == 1, ~hit), (y == 0, ~hit))]
    held.release()


def test_no_rows_and_one_class(spark, rows):
    df = table(spark, rows)
    held = many_svms.make_blocks(df.where("false"), [("linear", None)], {})
    assert [w.tolist() for w in many_svms.fit_many(held, [Entry("linear", 1.0)])] == [[0.0]]
    none = classify.svm_fit(df.where("false"), kernel="rbf", gamma=1.0)
    assert {(r.score, r.prediction) for r in classify.svm_score(none, df).collect()} == {(0.0, 0)}
    maps = {0.5: KernelMap.fourier(0.5, 0, 5, 0)}
    both = many_svms.make_blocks(df.where("false"), [("linear", None), ("rbf", 0.5)], maps, folds=2)
    f1, (best,), _ = classify.search_cells(both, [{"kernel": "rbf", "gamma": 0.5, "C": 1.0}, {"kernel": "linear", "C": 1.0}], [0], 2, "balanced", 5)
    assert not f1.any() and best.kernel == "rbf"
    model = classify.svm_fit(df.where("label = 1"))
    assert classify.svm_score(model, df).where("prediction = 0").count() == 0


def test_weight_path_ends_where_a_cold_start_does(spark, rows):
    df = table(spark, rows)
    held = many_svms.make_blocks(df, [("linear", None)], {}, cells=3, folds=3)
    grid = [{"kernel": "linear", "C": c} for c in (10.0, 0.01, 1.0)]
    cold, warm = (classify.search_cells(held, grid, [0, 2], 3, "balanced", 400, path=p) for p in (False, True))
    assert np.abs(cold[0] - warm[0]).max() < 0.06 and cold[0].shape == (2, 3, 3)
    assert [e.cell for e in warm[1]] == [0, 2]


def test_curve_continues_from_its_store(spark, rows, tmp_path, monkeypatch):
    df = table(spark, rows)
    features, sheet = df.select("paper_number", "features"), df.select("paper_number", "label")
    train, test = sheet.where("paper_number < 60"), sheet.where("paper_number >= 60")
    options = {"steps": 2, "repeats": 2, "per_class": 8, "grid": [{"kernel": "linear", "C": 1.0}, {"kernel": "linear", "C": 10.0}], "folds": 3, "max_iter": 30, "store": str(tmp_path)}
    monkeypatch.setattr(curves, "UNIT_CELLS", 2)
    first, scores = curves.learning_curve(features, train, test, **options)
    done = []
    old = curves._unit
    monkeypatch.setattr(curves, "_unit", lambda *a: done.append(a[1]) or old(*a))
    again, _ = curves.learning_curve(features, train, test, **options)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect())) and not done
    settings = next(tmp_path.iterdir())
    (settings / "2").rename(settings / "lost")
    again, _ = curves.learning_curve(features, train, test, **options)
    assert done == [[2, 3]] and sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    curves.learning_curve(features, train, test, **{**options, "max_iter": 31})
    assert len(done) == 4  # other settings are other cells
    by = evaluate.roc_curve(scores, by=["size_idx", "split"])
    one = evaluate.roc_curve(scores.where("size_idx = 2 and split = 'test'"))
    assert sorted(map(tuple, by.where("size_idx = 2 and split = 'test'").drop("size_idx", "split").collect())) == sorted(map(tuple, one.collect()))
    assert by.select("size_idx", "split").distinct().count() == 6


def test_grouped_curves_and_middles(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), rng.randrange(2), rng.choice([0.1, 0.2, 0.3, rng.random()])) for _ in range(400)]
    df = spark.createDataFrame(data, "g string, label int, score double").repartition(5)
    by = evaluate.roc_curve(df, by=["g"]).collect()
    for g in ("a", "b", None):
        own = df.where(F.col("g").eqNullSafe(F.lit(g)))
        assert sorted((r.threshold, r.fpr, r.tpr) for r in by if r.g == g) == sorted(map(tuple, evaluate.roc_curve(own).collect()))
    middle = {r.g: r.mid for r in ranking.nth_values(df, ["g"], "score", F.floor(F.col("n") / 2), "mid").collect()}
    for g in ("a", "b", None):
        own = sorted(s for k, _, s in data if k == g)
        assert middle[g] == own[len(own) // 2]
    one = spark.createDataFrame([("x", "m", 5.0)] * 7 + [("y", "m", None)], "split string, metric string, value double").withColumn("size_idx", F.lit(1))
    assert {(r.split, r.lo, r.mid, r.hi) for r in evaluate.curve_summary(one).collect()} == {("x", 5.0, 5.0, 5.0), ("y", None, None, None)}


def test_special_functions():
    x = np.array([1e-3, 0.01, 0.3, 1.0, 2.5, 17.0, 1e4])
    assert np.allclose(special.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)
    step = 1e-6 * x
    slope = (special.log_gamma(x + step) - special.log_gamma(x - step)) / (2 * step)
    assert np.allclose(special.digamma(x), slope, rtol=1e-5)


@pytest.fixture(scope="module")
def bags(spark):
    """Three topics of four words each; documents of one or two topics."""
    rng = np.random.default_rng(4)
    out = []
    for i in range(80):
        words = rng.choice(4, 12) + 4 * rng.choice([i % 3, i % 3, (i + i % 2) % 3], 12)
        out.append((i, i % 2, sparse(np.bincount(words, minlength=12).astype(float))))
    return spark.createDataFrame([*out, (80, 0, Vectors.sparse(12, {}))], ["paper_number", "fold", "features"])


def test_topics_of_many_blocks(bags, monkeypatch):
    specs = [Spec(3, 0.7), Spec(3, 0.5, 1), Spec(6, 0.9, 0)]
    found = []
    for size in (512, 20):
        monkeypatch.setattr(many_topics, "BLOCK_ROWS", size)
        held = many_topics.document_blocks(bags.repartition(3, "paper_number"))
        models = many_topics.fit_topics(held, specs, 20, 1)
        found.append((models, many_topics.topic_scores(held, models)))
        held.release()
    for one, many in zip(*(f[0] for f in found), strict=True):
        assert np.allclose(one.counts, many.counts, rtol=1e-6)
    assert np.allclose(found[0][1], found[1][1], rtol=1e-6)
    assert all(1 < p < 12 and s < 0 for s, p in found[0][1])
    model = found[0][0][0]
    top = sorted(sorted(np.argsort(-row)[:4].tolist()) for row in model.counts)
    assert top == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10, 11]]
    # a model of random topics is told apart
    noise = TopicModel(Spec(3), np.random.default_rng(0).gamma(0.3, 1.0, (3, 12)))
    held = many_topics.document_blocks(bags)
    assert many_topics.topic_scores(held, [noise])[0][1] > many_topics.topic_scores(held, [model])[0][1]
    held.release()


def test_projection_and_bound(bags):
    held = many_topics.document_blocks(bags)
    models = many_topics.fit_topics(held, [Spec(2), Spec(4)], 10, 0)
    scores = many_topics.topic_scores(held, models)
    held.release()
    seen = many_topics.project(bags, models).collect()
    for model, (bound, _) in zip(models, scores, strict=True):
        own = [r for r in seen if r.k == model.spec.k]
        assert len(own) == 81 and sum(r.bound for r in own) + model.bound() == pytest.approx(bound)
        assert all(sum(r.weights) == pytest.approx(1) for r in own if r.tokens) and [r.weights for r in own if not r.tokens] == [[0.0] * model.spec.k]


def normal_log(x, mean, cov):
    gap = x - mean
    return -0.5 * (len(x) * math.log(2 * math.pi) + np.linalg.slogdet(cov)[1] + gap @ np.linalg.solve(cov, gap))


def test_low_rank_density():
    rng = np.random.default_rng(5)
    mixture = many_mixtures.Mixture(np.array([0.3, 0.7]), rng.normal(size=(2, 7)), rng.random((2, 7)) + 0.1, rng.normal(size=(2, 7, 3)))
    x = rng.normal(size=(9, 7))
    logs, _ = many_mixtures.Densities(mixture).of(x, x * x)
    for i in range(9):
        for c in range(2):
            cov = mixture.loadings[c] @ mixture.loadings[c].T + np.diag(mixture.diagonals[c])
            assert logs[i, c] == pytest.approx(math.log(mixture.weights[c]) + normal_log(x[i], mixture.means[c], cov))
    assert mixture.free() == 2 * (7 + 7 + 21 - 3) + 1


def test_wide_mixtures(spark, monkeypatch):
    rng = np.random.default_rng(6)
    data = []
    for i in range(150):
        x = np.zeros(60)
        x[20 * (i % 3) : 20 * (i % 3) + 20] = (rng.random(20) < 0.5) * (1 + rng.random(20))
        data.append((i, sparse(x)))
    df = spark.createDataFrame(data, ["paper_number", "features"]).repartition(3)
    found = []
    for size in (512, 40):
        monkeypatch.setattr(many_mixtures, "BLOCK_ROWS", size)
        sweep = {r.k: r for r in clusters.gmm_sweep(df, [1, 2, 3], rank=1, seed=1).collect()}
        found.append([sweep[k].log_likelihood for k in (1, 2, 3)])
    assert np.allclose(*found, rtol=1e-6) and found[0] == sorted(found[0])
    assert sweep[2].bic == pytest.approx((2 * 180 + 1) * math.log(150) - 2 * sweep[2].log_likelihood)
    fit = clusters.gmm_fit_predict(df, 3, seed=1, rank=1)
    groups = {}
    for r in fit.clusters.collect():
        groups.setdefault(r.cluster, set()).add(r.paper_number % 3)
    assert sorted(map(len, groups.values())) == [1, 1, 1]
    means = {r.cluster: r["mean"].toArray() for r in clusters.gmm_means(fit).collect()}
    for c, own in groups.items():
        start = 20 * next(iter(own))
        assert means[c][start : start + 20].sum() > 0.9 * means[c].sum()
    assert fit.aic == pytest.approx(2 * fit.model.free() - 2 * fit.log_likelihood)


def test_landmark_map(spark, rows):
    x, y, _, _ = rows
    df = table(spark, rows)
    exact = KernelMap.from_landmarks(0.3, np.unique(x, axis=0))
    assert exact.error(x) < 1e-6 and np.allclose(exact.apply(x) @ exact.apply(x).T, rbf(x, x, 0.3), atol=1e-6)
    maps = {how: classify.kernel_maps(df, [0.01, 0.1], how, 60) for how in ("fourier", "landmarks")}
    errors = {how: {r.gamma: r.error for r in classify.kernel_errors(df, m).collect()} for how, m in maps.items()}
    assert all(errors["landmarks"][g] < errors["fourier"][g] for g in (0.01, 0.1))
    f1 = {
        how: evaluate.confusion_metrics(classify.svm_score(classify.svm_fit(df, 10.0, kernel="rbf", gamma=0.3, n_features=60, approximation=how), df, ["label"])).first().f1
        for how in ("fourier", "landmarks")
    }
    assert f1["landmarks"] >= f1["fourier"] - 0.02 > 0.8
    with pytest.raises(ValueError):
        classify.kernel_maps(df, [1.0], "other")


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_kernel_machines_share_their_passes(spark, rows, monkeypatch, block_rows):
    monkeypatch.setattr(many_svms, "BLOCK_ROWS", block_rows)
    df = table(spark, rows)
    maps = classify.kernel_maps(df, [0.3, 0.01], "landmarks", 60)
    alone = [classify.svm_fit(df, 10.0, kernel="rbf", gamma=g, n_features=60, max_iter=12, approximation="landmarks") for g in maps]
    read, sweep = [], many_svms.sweep
    monkeypatch.setattr(many_svms, "sweep", lambda held, blocks, sent, *rest: read.append(len(sent)) or sweep(held, blocks, sent, *rest))
    together = classify.svm_fit_each(df, [Entry("rbf", 10.0, g) for g in maps], maps, max_iter=12)
    for a, b in zip(alone, together, strict=True):
        assert (b.gamma, b.C, b.map) == (a.gamma, 10.0, maps[a.gamma])
        assert np.allclose(a.weights, b.weights, rtol=1e-4, atol=1e-6)
    if block_rows == 16:
        assert len(read) < 2 * 12  # one pass for both


def test_blocks_of_finished_models_are_not_sent(spark, rows, monkeypatch):
    monkeypatch.setattr(many_svms, "BLOCK_ROWS", 16)
    held = many_svms.make_blocks(table(spark, rows), [("linear", None), ("rbf", 0.3)], {0.3: KernelMap.fourier(0.3, 6, 4, 0)}, cells=3, folds=3)
    read = []
    monkeypatch.setattr(many_svms, "sweep", lambda given, blocks, sent, *rest: read.append({r.slice for r in given.select("slice").distinct().collect()}))
    every = set(range(sum(held.slices)))
    for sent in (every, {0}, every - {0}):
        many_svms._pass(held, None, {s: True for s in sent}, 1)
    held.release()
    assert read == [every, {0}, every - {0}]


def test_artifacts_know_what_they_are(spark, rows, tmp_path):
    df = table(spark, rows)
    vocab = Vocabulary(["ä b", "c"], [3, 4], [1, 2], 9)
    rbf_model = classify.svm_fit(df, kernel="rbf", gamma=0.5, n_features=20, approximation="landmarks")
    things = {
        "vocabulary": vocab, "svm": rbf_model, "topics": TopicModel(Spec(2, 0.5), np.arange(6.0).reshape(2, 3)),
        "mixture": many_mixtures.Mixture(np.ones(1), np.ones((1, 3)), np.ones((1, 3)), np.zeros((1, 3, 2)), -3.5, 7),
    }
    for kind, thing in things.items():
        artifacts.save_object(spark, thing, f"{tmp_path}/{kind}")
    back = {kind: artifacts.load_object(spark, f"{tmp_path}/{kind}", kind) for kind in things}
    assert back["vocabulary"] == vocab and (back["topics"].counts == things["topics"].counts).all() and back["topics"].spec == Spec(2, 0.5)
    assert back["mixture"].criteria() == things["mixture"].criteria()
    same = [sorted(map(tuple, classify.svm_score(m, df).collect())) for m in (rbf_model, back["svm"])]
    assert same[0] == same[1]
    artifacts.save_object(spark, Vocabulary([], [], [], 0), f"{tmp_path}/none")
    assert artifacts.load_object(spark, f"{tmp_path}/none") == Vocabulary([], [], [], 0)
    with pytest.raises(artifacts.ArtifactError):
        artifacts.load_object(spark, f"{tmp_path}/svm", "vocabulary")
    artifacts.save_table(df, f"{tmp_path}/vectors", "vectors", {"max_features": 6})
    assert artifacts.load_table(spark, f"{tmp_path}/vectors", "vectors").count() == 90
    assert artifacts.read_manifest(spark, f"{tmp_path}/vectors")["settings"] == {"max_features": 6}
    df.limit(1).write.mode("append").parquet(f"{tmp_path}/vectors/data")
    with pytest.raises(artifacts.ArtifactError):
        artifacts.load_table(spark, f"{tmp_path}/vectors", "vectors")
    with pytest.raises(artifacts.ArtifactError):
        artifacts.save_object(spark, object(), f"{tmp_path}/x")


def test_curve_cells_are_what_the_samples_are(spark):
    sheet = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(300)], "paper_number bigint, label int")
    cells = sampling.curve_cells(sheet, steps=3, repeats=25, per_class=20)
    words = {r.paper_number: r.bits for r in sheet.select("paper_number", cells.bits().alias("bits")).collect()}
    member = many_svms.member_bits([words[i] for i in range(300)], 100)
    assert member.sum(axis=0).tolist() == [40] * 25 + [40 + 86 * k for k in (1, 2, 3) for _ in range(25)]
    dev = sampling.curve_dev_sets(sheet, 3, 25, 20)
    assert dev.count() == 40 * 28


def test_curve_bits_hash_a_row_once_per_cell(spark):
    """An expression inside a lambda is computed for every element of its array."""
    sheet = spark.range(300).selectExpr("id AS paper_number", "cast(id % 3 = 0 AS int) AS label")
    cells = sampling.curve_cells(sheet, 3, 25, 20, "t")
    own = cells.rows.select("paper_number", cells.dev().alias("dev"), cells.drawn().alias("drawn"), cells.bits().alias("bits")).collect()
    for r in own:
        flags = [a or b for a, b in zip(r.dev, r.drawn, strict=True)]
        assert [bool(r.bits[c // many_svms.WORD_BITS] >> c % many_svms.WORD_BITS & 1) for c in range(cells.cells)] == flags
    many = spark.range(1000).selectExpr("id AS paper_number", "cast(id % 3 = 0 AS int) AS label").repartition(4).cache()
    cells = sampling.curve_cells(many, 10, 40, 20, "t")
    begun = time.time()
    many.select(cells.bits()).write.format("noop").mode("overwrite").save()
    assert time.time() - begun < 30  # a minute or more when every word of every row hashed anew


def test_matrix_packs_sparse_and_dense(rows):
    for x in (rows[0], np.zeros((3, 4)), np.ones((2, 5)), np.zeros((0, 4)), np.zeros((4, 0))):
        packed = many_svms.pack_matrix(x)
        assert np.array_equal(many_svms.unpack_matrix(*x.shape, *packed), x.astype(np.float32).astype(np.float64))
    assert len(b"".join(many_svms.pack_matrix(np.eye(50)))) == 8 * 50


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_sweep_sums_the_same_with_and_without_a_shuffle(spark, monkeypatch, most):
    monkeypatch.setattr(blocks, "DRIVER_BYTES", most)
    held = spark.createDataFrame([(s, b, bytes([b, s])) for s in (0, 1) for b in range(9)], "slice int, block long, x binary").repartition(4)
    found = blocks.sweep(held, 9, {0: 1.0, 1: 2.0}, lambda row, f: f * np.frombuffer(row["x"], np.uint8).astype(float), 4)
    assert {s: v.tolist() for s, v in found.items()} == {0: [36.0, 0.0], 1: [72.0, 18.0]}


def test_exp_digamma_is_the_exp_of_digamma():
    x = np.logspace(-2, 6, 500)
    assert np.allclose(special.exp_digamma(x), np.exp(special.digamma(x)), rtol=1e-12, atol=0)


def test_infer_stops_each_document_on_its_own():
    rng = np.random.default_rng(4)
    x, words = rng.poisson(1.0, (40, 12)).astype(float), rng.dirichlet(np.ones(12), 3)
    x[5] = 0
    alone = np.concatenate([many_topics.infer(x[i : i + 1], words, 1 / 3) for i in range(len(x))])
    assert np.allclose(many_topics.infer(x, words, 1 / 3), alone) and many_topics.infer(x[:0], words, 1 / 3).shape == (0, 3)


@pytest.mark.parametrize("how", ["fourier", "landmarks"])
def test_maps_of_one_kind_share_their_base(spark, rows, monkeypatch, how):
    """With many blocks a row is held once for all gammas; the fits are those of the mapped rows."""
    monkeypatch.setattr(many_svms, "BLOCK_ROWS", 4)
    monkeypatch.setattr(many_svms, "TOLERANCE", 1e-9)
    x, y, folds, _ = rows
    df = table(spark, rows).drop("bits").repartition(3).cache()
    maps = classify.kernel_maps(df, [0.3, 0.05, 0.01], how, 30)
    names = [("linear", None), *(("rbf", g) for g in maps)]
    held = many_svms.make_blocks(df, names, maps, folds=3)
    stored = held.rows.select("slice", "block", "n").collect()
    assert held.blocks >= 23 and sorted(sum(r.n for r in stored if r.slice == g) for g in {r.slice for r in stored}) == [90, 90]
    entries = [Entry(kernel, 10.0, gamma, 0, fold) for kernel, gamma in names for fold in (-1, 1)]
    weights = many_svms.fit_many(held, entries, max_iter=200)
    counts = many_svms.count_many(held, entries, weights)
    held.release()
    monkeypatch.setattr(many_svms, "BLOCK_ROWS", 4096)
    whole = many_svms.make_blocks(df, names, maps, folds=3)
    for e, w, c, other in zip(entries, weights, counts, many_svms.fit_many(whole, entries, max_iter=400), strict=True):
        mapped = x if e.kernel == "linear" else maps[e.gamma].apply(x)
        seen = folds != e.fold
        assert loss(mapped[seen], y[seen], w, 10.0) < loss(mapped[seen], y[seen], other, 10.0) + 1e-5
        hit = mapped @ w[:-1] + w[-1] > 0
        assert c[many_svms.SEEN].tolist() == [int((seen & a & b).sum()) for a, b in ((y == 1, hit), (y == 0, hit), (y == 1, ~hit), (y == 0, ~hit))]
    whole.release()


def test_fits_keep_no_second_copy_on_disk(spark):
    held = settle_for_fits(spark.range(5).toDF("i"))
    assert held.storageLevel.useMemory and not held.storageLevel.useDisk and held.count() == 5
    held.unpersist()


def test_models_with_the_same_start_are_inferred_together(bags, monkeypatch):
    """In the first iteration and in the scores of the start a document is inferred once for every size, not once per decay and fold."""
    specs = [Spec(k, d, f) for k in (2, 3) for d in (0.5, 0.9) for f in (0, 1)]
    asked, sweep = [], many_topics.sweep
    monkeypatch.setattr(many_topics, "sweep", lambda held, blocks, sent, work: asked.append((work.__name__, sum(len(m) for m in (g[2] if work.__name__ == "_gather" else g for g in sent.values())))) or sweep(held, blocks, sent, work))
    held = many_topics.document_blocks(bags)
    models = many_topics.fit_topics(held, specs, 2)
    start = many_topics.topic_scores(held, many_topics.first_models(specs, held.n_words, 0))
    assert [n for name, n in asked if name in ("_gather", "_measure")] == [2, 8, 2]
    for spec, model, score in zip(specs, models, start, strict=True):
        alone = many_topics.fit_topics(held, [spec], 2)
        assert np.allclose(model.counts, alone[0].counts, rtol=1e-9)
        assert np.allclose(score, many_topics.topic_scores(held, many_topics.first_models([spec], held.n_words, 0))[0], rtol=1e-9)
    held.release()


def test_sweep_tells_the_documents_from_the_topics(bags, tmp_path):
    """Of few documents the topics' part of the bound outweighs the rest. Without it fitted topics beat equal words, and topics at their start do not."""
    few = bags.where("paper_number < 12")
    start, fitted = (topics.lda_sweep(few, [6, 12], str(tmp_path / str(n)), max_iter=n).collect() for n in (0, 40))
    assert all(1 < r.given_topics < 12 and r.given_topics < r.perplexity for r in fitted) and fitted[1].perplexity > 12
    assert all(r.given_topics > 12 for r in start)
