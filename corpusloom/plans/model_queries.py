"""Fitted models over the given tables, at the settings of the reference unless a comment says otherwise.

Scores depend on the last digits of an optimiser, so each fit has two queries. One returns the numbers: scores, F1, topic weights,
criteria, clusters. The other returns what must hold of them for every row: which rows there are, whether the numbers fit
together, and whether the model is better than the trivial one. The SQL beside it has the same rows from the tables alone.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corpusloom.operators import artifacts, classify, clusters, curves, evaluate, features, review, sampling, topics
from corpusloom.operators.storage import load_artifact, scratch_path, settle, shared_folder
from corpusloom.plans import inputs, sql
from corpusloom.plans.registry import query
from corpusloom.sources import sinks

CURVE_STEPS, CURVE_REPEATS = 10, 40
LDA_KS, LDA_DECAYS, LDA_FOLDS = [10, 15, 20, 25, 30], [0.5, 0.7, 0.9], 5
SWEEP_KS = list(range(20, 106, 5))
GMM_KS = list(range(2, 31))


def tfidf(spark, sf_dir, max_features=1500, only=None):
    """TF-IDF vectors of the corpus, cleaned once. With `only`, just those documents are vectorised."""
    seen = settle(inputs.vector_input(spark, sf_dir))
    vocab = features.vocabulary(seen, max_features=max_features)
    rows = seen if only is None else seen.join(only.select("paper_number"), "paper_number", "left_semi")
    return features.tfidf_features(rows, vocab).select("paper_number", "features")


def counts(spark, sf_dir):
    seen = settle(inputs.vector_input(spark, sf_dir))
    vocab = features.vocabulary(seen, max_features=100, min_df=2, max_df=0.95)
    return settle(features.count_features(seen, vocab).select("paper_number", "features")), vocab


def _labelled(spark, sf_dir):
    labels = inputs.labels(spark, sf_dir)
    return review.join_features_labels(tfidf(spark, sf_dir, only=labels), labels)


def _agrees():
    return ((F.col("score") > 0).cast("int") == F.col("prediction")).alias("sign_agrees")


def _beats_zero(scored):
    """Whether the hinge loss, averaged per label and then over the labels, is below the 1 that weights of zero have."""
    margin = F.col("score") * F.when(F.col("label") == 1, 1).otherwise(-1)
    loss = scored.groupBy("label").agg(F.avg(F.greatest(1 - margin, F.lit(0.0))).alias("loss")).agg(F.avg("loss") < 1)
    return loss.scalar().alias("beats_zero")


_SHEET = sql.with_(sql.LABELS)
_FITTED = _SHEET + "SELECT paper_number, label, true AS sign_agrees, true AS beats_zero FROM sheet"


def _fitted(spark, sf_dir, **options):
    train = settle(_labelled(spark, sf_dir))
    scored = settle(classify.svm_score(classify.svm_fit(train, **options), train, ["paper_number", "label"]))
    return scored.select("paper_number", "label", _agrees(), _beats_zero(scored))


@query("svm_fit_linear", _FITTED)
def svm_fit_linear(spark, sf_dir):
    return _fitted(spark, sf_dir)


@query("svm_fit_rbf", _FITTED)
def svm_fit_rbf(spark, sf_dir):
    return _fitted(spark, sf_dir, kernel="rbf", gamma=1.0)


_GRID_ROWS = ", ".join(
    f"('{e['kernel']}', {float(e['C'])}::DOUBLE, {float(e['gamma']) if e.get('gamma') else 'NULL'}::DOUBLE)" for e in classify.FULL_GRID
)


def _searched(spark, sf_dir):
    return classify.svm_grid_search(_labelled(spark, sf_dir))[0]


@query(
    "svm_grid_search",
    f"SELECT kernel, C, gamma, cast(fold AS INT) AS fold, true AS f1_in_range FROM (VALUES {_GRID_ROWS}) g(kernel, C, gamma), "
    "range(0, 5) r(fold) WHERE EXISTS (SELECT 1 FROM labels)",
)
def svm_grid_search(spark, sf_dir):
    return _searched(spark, sf_dir).select("kernel", "C", "gamma", "fold", F.col("f1").between(0, 1).alias("f1_in_range"))


@query("svm_grid_scores")
def svm_grid_scores(spark, sf_dir):
    """F1 of every entry and fold, and the mean of the entry."""
    found = _searched(spark, sf_dir)
    means = found.groupBy("kernel", "C", "gamma").agg(F.avg("f1").alias("mean_f1")).withColumnsRenamed({c: f"_{c}" for c in ("kernel", "C", "gamma")})
    same = (found["kernel"] == means["_kernel"]) & (found["C"] == means["_C"]) & found["gamma"].eqNullSafe(means["_gamma"])
    return found.join(F.broadcast(means), same).select("kernel", "C", "gamma", "fold", "f1", "mean_f1")


def _scored_corpus(spark, sf_dir):
    corpus = settle(tfidf(spark, sf_dir))
    model = classify.svm_fit(review.join_features_labels(corpus, inputs.labels(spark, sf_dir)))
    return classify.svm_score(model, corpus)


@query("svm_score_corpus", "SELECT doc_id AS paper_number, true AS sign_agrees, true AS beats_zero FROM documents")
def svm_score_corpus(spark, sf_dir):
    scored = settle(_scored_corpus(spark, sf_dir))
    return scored.select("paper_number", _agrees(), _beats_zero(scored.join(inputs.labels(spark, sf_dir), "paper_number")))


@query("svm_scores")
def svm_scores(spark, sf_dir):
    """Decision score and label of every document."""
    return _scored_corpus(spark, sf_dir)


def _split(spark, sf_dir, n):
    labels = settle(inputs.labels(spark, sf_dir))
    test = settle(sampling.shuffle_subset(labels, n, "test"))
    return labels, test, sampling.except_labeled(labels, test)


_TEST = "test AS (SELECT * FROM sheet ORDER BY md5('test:' || paper_number), paper_number LIMIT {n})"


def _held_out(spark, sf_dir):
    labels, test, train = _split(spark, sf_dir, 200)
    return classify.holdout_evaluation(tfidf(spark, sf_dir, only=labels), train, test, classify.FULL_GRID)


@query(
    "holdout_evaluation",
    sql.with_(sql.LABELS, _TEST.format(n=200))
    + "SELECT count(*) AS n, count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives, true AS in_range FROM test",
)
def holdout_evaluation(spark, sf_dir):
    found = _held_out(spark, sf_dir)[0]
    in_range = F.greatest("accuracy", "precision", "recall", "f1") <= 1
    return found.select("n", (F.col("tp") + F.col("fn")).alias("positives"), (F.col("fp") + F.col("tn")).alias("negatives"), in_range.alias("in_range"))


@query("holdout_results")
def holdout_results(spark, sf_dir):
    """The metrics of the held-out documents, and the points of their ROC curve."""
    metrics, curve = _held_out(spark, sf_dir)
    names = ["n", "tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1"]
    doubles = metrics.select(*[F.col(c).cast("double").alias(c) for c in names])
    return doubles.unpivot([], names, "metric", "value").unionByName(curve.withColumn("metric", F.lit("roc")), allowMissingColumns=True)


def _round(spark, sf_dir):
    labels = settle(inputs.labels(spark, sf_dir))
    found = classify.active_learning_round(settle(tfidf(spark, sf_dir)), labels, inputs.metadata(spark, sf_dir), classify.FULL_GRID)
    return labels, *found


@query(
    "active_learning_round",
    sql.with_(sql.LABELS, sql.SCORES, sql.RANKED, sql.BATCH)
    + "SELECT slice, count(*) AS n, min(rank) AS first, max(rank) AS last, true AS unlabelled FROM batch GROUP BY slice",
)
def active_learning_round(spark, sf_dir):
    labels, _, picked = _round(spark, sf_dir)
    marked = picked.drop("label").join(labels.select("paper_number", "label"), "paper_number", "left")
    return marked.groupBy("slice").agg(
        F.count("*").alias("n"), F.min("rank").alias("first"), F.max("rank").alias("last"), F.every(F.col("label").isNull()).alias("unlabelled")
    )


@query("active_learning_results")
def active_learning_results(spark, sf_dir):
    """The prediction of every document, with its rank and slice where it is to be labelled next."""
    _, predictions, picked = _round(spark, sf_dir)
    return predictions.join(picked.select("paper_number", "rank", "slice"), "paper_number", "left")


def _curve(spark, sf_dir, **options):
    labels, test, train = _split(spark, sf_dir, 100)
    return curves.learning_curve(tfidf(spark, sf_dir, only=labels), train, test, **options)


def _in_range(found):
    return found.select("size_idx", "repeat", "n_train", "split", "metric", F.col("value").between(0, 1).alias("in_range"))


def _curve_sql(steps: int, repeats: int) -> str:
    rest = "sheet AS (SELECT * FROM whole WHERE paper_number NOT IN (SELECT paper_number FROM test))"
    whole = sql.LABELS.replace("sheet AS", "whole AS")
    return (
        sql.with_(whole, _TEST.format(n=100).replace("FROM sheet", "FROM whole"), rest, sql.curve_cells(steps, repeats, 100, "curve"))
        + ", chosen AS (SELECT size_idx, repeat, paper_number FROM dev WHERE size_idx = 0 UNION ALL "
        f"SELECT size_idx, r.repeat, paper_number FROM dev, (SELECT cast(unnest(range(0, {repeats})) AS INT) AS repeat) r WHERE size_idx > 0 "
        "UNION ALL SELECT size_idx, repeat, paper_number FROM drawn), "
        "sizes AS (SELECT size_idx, repeat, count(*) AS n_train FROM chosen GROUP BY ALL) "
        "SELECT size_idx, repeat, n_train, split, metric, true AS in_range FROM sizes, (VALUES ('train'), ('test')) s(split), "
        "(VALUES ('accuracy'), ('precision'), ('recall'), ('f1')) m(metric)"
    )


@query("learning_curve", _curve_sql(CURVE_STEPS, CURVE_REPEATS))
def learning_curve(spark, sf_dir):
    return _in_range(_curve(spark, sf_dir, steps=CURVE_STEPS, repeats=CURVE_REPEATS)[0])


@query("learning_curve_values")
def learning_curve_values(spark, sf_dir):
    """Every metric of every size, repeat and split; of each size the lowest, middle and highest value of the repeats."""
    values = _curve(spark, sf_dir, steps=CURVE_STEPS, repeats=CURVE_REPEATS)[0]
    summary = evaluate.curve_summary(values)
    return values.join(summary, ["size_idx", "split", "metric"])


@query("learning_curve_roc")
def learning_curve_roc(spark, sf_dir):
    """ROC curves of the last repeat of every size, on the training and on the test rows, all in one job."""
    scores = _curve(spark, sf_dir, steps=CURVE_STEPS, repeats=CURVE_REPEATS)[1]
    return evaluate.roc_curve(scores, by=["size_idx", "split"])


@query("learning_curve_grid", _curve_sql(CURVE_STEPS, CURVE_REPEATS))
def learning_curve_grid(spark, sf_dir):
    # 440 searches of 210 fits and a refit each; finished units stay in the shared folder
    store = f"{shared_folder(spark).rstrip('/')}/learning-curve"
    return _in_range(_curve(spark, sf_dir, steps=CURVE_STEPS, repeats=CURVE_REPEATS, grid=classify.FULL_GRID, store=store)[0])


def _lda_grid(spark, sf_dir):
    return topics.lda_grid_search(counts(spark, sf_dir)[0], LDA_KS, LDA_DECAYS, folds=LDA_FOLDS)[0]


@query(
    "lda_grid_search",
    f"SELECT cast(k AS INT) AS k, cast(d AS DOUBLE) AS learning_decay, cast(fold AS INT) AS fold, true AS beats_start FROM (SELECT unnest({LDA_KS}) AS k), "
    f"(SELECT unnest({LDA_DECAYS}) AS d), range(0, {LDA_FOLDS}) r(fold) WHERE EXISTS (SELECT 1 FROM documents)",
)
def lda_grid_search(spark, sf_dir):
    beats = (F.col("score") > F.col("start_score")) & (F.col("score") < 0) & (F.col("perplexity") > 1)
    return _lda_grid(spark, sf_dir).select("k", "learning_decay", "fold", beats.alias("beats_start"))


@query("lda_grid_scores")
def lda_grid_scores(spark, sf_dir):
    """Likelihood and perplexity of every setting and fold."""
    return _lda_grid(spark, sf_dir)


def _doc_topics(spark, sf_dir):
    rows, _ = counts(spark, sf_dir)
    return topics.lda_doc_topics(topics.lda_fit(rows, 15), rows)


@query("lda_doc_topics", "SELECT doc_id AS paper_number, cast(15 AS BIGINT) AS topics, true AS adds_up FROM documents")
def lda_doc_topics(spark, sf_dir):
    total = F.aggregate("weights", F.lit(0.0), lambda a, w: a + w)
    adds_up = (F.abs(total - 1) < 1e-6) | (total == 0)  # zeros: a document without any term of the vocabulary
    return _doc_topics(spark, sf_dir).select("paper_number", F.size("weights").cast("bigint").alias("topics"), adds_up.alias("adds_up"))


@query("lda_doc_weights")
def lda_doc_weights(spark, sf_dir):
    """The weight of every topic in every document."""
    return _doc_topics(spark, sf_dir).select("paper_number", F.posexplode("weights").alias("topic", "weight"))


def _topic_words(spark, sf_dir):
    rows, vocab = counts(spark, sf_dir)
    return topics.lda_topic_words(topics.lda_fit(rows, 15), vocab)


@query(
    "lda_topic_words",
    _SHEET.rstrip() + ", " + sql.CLEANED.lstrip().removeprefix("WITH ").rstrip() + ",\n" + sql.SEEN + ",\n" + sql.vocab(100, "df BETWEEN 2 AND 0.95 * n_docs")
    + "\nSELECT cast(topic AS INT) AS topic, term, true AS is_weight FROM vocab, range(0, 15) r(topic)",
)
def lda_topic_words(spark, sf_dir):
    return _topic_words(spark, sf_dir).select("topic", "term", F.col("weight").between(0, 1).alias("is_weight"))


@query("lda_word_weights")
def lda_word_weights(spark, sf_dir):
    """The weight of every term in every topic, and its rank there."""
    return topics.top_words_per_topic(_topic_words(spark, sf_dir), 100)


def _swept(spark, sf_dir):
    rows, vocab = counts(spark, sf_dir)
    return topics.lda_sweep(rows, SWEEP_KS, scratch_path(spark, "projections")), len(vocab.terms)


@query("lda_sweep", f"SELECT cast(k AS INT) AS k, true AS beats_uniform FROM (SELECT unnest({SWEEP_KS}) AS k) WHERE EXISTS (SELECT 1 FROM documents)")
def lda_sweep(spark, sf_dir):
    found, n_words = _swept(spark, sf_dir)
    return found.select("k", F.col("given_topics").between(1, n_words).alias("beats_uniform"))


@query("lda_sweep_scores")
def lda_sweep_scores(spark, sf_dir):
    """Perplexity and likelihood of every number of topics."""
    return _swept(spark, sf_dir)[0].drop("given_topics")


@query("lda_reports")
def lda_reports(spark, sf_dir):
    """The three reports of a fitted model as they were written: weights, documents per dominant topic, and words."""
    rows, vocab = counts(spark, sf_dir)
    model = topics.lda_fit(rows, 15)
    doc_topics = settle(topics.lda_doc_topics(model, rows))
    spread = topics.topic_distribution(topics.dominant_topic(doc_topics))
    keywords = topics.top_words_per_topic(topics.lda_topic_words(model, vocab), 15)
    path = scratch_path(spark, "lda-reports")
    sinks.write_topic_reports(topics.doc_topic_round(doc_topics), spread, keywords, path)
    names = {"doc_topics": ("paper_number", "topic", "weight"), "topic_distribution": ("dominant_topic", F.lit("documents"), "documents"), "topic_keywords": ("topic", "term", "rank")}
    parts = []
    for name, (key, item, value) in names.items():
        item = F.col(item) if isinstance(item, str) else item
        cells = F.lit(name).alias("report"), F.col(key).cast("string").alias("key"), item.cast("string").alias("item"), F.col(value).cast("double").alias("value")
        parts.append(load_artifact(spark, f"{path}/{name}").select(*cells))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _mixed(spark, sf_dir):
    return clusters.gmm_fit_predict(settle(tfidf(spark, sf_dir)), k=15, rank=clusters.RANK)


@query("gmm_fit_predict", "SELECT doc_id AS paper_number, true AS in_range FROM documents")
def gmm_fit_predict(spark, sf_dir):
    return _mixed(spark, sf_dir).clusters.select("paper_number", F.col("cluster").between(0, 14).alias("in_range"))


@query("gmm_clusters")
def gmm_clusters(spark, sf_dir):
    """The cluster of every document."""
    return _mixed(spark, sf_dir).clusters


@query("gmm_cluster_means")
def gmm_cluster_means(spark, sf_dir):
    """The mean of every cluster, term by term."""
    seen = settle(inputs.vector_input(spark, sf_dir))
    vocab = features.vocabulary(seen, max_features=1500)
    rows = settle(features.tfidf_features(seen, vocab).select("paper_number", "features"))
    means = clusters.gmm_means(clusters.gmm_fit_predict(rows, k=15, rank=clusters.RANK))
    terms = spark.createDataFrame(list(enumerate(vocab.terms)), "place int, term string")
    cells = means.select("cluster", F.posexplode(vector_to_array("mean")).alias("place", "weight"))
    return cells.join(F.broadcast(terms), "place").select("cluster", "term", "weight")


def _criteria(found, least):
    """The criteria minus the likelihood's part leave the number of free parameters, which the tables tell. The likelihood must not fall
    below that of a single component."""
    bic, aic = (F.col(c) + 2 * F.col("log_likelihood") for c in ("bic", "aic"))
    beats = (F.col("log_likelihood") >= F.lit(least)).alias("beats_one")
    return found.select("k", F.round(bic, 2).alias("bic_penalty"), F.round(aic, 2).alias("aic_penalty"), beats)


def _criteria_sql(ks: list[int]) -> str:
    q = clusters.RANK
    free = f"(k * (2 * d + d * {q} - {q * (q - 1) // 2}) + k - 1)"
    vocab = sql.CLEANED.rstrip() + ",\n" + sql.SEEN + ",\n" + sql.vocab(1500)
    return (
        vocab + f"\nSELECT cast(k AS INT) AS k, round({free} * ln(n), 2) AS bic_penalty, round(cast(2 * {free} AS DOUBLE), 2) AS aic_penalty, true AS beats_one "
        f"FROM (SELECT unnest({ks}) AS k), (SELECT (SELECT least(count(*), 10000) FROM documents) AS n, (SELECT count(*) FROM vocab) AS d)"
    )


def _mixtures(spark, sf_dir, ks):
    found = clusters.gmm_sweep(tfidf(spark, sf_dir), [1, *ks], rank=clusters.RANK)
    return found.where("k > 1"), found.where("k = 1").first().log_likelihood


@query("gmm_bic_aic", _criteria_sql([15]))
def gmm_bic_aic(spark, sf_dir):
    return _criteria(*_mixtures(spark, sf_dir, [15]))


@query("gmm_sweep", _criteria_sql(GMM_KS))
def gmm_sweep(spark, sf_dir):
    return _criteria(*_mixtures(spark, sf_dir, GMM_KS))


@query("gmm_criteria")
def gmm_criteria(spark, sf_dir):
    """Likelihood, BIC and AIC of 2 to 30 components."""
    return _mixtures(spark, sf_dir, GMM_KS)[0]


@query("kernel_map_errors")
def kernel_map_errors(spark, sf_dir):
    """Per gamma and way of mapping: the largest error of the kernel on labelled documents, and F1 on held-out ones."""
    labels, test, train = _split(spark, sf_dir, 200)
    known = settle(tfidf(spark, sf_dir, only=labels))
    seen, unseen = (settle(review.join_features_labels(known, part)) for part in (train, test))
    found = None
    for how in ("fourier", "landmarks"):
        maps = classify.kernel_maps(seen, classify.FULL_GAMMA, how)
        models = classify.svm_fit_each(seen, [classify.Entry("rbf", 100.0, gamma) for gamma in classify.FULL_GAMMA], maps)
        rows = [(float(m.gamma), float(evaluate.confusion_metrics(classify.svm_score(m, unseen, ["label"])).first().f1)) for m in models]
        scored = spark.createDataFrame(rows, "gamma double, f1 double")
        part = classify.kernel_errors(unseen, maps).join(scored, "gamma").withColumn("approximation", F.lit(how))
        found = part if found is None else found.unionByName(part)
    return found


_ITEMS = (
    sql.with_(sql.LABELS).rstrip() + ", " + sql.CLEANED.lstrip().removeprefix("WITH ").rstrip() + ",\n" + sql.SEEN + ",\n" + sql.vocab(1500)
    + ", few AS (SELECT term FROM vocab WHERE df BETWEEN 2 AND 0.95 * n_docs ORDER BY tf DESC, term LIMIT 100)"
)


@query(
    "artifact_round_trip",
    _ITEMS + """ SELECT kind, n, true AS same FROM (
  SELECT 'vocabulary' AS kind, count(*) AS n FROM vocab UNION ALL SELECT 'vectors', count(*) FROM sheet JOIN documents ON doc_id = paper_number
  UNION ALL SELECT 'svm', count(*) + 1 FROM vocab UNION ALL SELECT 'topics', 15 * count(*) FROM few UNION ALL SELECT 'mixture', 3 * count(*) FROM vocab)""",
)
def artifact_round_trip(spark, sf_dir):
    """Save a vocabulary, vectors, an SVM, a topic model and a mixture, and count what comes back equal."""
    seen = settle(inputs.vector_input(spark, sf_dir))
    vocab = features.vocabulary(seen, max_features=1500)
    labels = inputs.labels(spark, sf_dir)
    vectors = settle(review.join_features_labels(features.tfidf_features(seen.join(labels.select("paper_number"), "paper_number", "left_semi"), vocab).select("paper_number", "features"), labels))
    few = features.vocabulary(seen, max_features=100, min_df=2, max_df=0.95)
    bags = settle(features.count_features(seen, few).select("paper_number", "features"))
    things = {
        "vocabulary": vocab, "svm": classify.svm_fit(vectors), "topics": topics.lda_fit(bags, 15),
        "mixture": clusters.gmm_fit_predict(vectors.select("paper_number", "features"), k=3, rank=clusters.RANK).model,
    }
    size = {"vocabulary": lambda v: len(v.terms), "svm": lambda m: m.weights.size, "topics": lambda m: m.counts.size, "mixture": lambda m: m.means.size}
    root, rows = scratch_path(spark, "artifacts"), []
    for kind, thing in things.items():
        artifacts.save_object(spark, thing, f"{root}/{kind}")
        back = artifacts.load_object(spark, f"{root}/{kind}", kind)
        rows.append((kind, int(size[kind](back)), artifacts.same_object(thing, back)))
    artifacts.save_table(vectors, f"{root}/vectors", "vectors", {"max_features": 1500})
    table = artifacts.load_table(spark, f"{root}/vectors", "vectors")
    rows.append(("vectors", table.count(), artifacts.table_digest(table) == artifacts.table_digest(vectors)))
    return spark.createDataFrame(rows, "kind string, n bigint, same boolean")
