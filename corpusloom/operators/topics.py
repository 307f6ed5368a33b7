"""LDA topic models and the tables reported about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import many_topics
from corpusloom.operators.features import Vocabulary
from corpusloom.operators.many_topics import Spec, TopicModel
from corpusloom.operators.ranking import hash_order, top_n_per_group
from corpusloom.operators.storage import settle

ID = "paper_number"


def lda_fit(
    df: DataFrame, k: int, learning_decay: float = 0.7, max_iter: int = 10, seed: int = 0, features: str = "features",
    batch_fraction: float = 1.0, id_col: str = ID,
) -> TopicModel:
    """Online variational LDA. Every iteration reads `batch_fraction` of the documents."""
    held = many_topics.document_blocks(settle(df.select(id_col, features)), id_col, features, seed)
    model = many_topics.fit_topics(held, [Spec(k, learning_decay)], max_iter, seed, batch_fraction)[0]
    held.release()
    return model


def lda_scores(model: TopicModel, df: DataFrame, id_col: str = ID, features: str = "features") -> tuple[float, float]:
    """(log likelihood bound, perplexity) of a set of documents, from one pass."""
    held = many_topics.document_blocks(df, id_col, features)
    found = many_topics.topic_scores(held, [TopicModel(Spec(model.spec.k), model.counts)])[0]
    held.release()
    return found


def lda_grid_search(
    df: DataFrame, ks: list[int], decays: list[float], folds: int = 5, max_iter: int = 10, seed: int = 0,
    id_col: str = ID,
) -> tuple[DataFrame, TopicModel, dict]:
    """Cross-validated log likelihood of every (k, decay), the refitted best model and its parameters. `start_score` is the
    likelihood of the same held-out documents before the first iteration.

    All settings and folds read each block of documents together; the best is then fitted once more on all of them.
    """
    fold = F.pmod(F.conv(F.substring(hash_order(seed, F.col(id_col)), 1, 8), 16, 10).cast("bigint"), F.lit(folds))
    held = many_topics.document_blocks(settle(df.select(id_col, "features", fold.cast("int").alias("fold"))), id_col, seed=seed)
    specs = [Spec(k, d, f) for k in ks for d in decays for f in range(folds)]
    models = many_topics.fit_topics(held, specs, max_iter, seed)
    start = many_topics.topic_scores(held, many_topics.first_models(specs, held.n_words, seed))
    after = many_topics.topic_scores(held, models)
    found = [(s.k, s.decay, s.fold, *scores, first) for s, scores, (first, _) in zip(specs, after, start, strict=True)]
    means = {(k, d): sum(r[3] for r in found if r[:2] == (k, d)) / folds for k in ks for d in decays}
    k, decay = max(means, key=means.get)
    best = many_topics.fit_topics(held, [Spec(k, decay)], max_iter, seed)[0]
    chosen = {"k": k, "learning_decay": decay, "score": means[k, decay], "perplexity": many_topics.topic_scores(held, [best])[0][1]}
    held.release()
    results = df.sparkSession.createDataFrame(found, "k int, learning_decay double, fold int, score double, perplexity double, start_score double")
    return results, best, chosen


def grid_results_by_decay(results: DataFrame, decays: list[float]) -> DataFrame:
    """Mean score per k, one column per learning decay, rounded to integers with halves to even."""
    wide = results.groupBy("k").pivot("learning_decay", decays).agg(F.bround(F.avg("score"), 0))
    names = [F.col(f"`{d}`").alias(f"decay_{str(d).replace('.', '_')}") for d in decays]
    return wide.select("k", *names)


def lda_sweep(
    df: DataFrame, ks: list[int], path: str, learning_decay: float = 0.7, max_iter: int = 10, seed: int = 0,
    id_col: str = ID,
) -> DataFrame:
    """Perplexity and log likelihood for every k; the projections go to `path`, one partition per k. `given_topics` is the
    perplexity without the part of the bound that belongs to the topics, which outweighs the documents of a small corpus.

    All k are fitted together. One more scan writes the projections with each document's part of the bound, and the scores are
    sums over what was written.
    """
    rows = settle(df.select(id_col, "features"))
    held = many_topics.document_blocks(rows, id_col, seed=seed)
    models = many_topics.fit_topics(held, [Spec(k, learning_decay) for k in ks], max_iter, seed)
    held.release()
    many_topics.project(rows, models, id_col).write.partitionBy("k").parquet(path)
    sums = df.sparkSession.read.parquet(path).groupBy("k").agg(F.sum("bound").alias("bound"), F.sum("tokens").alias("tokens"))
    seen = {r.k: (r.bound, r.tokens) for r in sums.collect()}
    found = []
    for k, model in zip(ks, models, strict=True):
        bound, tokens = seen.get(k, (0.0, 0.0))
        total = bound + model.bound()
        found.append((k, many_topics.perplexity(total, tokens), total, many_topics.perplexity(bound, tokens)))
    return df.sparkSession.createDataFrame(found, "k int, perplexity double, score double, given_topics double")


def lda_doc_topics(model: TopicModel, df: DataFrame, id_col: str = ID) -> DataFrame:
    return many_topics.project(df, [model], id_col).select(id_col, "weights")


def lda_topic_words(model: TopicModel, vocab: Vocabulary) -> DataFrame:
    """(topic, term, weight) for every topic and vocabulary term; both are bounded by parameters."""
    cells = [(t, term, float(w)) for t, row in enumerate(model.words()) for term, w in zip(vocab.terms, row, strict=True)]
    return SparkSession.active().createDataFrame(cells, "topic int, term string, weight double")


def rounded_weights(weights: Column) -> Column:
    """Weights to two decimals, halves to even."""
    return F.transform(weights, lambda w: F.bround(w.cast("double"), 2))


def doc_topic_round(doc_topics: DataFrame, id_col: str = "paper_number", weights: str = "weights") -> DataFrame:
    """Long doc-topic table with rounded weights."""
    return doc_topics.select(id_col, F.posexplode(rounded_weights(F.col(weights))).alias("topic", "weight"))


def dominant_topic(doc_topics: DataFrame, id_col: str = "paper_number", weights: str = "weights") -> DataFrame:
    """Topic with the largest rounded weight; the lowest topic wins a tie."""
    rounded = rounded_weights(F.col(weights))
    place = F.array_position(rounded, F.array_max(rounded)) - 1
    return doc_topics.select(id_col, place.cast("int").alias("dominant_topic"))


def topic_highlight(doc_topics: DataFrame, id_col: str = "paper_number", weights: str = "weights") -> DataFrame:
    """Long doc-topic table with the cells above 0.1 marked."""
    return doc_topic_round(doc_topics, id_col, weights).withColumn("highlight", F.col("weight") > 0.1)


def topic_distribution(dominant: DataFrame) -> DataFrame:
    """Documents per dominant topic, most frequent first."""
    counts = dominant.groupBy("dominant_topic").agg(F.count("*").alias("documents"))
    return counts.orderBy(F.desc("documents"), "dominant_topic")


def top_words_per_topic(topic_words: DataFrame, n: int = 15) -> DataFrame:
    return top_n_per_group(topic_words, ["topic"], [F.desc("weight"), F.col("term")], n)


def topic_keyword_pivot(top_words: DataFrame, n: int = 15) -> DataFrame:
    """One row per topic with its top words in columns word_0 .. word_{n-1}."""
    words = top_words.withColumn("_place", F.col("rank") - 1)
    wide = words.groupBy("topic").pivot("_place", list(range(n))).agg(F.first("term"))
    return wide.select("topic", *[F.col(f"`{i}`").alias(f"word_{i}") for i in range(n)])
