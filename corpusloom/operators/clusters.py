"""Gaussian-mixture clusters, their information criteria and their words."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel
from pyspark.ml.feature import PCA
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import many_mixtures
from corpusloom.operators.many_mixtures import Mixture
from corpusloom.operators.ranking import top_n_per_group
from corpusloom.operators.sampling import shuffle_subset
from corpusloom.operators.storage import settle, settle_for_fits
from corpusloom.operators.text import cluster_tokens, group_word_frequencies


CRITERIA = "k int, log_likelihood double, bic double, aic double"
RANK = 4  # of the covariances of wide rows, next to their diagonals


@dataclass
class MixtureFit:
    model: GaussianMixtureModel | Mixture
    clusters: DataFrame
    log_likelihood: float
    bic: float
    aic: float


def reduce_dimensions(df: DataFrame, dims: int, features: str = "features") -> DataFrame:
    """Principal components: a full covariance per mixture component needs a narrow input."""
    rows = settle(df)
    model = PCA(k=dims, inputCol=features, outputCol="_pca").fit(rows)
    return model.transform(rows).drop(features).withColumnRenamed("_pca", features)


def bic_aic(log_likelihood: float, n: int, k: int, d: int) -> tuple[float, float]:
    """Information criteria of a k-component full-covariance mixture in d dimensions over n rows."""
    free = k * d + k * d * (d + 1) // 2 + k - 1
    return free * math.log(n) - 2 * log_likelihood, 2 * free - 2 * log_likelihood


def gmm_fit_predict(
    df: DataFrame, k: int = 15, seed: int = 0, max_iter: int = 100, id_col: str = "paper_number",
    features: str = "features", keep: list[str] | None = None, rank: int | None = None,
) -> MixtureFit:
    """Fit a mixture and give every row its most likely component.

    Covariances are full, which needs narrow rows; with a `rank` they are a diagonal plus a product of that rank, which
    fits vectors of a whole vocabulary. Columns in `keep`, such as the tokens, stay next to the cluster and save a join later.
    """
    if rank is not None:
        rows = many_mixtures.row_blocks(settle(df.select(id_col, features)), id_col, features, seed)
        mixture = many_mixtures.fit_mixtures(rows, [k], rank, max_iter, seed)[0]
        rows.release()
        return MixtureFit(mixture, many_mixtures.predict(df, mixture, id_col, features, keep), mixture.log_likelihood, *mixture.criteria())
    n = df.count()
    model = GaussianMixture(k=k, seed=seed, maxIter=max_iter, tol=1e-3, featuresCol=features).fit(df)
    likelihood = model.summary.logLikelihood
    d = int(model.gaussians[0].mean.size)
    bic, aic = bic_aic(likelihood, n, k, d)
    clusters = model.transform(df).select(id_col, F.col("prediction").alias("cluster"), *(keep or []))
    return MixtureFit(model, clusters, likelihood, bic, aic)


def gmm_means(fit: MixtureFit) -> DataFrame:
    """Mean vector of every component."""
    wide = isinstance(fit.model, Mixture)
    means = [(i, Vectors.dense(m)) for i, m in enumerate(fit.model.means if wide else [g.mean for g in fit.model.gaussians])]
    return fit.clusters.sparkSession.createDataFrame(means, ["cluster", "mean"])


def gmm_bic_aic(fit: MixtureFit, spark) -> DataFrame:
    k = fit.model.k if isinstance(fit.model, Mixture) else fit.model.getK()
    return spark.createDataFrame([(k, fit.log_likelihood, fit.bic, fit.aic)], CRITERIA)


def gmm_sweep(
    df: DataFrame, ks: list[int], sample: int = 10_000, seed: int = 0, max_iter: int = 100,
    id_col: str = "paper_number", rank: int | None = None,
) -> DataFrame:
    """BIC and AIC for every k on a random sample of the documents; with a `rank` all k share every scan."""
    spark = df.sparkSession
    chosen = shuffle_subset(df.select(id_col, "features"), sample, seed, id_col)
    if rank is not None:
        rows = many_mixtures.row_blocks(settle(chosen), id_col, seed=seed)
        found = [(m.k, m.log_likelihood, *m.criteria()) for m in many_mixtures.fit_mixtures(rows, ks, rank, max_iter, seed)]
        rows.release()
        return spark.createDataFrame(found, CRITERIA)
    rows = settle_for_fits(chosen)
    found = []
    for k in ks:
        fit = gmm_fit_predict(rows, k, seed, max_iter, id_col)
        found.append((k, fit.log_likelihood, fit.bic, fit.aic))
    rows.unpersist()
    return spark.createDataFrame(found, CRITERIA)


def cluster_word_frequencies(
    clusters: DataFrame, df: DataFrame, id_col: str = "paper_number", head: int = 3000, top: int = 200
) -> DataFrame:
    """Word-cloud table of every cluster over the first `head` tokens of its documents."""
    return group_word_frequencies(cluster_tokens(clusters, df, id_col, n=head), "cluster", top=top)


def top_words_per_cluster(frequencies: DataFrame, n: int = 15) -> DataFrame:
    order = [F.desc("n"), F.col("term")]
    return top_n_per_group(frequencies.drop("rank", "frequency"), ["cluster"], order, n)
