"""Support-vector classification: fits, grid search, corpus scoring and the active-learning round."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.kernel import KernelMap, decision_udf, map_udf
from corpusloom.operators import many_svms
from corpusloom.operators.blocks import places_and_values, width
from corpusloom.operators.evaluate import confusion_metrics, minmax_normalize, roc_curve
from corpusloom.operators.many_svms import HELD, Blocks, Entry, weight_rule
from corpusloom.operators.ranking import sample_n, with_hash_rank
from corpusloom.operators.review import join_features_labels, review_batch
from corpusloom.operators.storage import settle

ID = "paper_number"

# The full search grid.
FULL_C = [0.001, 0.01, 0.1, 1, 10, 100, 1000]
FULL_GAMMA = [1, 0.1, 1e-2, 1e-3, 1e-4]
FULL_GRID = [{"kernel": "rbf", "gamma": g, "C": c} for g in FULL_GAMMA for c in FULL_C] + [
    {"kernel": "linear", "C": c} for c in FULL_C
]


@dataclass
class SvmModel:
    """A fitted plane: weights with the intercept last, over the features or over their kernel map."""

    weights: np.ndarray
    kernel: str = "linear"
    C: float = 100.0
    gamma: float | None = None
    dim: int = 0
    map: KernelMap | None = None


def mapped_features(df: DataFrame, kernel_map: KernelMap) -> DataFrame:
    """Replace the feature vector by its image."""
    return df.withColumn("features", array_to_vector(map_udf(kernel_map)(*places_and_values(dim=kernel_map.dim))))


def fourier_features(df: DataFrame, gamma: float, dim: int, n_features: int = 500, seed: int = 0) -> DataFrame:
    """Replace the feature vector by random Fourier features of an RBF kernel with the given gamma."""
    return mapped_features(df, KernelMap.fourier(gamma, dim, n_features, seed))


def landmark_rows(df: DataFrame, n: int, seed: int = 0, id_col: str = ID) -> np.ndarray:
    """The vectors of n rows, chosen by a hash of their ids; equal vectors once. n bounds what reaches the driver."""
    dim = width(df)
    places, values = places_and_values(dim=dim)
    rows = sample_n(df.select(id_col, "features"), n, f"landmarks:{seed}", id_col).select(places.alias("places"), values.alias("values")).collect()
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, r["places"]] = r["values"]
    return np.unique(out, axis=0)


def kernel_maps(df: DataFrame, gammas: list[float], how: str = "fourier", n_features: int = 500, seed: int = 0, id_col: str = ID) -> dict[float, KernelMap]:
    """One map per gamma: `fourier`, or `landmarks` out of the rows of df, of which there are n_features at most."""
    if how == "fourier":
        dim = width(df)
        return {g: KernelMap.fourier(g, dim, n_features, seed) for g in gammas}
    if how != "landmarks":
        raise ValueError(f"no kernel map {how}")
    rows = landmark_rows(df, n_features, seed, id_col)
    return {g: KernelMap.from_landmarks(g, rows) for g in gammas}


def kernel_errors(df: DataFrame, maps: dict[float, KernelMap], n: int = 400, seed: str = "errors", id_col: str = ID) -> DataFrame:
    """(gamma, width, error): the largest difference from the kernel between any two of n rows chosen by a hash of their ids."""
    rows = landmark_rows(df, n, seed, id_col)
    found = [(float(g), m.width, m.error(rows)) for g, m in sorted(maps.items())]
    return df.sparkSession.createDataFrame(found, "gamma double, width int, error double")


def class_weights(train: DataFrame, mode: str | None) -> dict[int, float]:
    """Weight per class: "count" is the class size itself, "balanced" n / (2 * size), None is 1."""
    sizes = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    weights = weight_rule(mode, sizes)
    weights["total"] = sum(weights[label] * size for label, size in sizes.items())
    weights["rows"] = sum(sizes.values())
    return weights


def svm_fit(
    train: DataFrame, C: float = 100.0, weight_mode: str | None = "balanced", kernel: str = "linear",
    gamma: float | None = None, n_features: int = 500, seed: int = 0, max_iter: int = 100, approximation: str = "fourier", id_col: str = ID,
) -> SvmModel:
    """Soft-margin SVM on (features, label 0/1); C has its usual meaning. An RBF kernel is approximated by a map, see kernel_maps."""
    rows = settle(train.select(*([id_col] if id_col in train.columns else []), "features", "label"))
    maps = {} if kernel == "linear" else kernel_maps(rows, [gamma], approximation, n_features, seed, id_col)
    return svm_fit_each(rows, [Entry(kernel, C, gamma)], maps, weight_mode, max_iter)[0]


def svm_fit_each(
    train: DataFrame, entries: list[Entry], maps: dict[float, KernelMap], weight_mode: str | None = "balanced", max_iter: int = 100,
) -> list[SvmModel]:
    """One model per entry on the same rows, all fitted in the same passes; `train` has to be settled."""
    held = many_svms.make_blocks(train.select("features", "label"), list(dict.fromkeys(e.map for e in entries)), maps)
    weights = many_svms.fit_many(held, entries, weight_mode, max_iter)
    held.release()
    return [SvmModel(w, e.kernel, e.C, e.gamma, held.dim, maps.get(e.gamma)) for e, w in zip(entries, weights, strict=True)]


def svm_score(model: SvmModel, corpus: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Decision score and predicted label of every row; positive scores mean class 1. A model of no rows scores 0."""
    score = decision_udf(model.weights, model.dim, model.map)(*places_and_values(dim=model.dim)) if model.dim else F.lit(0.0)
    scored = corpus.select(*(keep or [ID]), score.alias("score"))
    return scored.withColumn("prediction", (F.col("score") > 0).cast("int"))


def stratified_folds(labeled: DataFrame, folds: int, seed="folds", id_col: str = ID) -> DataFrame:
    """Every class is dealt out evenly over the folds, in hash order."""
    ranked = with_hash_rank(labeled.select(id_col, "label"), seed, id_col, "_rank", ["label"])
    fold = F.pmod("_rank", F.lit(folds)).cast("int").alias("fold")
    return labeled.join(ranked.select(id_col, fold), id_col)


def grid_entries(grid: list[dict], cell: int, folds: int) -> list[Entry]:
    return [Entry(e["kernel"], e["C"], e.get("gamma"), cell, f) for e in grid for f in range(folds)]


def grid_maps(grid: list[dict]) -> list[tuple[str, float | None]]:
    return list(dict.fromkeys((e["kernel"], e.get("gamma")) for e in grid))


def grid_gammas(grid: list[dict]) -> list[float]:
    return list(dict.fromkeys(e["gamma"] for e in grid if e.get("gamma") is not None))


def search_cells(
    held: Blocks, grid: list[dict], cells: list[int], folds: int, weight_mode: str | None, max_iter: int, path: bool = False,
) -> tuple[np.ndarray, list[Entry], list[np.ndarray]]:
    """Cross-validated F1 (cells x grid x folds), and of each cell the best entry, refitted on all its rows, with its weights.

    With `path`, entries that differ only in C are fitted in the order of C, each from the weights of the one before:
    fewer models at a time and fewer passes for each, which pays if there are very many.
    """
    entries = [e for cell in cells for e in grid_entries(grid, cell, folds)]
    weights: list[np.ndarray | None] = [None] * len(entries)
    place = {e: i for i, e in enumerate(entries)}
    levels = sorted({e.C for e in entries}) if path else [None]
    for before, level in zip([None, *levels], levels, strict=False):
        own = [e for e in entries if level in (None, e.C)]
        zero = lambda e: np.zeros(held.widths[held.maps.index(e.map)] + 1)
        known = [weights[place[r]] if (r := Entry(e.kernel, before, e.gamma, e.cell, e.fold)) in place else zero(e) for e in own] if before is not None else None
        for e, w in zip(own, many_svms.fit_many(held, own, weight_mode, max_iter, known), strict=True):
            weights[place[e]] = w
    counts = many_svms.count_many(held, entries, weights)[:, HELD]
    f1 = many_svms.f1_of(counts).reshape(len(cells), len(grid), folds)
    chosen, first = [], []
    for cell, means in zip(cells, f1.mean(axis=2), strict=True):
        best = grid[int(means.argmax())]
        chosen.append(Entry(best["kernel"], best["C"], best.get("gamma"), cell))
        first.append(weights[place[Entry(best["kernel"], best["C"], best.get("gamma"), cell, 0)]])
    return f1, chosen, many_svms.fit_many(held, chosen, weight_mode, max_iter, first)


def svm_grid_search(
    train: DataFrame, grid: list[dict] | None = None, folds: int = 5, weight_mode: str | None = "balanced",
    seed: int = 0, n_features: int = 500, max_iter: int = 100, approximation: str = "fourier",
) -> tuple[DataFrame, SvmModel]:
    """Cross-validated F1 of every grid entry (one row per entry and fold) and the best entry refitted on all rows.

    All entries and folds are fitted together, see many_svms. Of entries with the same mean the first wins.
    """
    spark = train.sparkSession
    grid = FULL_GRID if grid is None else grid
    rows = settle(stratified_folds(train.select(ID, "features", "label"), folds, seed))
    maps = kernel_maps(rows, grid_gammas(grid), approximation, n_features, seed)
    held = many_svms.make_blocks(rows, grid_maps(grid), maps, folds=folds)
    f1, (best,), (weights,) = search_cells(held, grid, [0], folds, weight_mode, max_iter)
    held.release()
    found = [
        (e["kernel"], float(e["C"]), None if e.get("gamma") is None else float(e["gamma"]), fold, float(value))
        for e, values in zip(grid, f1[0], strict=True) for fold, value in enumerate(values)
    ]
    model = SvmModel(weights, best.kernel, best.C, best.gamma, held.dim, maps.get(best.gamma))
    return spark.createDataFrame(found, "kernel string, C double, gamma double, fold int, f1 double"), model


def holdout_evaluation(
    features: DataFrame, labels: DataFrame, test_labels: DataFrame, grid: list[dict] | None = None, folds: int = 5,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Metrics and ROC curve, on documents outside the training labels, of the model tuned on all training labels."""
    _, model = svm_grid_search(join_features_labels(features, labels), grid, folds, **options)
    scored = svm_score(model, join_features_labels(features, test_labels), [ID, "label"])
    normalized = minmax_normalize(scored, "score", "normalized")
    return confusion_metrics(scored), roc_curve(normalized, score="normalized")


def active_learning_round(
    features: DataFrame, labels: DataFrame, metadata: DataFrame, grid: list[dict] | None = None, folds: int = 5,
    batch: dict | None = None, **options,
) -> tuple[DataFrame, DataFrame]:
    """Tune on the labels, score the whole corpus: (predictions, the next batch to label with its metadata)."""
    _, model = svm_grid_search(join_features_labels(features, labels), grid, folds, **options)
    predictions = settle(svm_score(model, features))  # ranking reads the scores several times
    picked = review_batch(predictions, labels, **(batch or {}))
    return predictions, metadata.join(picked, ID)
