"""Gaussian mixtures for wide rows, many at a time: every covariance is a diagonal plus a product of low rank.

With loadings L (width x rank) and a diagonal P the inverse of L L' + P needs only a matrix of rank x rank (Woodbury), so a
component of 1,500 features has some thousand parameters instead of a million, and the density of a block of rows is a few
matrix products. All mixtures of a sweep read each block together; expectation-maximisation takes one pass over the rows per
round (Ghahramani and Hinton, 1996), and a mixture leaves when its mean log likelihood has settled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusloom.functions.kernel import dense_rows
from corpusloom.operators.blocks import copies_of_blocks, ddl, deal, fields, numbered_batches, one_row, pack_rows, places_and_values, sweep, unpack_rows, width
from corpusloom.operators.ranking import sample_n
from corpusloom.operators.storage import settle_for_fits

BLOCK_ROWS = 512
LEAST_VARIANCE = 1e-6
SEED_ROWS = 1_000  # bound of the sample in which the first means are looked for
TOLERANCE, RELATIVE = 1e-3, 1e-5  # of the mean log likelihood of a row, which grows with the width of the rows


@dataclass
class Mixture:
    """Weights (k), means (k x d), diagonals (k x d) and loadings (k x d x rank)."""

    weights: np.ndarray
    means: np.ndarray
    diagonals: np.ndarray
    loadings: np.ndarray
    log_likelihood: float = -math.inf
    rows: int = 0

    @property
    def k(self) -> int:
        return len(self.weights)

    @property
    def rank(self) -> int:
        return self.loadings.shape[2]

    def free(self) -> int:
        """Free parameters; turning the loadings of a component changes nothing, which takes rank * (rank - 1) / 2 away."""
        d, q = self.means.shape[1], self.rank
        return self.k * (2 * d + d * q - q * (q - 1) // 2) + self.k - 1

    def criteria(self) -> tuple[float, float]:
        """BIC and AIC."""
        return self.free() * math.log(max(self.rows, 1)) - 2 * self.log_likelihood, 2 * self.free() - 2 * self.log_likelihood


class Densities:
    """What the density of rows under a mixture takes, prepared once per pass."""

    def __init__(self, mixture: Mixture):
        k, d, q = mixture.loadings.shape
        self.k, self.q = k, q
        self.inverse = 1 / mixture.diagonals
        self.pull = mixture.means * self.inverse
        scaled = mixture.loadings * self.inverse[:, :, None]
        core = np.eye(q) + np.einsum("kdq,kdr->kqr", mixture.loadings, scaled)
        self.core = np.linalg.inv(core) if q else core
        self.project = scaled.transpose(1, 0, 2).reshape(d, k * q)
        self.centre = np.einsum("kd,kdq->kq", mixture.means, scaled)
        logdet = np.log(mixture.diagonals).sum(axis=1) + (np.linalg.slogdet(core)[1] if q else 0)
        constant = d * math.log(2 * math.pi) + logdet + (mixture.means * self.pull).sum(axis=1)
        self.constant = np.log(np.maximum(mixture.weights, 1e-300)) - constant / 2

    def of(self, x: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows x k log of weight times density, rows x k x rank expected factors)."""
        seen = (x @ self.project).reshape(len(x), self.k, self.q) - self.centre
        factors = np.einsum("nkq,kqr->nkr", seen, self.core)
        distance = squares @ self.inverse.T - 2 * (x @ self.pull.T) - (seen * factors).sum(axis=2)
        return self.constant - distance / 2, factors


def shares(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(share of every component in every row, log likelihood of every row)."""
    top = logs.max(axis=1, keepdims=True)
    parts = np.exp(logs - top)
    total = parts.sum(axis=1, keepdims=True)
    return parts / total, (top + np.log(total))[:, 0]


def _expect(row: dict, given: list[Densities]) -> np.ndarray:
    """Per mixture the sums that the next parameters are computed from, and the log likelihood."""
    x = unpack_rows(row)
    squares, out = x * x, []
    for density in given:
        logs, factors = density.of(x, squares)
        share, likelihood = shares(logs)
        with_one = np.concatenate([factors, np.ones((*factors.shape[:2], 1))], axis=2)
        weighted = share[:, :, None] * with_one
        first = x.T @ weighted.reshape(len(x), -1)
        pairs = np.einsum("nkq,nkr->kqr", weighted, with_one)
        pairs[:, : density.q, : density.q] += share.sum(axis=0)[:, None, None] * density.core
        out += [first.ravel(), (squares.T @ share).ravel(), pairs.ravel(), [likelihood.sum()]]
    return np.concatenate(out)


def _improve(mixture: Mixture, flat: np.ndarray, n: int) -> tuple[Mixture, np.ndarray]:
    """The next parameters, and what is left of `flat`. A component that no row belongs to any more stays where it was."""
    k, d, q = mixture.loadings.shape
    sizes = d * k * (q + 1), d * k, k * (q + 1) ** 2
    first, second, pairs, rest = np.split(flat, np.cumsum(sizes))
    first, second, pairs = first.reshape(d, k, q + 1).transpose(1, 0, 2), second.reshape(d, k).T, pairs.reshape(k, q + 1, q + 1)
    mass = pairs[:, q, q]
    kept = mass > 1e-6
    solved = np.zeros_like(first)
    solved[kept] = np.linalg.solve(pairs[kept] + 1e-9 * np.eye(q + 1), first[kept].transpose(0, 2, 1)).transpose(0, 2, 1)
    spread = (second - (solved * first).sum(axis=2)) / np.maximum(mass, 1e-300)[:, None]
    choose = lambda new, old: np.where(kept.reshape(-1, *[1] * (new.ndim - 1)), new, old)
    return Mixture(
        np.maximum(mass, 1e-300) / max(n, 1), choose(solved[:, :, q], mixture.means), choose(np.maximum(spread, LEAST_VARIANCE), mixture.diagonals),
        choose(solved[:, :, :q], mixture.loadings), float(rest[0]), n,
    ), rest[1:]


@dataclass
class Rows:
    """Settled and cached blocks of rows, and a bounded sample of them for the first means."""

    table: DataFrame
    blocks: int
    slices: int
    n: int
    width: int
    sample: np.ndarray

    def release(self) -> None:
        self.table.unpersist()


SCHEMA = fields(["width"], ["lengths", "places", "values"])


def row_blocks(df: DataFrame, id_col: str = "paper_number", features: str = "features", seed: int = 0) -> Rows:
    d, n = width(df, features), df.count()
    blocks = max(1, math.ceil(n / BLOCK_ROWS))
    cores = df.sparkSession.sparkContext.defaultParallelism
    slices, written = copies_of_blocks(blocks, cores)
    places, values = places_and_values(features, d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in numbered_batches(batches, BLOCK_ROWS):
            packed = pack_rows(batch.column("places"), batch.column("values"))
            for s in written:
                yield one_row(SCHEMA, s, number, d, *packed)

    made = df.select(places.alias("places"), values.alias("values")).coalesce(blocks).mapInArrow(run, ddl(SCHEMA)).repartition(min(blocks * len(written), 4 * cores))
    chosen = sample_n(df.select(id_col, features), SEED_ROWS, seed, id_col).select(id_col, places.alias("places"), values.alias("values"))
    taken = sorted(chosen.collect(), key=lambda r: str(r[0]))
    sample = np.zeros((len(taken), d))
    for i, r in enumerate(taken):
        sample[i, r["places"]] = r["values"]
    return Rows(settle_for_fits(made), blocks, slices, n, d, sample)


def first_means(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k rows of the sample, each drawn with a chance that grows with the squared distance from those before."""
    rng = np.random.default_rng([seed, k])
    picked = [int(rng.integers(len(sample)))]
    gap = ((sample - sample[picked[0]]) ** 2).sum(axis=1)
    while len(picked) < k:
        total = gap.sum()
        at = int(np.searchsorted(np.cumsum(gap), rng.random() * total)) if total > 0 else int(rng.integers(len(sample)))
        picked.append(min(at, len(sample) - 1))
        gap = np.minimum(gap, ((sample - sample[picked[-1]]) ** 2).sum(axis=1))
    return sample[picked]


def _moments(row: dict, _) -> np.ndarray:
    x = unpack_rows(row)
    return np.concatenate([x.sum(axis=0), (x * x).sum(axis=0)])


def fit_mixtures(rows: Rows, ks: list[int], rank: int, max_iter: int = 100, seed: int = 0) -> list[Mixture]:
    """All mixtures at once; each is done when its mean log likelihood changes by less than TOLERANCE, or RELATIVE of itself."""
    if not rows.n:
        raise ValueError("a mixture needs rows")
    total = sweep(rows.table, rows.blocks, {0: True}, _moments)[0]
    mean, square = total[: rows.width] / rows.n, total[rows.width :] / rows.n
    variance = np.maximum(square - mean * mean, LEAST_VARIANCE)
    mixtures = []
    for k in ks:
        rng = np.random.default_rng([seed, k, rank])
        loadings = 0.1 * np.sqrt(variance)[None, :, None] * rng.normal(size=(k, rows.width, rank))
        mixtures.append(Mixture(np.full(k, 1 / k), first_means(rows.sample, k, seed), np.tile(variance, (k, 1)), loadings))
    live, before = list(range(len(ks))), [-math.inf] * len(ks)
    for t in range(max_iter + 1):
        own = [[live[j] for j in ids] for ids in deal([mixtures[i].k for i in live], rows.slices)]
        sent = {s: [Densities(mixtures[i]) for i in ids] for s, ids in enumerate(own) if ids}
        going = []
        for s, flat in sweep(rows.table, rows.blocks, sent, _expect).items():
            for i in own[s]:
                better, flat = _improve(mixtures[i], flat, rows.n)
                mixtures[i].log_likelihood, mixtures[i].rows = better.log_likelihood, rows.n
                least = max(TOLERANCE, RELATIVE * abs(better.log_likelihood) / rows.n)
                if abs(better.log_likelihood - before[i]) / rows.n >= least and t < max_iter:
                    before[i], mixtures[i] = better.log_likelihood, better
                    going.append(i)
        live = sorted(going)
        if not live:
            break
    return mixtures


def predict(df: DataFrame, mixture: Mixture, id_col: str = "paper_number", features: str = "features", keep: list[str] | None = None) -> DataFrame:
    """(id, cluster, kept columns): the component with the largest share in every row."""
    d, names = mixture.means.shape[1], [id_col, *(keep or [])]
    schema = T.StructType([df.schema[id_col], T.StructField("cluster", T.IntegerType()), *(df.schema[c] for c in keep or [])])
    places, values = places_and_values(features, d)
    sent = df.sparkSession.sparkContext.broadcast(mixture)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        density = Densities(sent.value)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                x = dense_rows(batch.column("_places"), batch.column("_values"), d)
                best = density.of(x, x * x)[0].argmax(axis=1).astype(np.int32)
                columns = [batch.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([columns[0], pa.array(best), *columns[1:]], schema.names)

    return df.select(*names, places.alias("_places"), values.alias("_values")).mapInArrow(run, schema)
