"""Exact k-means by Shallot search (Borgelt, 2020) on integer vectors.

Every vector remembers its nearest and its second-nearest centroid, an upper bound of the distance to the first and a lower
bound of that to all others. When centroids move the bounds move along, and while the upper bound stays below the lower
one, or below half the way to the next centroid, nothing is computed. Otherwise both remembered centroids are measured, and
the search starts at the closer one: its neighbours come in order of their distance from it, and the search ends where that
exceeds the vector's distance from the start plus its distance from the second-nearest found so far, a ball that shrinks
with every find. What lies in the ball is compared by integer squared distances, so ties and results are exact.

A round is one pass over the vectors that writes them with their bounds, and one sum per cluster over what was written.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.storage import save_artifact, scratch_path

CLUSTERS, ROUNDS, DIMENSIONS, SCALE = 16, 3, 64, 64
MOST = 1 << 27  # components are cut to this, so that every squared distance fits a long
UP, DOWN = 1 + 1e-12, 1 - 1e-12  # bounds are rounded away from what they bound
ROWS_AT_ONCE = 4096


@dataclass
class Centroids:
    """Centroids with what the search needs to know of them. `before`: where they were when the bounds were taken."""

    points: np.ndarray
    before: np.ndarray | None = None

    def __post_init__(self):
        apart = self.points[:, None] - self.points[None]
        self.apart = np.sqrt((apart * apart).sum(axis=2).astype(np.float64))
        other = self.apart + np.diag(np.full(len(self.points), np.inf))
        self.near = np.argsort(other, axis=1, kind="stable")[:, :-1]
        self.half = other.min(axis=1, initial=np.inf) / 2 * DOWN
        moved = np.zeros(len(self.points))
        if self.before is not None:
            step = self.points - self.before
            moved = np.sqrt((step * step).sum(axis=1).astype(np.float64)) * UP
        self.moved = moved
        # how far any centroid but the own one has moved
        self.others_moved = np.array([np.delete(moved, i).max(initial=0.0) for i in range(len(moved))])


def squared(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    gap = x - points
    return np.einsum("ij,ij->i", gap, gap)


@dataclass
class Bounds:
    first: np.ndarray
    second: np.ndarray
    upper: np.ndarray
    lower: np.ndarray


def unknown(n: int, k: int) -> Bounds:
    """Before the first search any two centroids will do."""
    return Bounds(np.zeros(n, np.int64), np.full(n, min(1, k - 1)), np.full(n, np.inf), np.zeros(n))


def search(x: np.ndarray, old: Bounds, to: Centroids) -> tuple[Bounds, int]:
    """The nearest centroid of every row of x, of equally near ones the one with the smaller number. Also: distances computed."""
    k = len(to.points)
    first, second = old.first.copy(), old.second.copy()
    upper, lower = (old.upper + to.moved[first]) * UP, np.maximum(old.lower - to.others_moved[first], 0) * DOWN
    enough = np.maximum(lower, to.half[first])
    open_ = np.flatnonzero(~(upper < enough))
    measured = len(open_)
    d1 = squared(x[open_], to.points[first[open_]])
    upper[open_] = np.sqrt(d1.astype(np.float64)) * UP
    left = ~(upper[open_] < enough[open_])
    open_, d1 = open_[left], d1[left]
    if k == 1 or not len(open_):
        return Bounds(first, second, upper, lower), measured
    own, vectors = first[open_], x[open_]
    other = second[open_]
    d2 = squared(vectors, to.points[other])
    measured += len(open_)
    swap = (d2 < d1) | ((d2 == d1) & (other < own))
    own, other = np.where(swap, other, own), np.where(swap, own, other)
    d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
    start, known, radius = own.copy(), other.copy(), np.sqrt(d1.astype(np.float64))
    going = np.arange(len(open_))
    for t in range(k - 1):
        j = to.near[start[going], t]
        inside = to.apart[start[going], j] * DOWN <= (radius[going] + np.sqrt(d2[going].astype(np.float64))) * UP
        going, j = going[inside], j[inside]
        if not len(going):
            break
        new = j != known[going]
        rows, j = going[new], j[new]
        d = squared(vectors[rows], to.points[j])
        measured += len(rows)
        nearest = (d < d1[rows]) | ((d == d1[rows]) & (j < own[rows]))
        next_ = ~nearest & ((d < d2[rows]) | ((d == d2[rows]) & (j < other[rows])))
        n = rows[nearest]
        d2[n], other[n] = d1[n], own[n]
        d1[n], own[n] = d[nearest], j[nearest]
        n = rows[next_]
        d2[n], other[n] = d[next_], j[next_]
    first[open_], second[open_] = own, other
    upper[open_], lower[open_] = np.sqrt(d1.astype(np.float64)) * UP, np.sqrt(d2.astype(np.float64)) * DOWN
    return Bounds(first, second, upper, lower), measured


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _bounds(batch: pa.RecordBatch, k: int) -> Bounds:
    if "first" not in batch.schema.names:
        return unknown(batch.num_rows, k)
    return Bounds(*(batch.column(c).to_numpy().astype(t) for c, t in (("first", np.int64), ("second", np.int64), ("upper", float), ("lower", float))))


def _pass(rows: DataFrame, to: Centroids, dims: int, final: bool) -> DataFrame:
    """Vectors with their new bounds; in the final pass with their cluster and squared distance instead."""
    added = "cluster int, distance long" if final else "first int, second int, upper double, lower double"
    kept = [rows.schema["id"]] if final else [rows.schema["id"], rows.schema["x"]]
    schema = T.StructType([*kept, *T._parse_datatype_string(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                x = _vectors(batch, dims)
                found, _ = search(x, _bounds(batch, len(to.points)), to)
                columns = [batch.column(f.name) for f in kept]
                if final:
                    columns += [pa.array(found.first, pa.int32()), pa.array(squared(x, to.points[found.first]), pa.int64())]
                else:
                    columns += [pa.array(found.first, pa.int32()), pa.array(found.second, pa.int32()), pa.array(found.upper), pa.array(found.lower)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)


def integer_vectors(vectors: DataFrame, id_col: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, x) of the vectors with `dims` components, none null or non-finite; x is floor(scale * component)."""
    sound = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.size("v") == dims).where(F.forall("v", sound))
    cut = lambda e: F.floor(F.least(F.greatest(e * scale, F.lit(-float(MOST))), F.lit(float(MOST)))).cast("int")
    return kept.select("id", F.transform("v", cut).alias("x"))


def first_key(id_col: str = "id") -> Column:
    return F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)


def _moved(state: DataFrame, points: np.ndarray) -> np.ndarray:
    """Every non-empty cluster's componentwise floor of the mean; one row per cluster reaches the driver."""
    dims = points.shape[1]
    sums = [F.sum(F.col("x")[i].cast("long")).alias(f"s{i}") for i in range(dims)]
    new = points.copy()
    for row in state.groupBy("first").agg(F.count("*").alias("n"), *sums).collect():
        new[row["first"]] = [row[f"s{i}"] // row["n"] for i in range(dims)]
    return new


def cluster_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
    dims: int = DIMENSIONS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(rows of id, cluster, squared distance; the final centroids) of k-means on floor(scale * component).

    Vectors of another length, or with a null or non-finite component, are left out; components are cut to 2^27. The first
    centroids are the k vectors with the smallest sha256 of `1:<id>`, a null id being empty; on equal ids the smaller
    vector. Fewer vectors make fewer centroids. Repeated rows count as often as they come. Further columns are left out.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, id_col, vector, dims, scale)
    chosen = rows.orderBy(first_key(), "x").limit(k).select("x").collect()
    points, before = np.array([r.x for r in chosen], np.int64).reshape(-1, dims), None
    for _ in range(rounds if len(points) else 0):
        rows = save_artifact(_pass(rows, Centroids(points, before), dims, False), scratch_path(spark, "vectors"))
        points, before = _moved(rows, points), points
    return _pass(rows, Centroids(points, before), dims, True), points


def with_inertia(clustered: DataFrame, points: np.ndarray) -> DataFrame:
    """Adds the inertia of the row's cluster and of all, and sha256 of the components of its centroid."""
    spark = clustered.sparkSession
    placed = save_artifact(clustered, scratch_path(spark, "clusters"))
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    total = lambda c: F.least(F.sum(F.col(c).cast("decimal(38,0)")), most).cast("long")
    own = placed.groupBy("cluster").agg(total("distance").alias("cluster_inertia"))
    every = placed.agg(total("distance").alias("inertia"))
    written = [(i, ",".join(map(str, p))) for i, p in enumerate(points.tolist())]
    names = spark.createDataFrame(written, "cluster int, components string").select("cluster", F.sha2("components", 256).alias("centroid_sha256"))
    # one row per cluster
    facts = own.join(names, "cluster").withColumn("inertia", every.select("inertia").scalar())
    return placed.join(F.broadcast(facts), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    gap = "list_sum(list_transform(range(1, 65), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    parts = [
        "kept AS (SELECT vec_id, row_number() OVER () AS rn, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS x FROM embeddings "
        "WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)",
        "c0 AS (SELECT cast(row_number() OVER (ORDER BY h, x) - 1 AS INT) AS cluster, x AS c FROM "
        "(SELECT x, sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h FROM kept ORDER BY h, x LIMIT 16))",
    ]
    for t in range(ROUNDS + 1):
        parts.append(f"n{t} AS MATERIALIZED (SELECT rn, min({{'d': {gap}, 'c': cluster}}) AS m FROM kept, c{t} GROUP BY rn)")
        if t < ROUNDS:
            parts.append(
                f"s{t} AS (SELECT m.c AS cluster, i, sum(x[i]) AS s, count(*) AS n FROM n{t} JOIN kept USING (rn), range(1, 65) r(i) GROUP BY m.c, i), "
                f"f{t} AS (SELECT cluster, list(cast((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{t} GROUP BY cluster), "
                f"c{t + 1} AS MATERIALIZED (SELECT o.cluster, coalesce(f.c, o.c) AS c FROM c{t} o LEFT JOIN f{t} f USING (cluster))"
            )
    last = ROUNDS
    return "WITH " + ", ".join(parts) + (
        f" SELECT vec_id, m.c AS cluster, cast(m.d AS BIGINT) AS distance, cast(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, "
        f"cast(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 "
        f"FROM n{last} JOIN kept USING (rn) JOIN c{last} ON cluster = m.c"
    )


ORACLE_SQL = _sql()
