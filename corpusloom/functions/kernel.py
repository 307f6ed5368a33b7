"""Finite maps of an RBF kernel: a linear model on them approximates a kernel machine.

* `fourier`: cosines of random projections (Rahimi and Recht, 2007), whatever the data.
* `landmarks`: kernel values with a sample of the rows, turned so that the kernel between landmarks is exact (Nystroem map,
  Williams and Seeger, 2001).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CHUNK = 256
UNIT = 0.5  # the gamma whose projections are not stretched
_SMALL = 1e-8  # directions of the landmark kernel below this share of the largest are noise


@functools.lru_cache(maxsize=8)
def _drawn(dim: int, n_features: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and shifts, drawn once per worker. Every gamma has the same directions and stretches them on its own."""
    rng = np.random.default_rng(seed)
    weights = rng.normal(scale=np.sqrt(2.0 * gamma), size=(dim, n_features))
    return weights, rng.uniform(0.0, 2.0 * np.pi, size=n_features)


def fourier_map(dense: np.ndarray, dim: int, n_features: int, gamma: float, seed: int) -> np.ndarray:
    weights, shift = _drawn(dim, n_features, gamma, seed)
    return np.cos(dense @ weights + shift) * np.sqrt(2.0 / n_features)


def gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a from all rows of b."""
    gap = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T)
    return np.maximum(gap, 0, out=gap)


def rbf(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    """Kernel of all rows of a with all rows of b."""
    return np.exp(-gamma * gaps(a, b))


@dataclass(frozen=True, eq=False)
class KernelMap:
    """From vectors of `dim` numbers to vectors of `width`."""

    gamma: float
    dim: int
    width: int
    seed: int = 0
    landmarks: np.ndarray | None = field(default=None, repr=False)
    turn: np.ndarray | None = field(default=None, repr=False)

    @classmethod
    def fourier(cls, gamma: float, dim: int, n_features: int, seed: int) -> KernelMap:
        return cls(gamma, dim, n_features, seed)

    @classmethod
    def from_landmarks(cls, gamma: float, landmarks: np.ndarray) -> KernelMap:
        """`landmarks` are distinct rows; their kernel's directions become the features."""
        values, vectors = np.linalg.eigh(rbf(landmarks, landmarks, gamma))
        kept = values > _SMALL * values.max(initial=0)
        turn = np.ascontiguousarray(vectors[:, kept] / np.sqrt(values[kept]))  # as it comes back from a file: products agree to the last bit
        return cls(gamma, landmarks.shape[1], int(kept.sum()), 0, landmarks, turn)

    @property
    def kind(self) -> tuple:
        """Maps of one kind differ in gamma only and have the same base."""
        return ("fourier", self.dim, self.width, self.seed) if self.turn is None else ("landmarks", id(self.landmarks))

    def base(self, dense: np.ndarray) -> np.ndarray:
        """The part of the work that no gamma enters: projections, or squared distances from the landmarks."""
        return dense @ _drawn(self.dim, self.width, UNIT, self.seed)[0] if self.turn is None else gaps(dense, self.landmarks)

    def unturned(self, base: np.ndarray) -> np.ndarray:
        """The mapped rows of a base; those of landmarks have still to be multiplied with `turn`. Projections are held in single
        precision, and their cosines are taken in it."""
        if self.turn is not None:
            return np.exp(-self.gamma * base)
        out = np.multiply(base, np.sqrt(self.gamma / UNIT), dtype=np.float32, casting="same_kind")
        out += _drawn(self.dim, self.width, UNIT, self.seed)[1].astype(np.float32)
        np.cos(out, out=out)
        return np.multiply(out, np.sqrt(2.0 / self.width), dtype=np.float64)

    def without_landmarks(self) -> KernelMap:
        """What `unturned` needs, which is all that a pass over bases has to be sent."""
        return replace(self, landmarks=None)

    def apply(self, dense: np.ndarray) -> np.ndarray:
        if self.landmarks is None:
            return fourier_map(dense, self.dim, self.width, self.gamma, self.seed)
        return rbf(dense, self.landmarks, self.gamma) @ self.turn

    def error(self, dense: np.ndarray) -> float:
        """The largest difference from the kernel between any two rows; 1 for a map that was made without rows."""
        if not self.dim:
            return 1.0
        mapped = self.apply(dense)
        return float(np.abs(mapped @ mapped.T - rbf(dense, dense, self.gamma)).max(initial=0))

    def settings(self) -> dict:
        return {"gamma": self.gamma, "dim": self.dim, "width": self.width, "seed": self.seed}

    def arrays(self) -> dict[str, np.ndarray]:
        return {} if self.landmarks is None else {"landmarks": self.landmarks, "turn": self.turn}

    @classmethod
    def restore(cls, settings: dict, arrays: dict[str, np.ndarray]) -> KernelMap:
        return cls(**settings, landmarks=arrays.get("landmarks"), turn=arrays.get("turn"))


def dense_rows(indices: pa.Array, values: pa.Array, dim: int) -> np.ndarray:
    """Sparse vectors (no row null) as one matrix."""
    lengths = values.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), dim))
    out[np.repeat(np.arange(len(lengths)), lengths), indices.flatten().to_numpy()] = values.flatten().to_numpy()
    return out


def _chunks(indices: pa.Array, values: pa.Array, dim: int) -> Iterator[np.ndarray]:
    for at in range(0, len(values), _CHUNK):
        yield dense_rows(indices.slice(at, _CHUNK), values.slice(at, _CHUNK), dim)


def map_udf(kernel_map: KernelMap):
    """UDF: (indices, values) of a sparse vector -> its mapped features."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def features(indices: pa.Array, values: pa.Array) -> pa.Array:
        blocks = [kernel_map.apply(x) for x in _chunks(indices, values, kernel_map.dim)]
        flat = np.concatenate(blocks).ravel() if blocks else np.empty(0)
        offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * kernel_map.width)
        return pa.ListArray.from_arrays(offsets, pa.array(flat))

    return features


def decision_udf(weights: np.ndarray, dim: int, kernel_map: KernelMap | None):
    """UDF: (indices, values) of a sparse vector -> its side of a plane; `weights` end with the intercept. With a map the
    vector goes through it first, chunk by chunk, and the mapped features are never rows."""

    @F.arrow_udf(T.DoubleType())
    def decision(indices: pa.Array, values: pa.Array) -> pa.Array:
        mapped = lambda x: x if kernel_map is None else kernel_map.apply(x)
        parts = [mapped(x) @ weights[:-1] + weights[-1] for x in _chunks(indices, values, dim)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0))

    return decision
