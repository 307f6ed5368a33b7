"""Linear soft-margin classifiers, very many at a time, on the same labelled rows.

A search or a learning curve asks for hundreds or thousands of models that differ in C, in the kernel and in the rows they
see. Here they are fitted together: the weights of all models are one matrix, and each pass over the rows gives every model
its loss and gradient at its own next point. A row carries one bit per training set (cell)
and its fold, which the pass reads as weights; no training set is ever copied. With many
blocks, kernel maps that differ in gamma only have their costly part in common: it is held once for all of them, and a pass
finishes each map on its own. Passes, not models, cost jobs.

A task multiplies a block of rows with the weights of a slice of the models, see blocks; what reaches the driver has the size
of the weights, whatever the number of rows. It keeps them with a short history of each (limited-memory BFGS). Where one
block holds all rows, as with a sheet labelled by hand, a task has all it needs for the models of its slice: the same
descent then runs in the task, and one job fits everything.

The loss is the hinge, rounded off by a parabola within SMOOTH of the margin, so that its gradient has no jump.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.kernel import KernelMap, dense_rows
from corpusloom.operators.blocks import cuts, ddl, fields, numbered_batches, one_row, pieces_of, places_and_values, sweep, width
from corpusloom.operators.storage import settle_for_fits

ALL_FOLDS = -1
BLOCK_ROWS = 4096
MODELS_AT_ONCE = 128
SMOOTH = 0.1
HISTORY = 6
TOLERANCE, LEAST_GRADIENT = 1e-6, 1e-7
HALVINGS = 20
WORD_BITS = 62
HELD, SEEN, TEST = range(3)  # which rows a count is over: the model's own fold, its training set, the test rows


@dataclass(frozen=True)
class Entry:
    """One model: a kernel, C, the training set, and the fold of it that is held out."""

    kernel: str
    C: float
    gamma: float | None = None
    cell: int = 0
    fold: int = ALL_FOLDS

    @property
    def map(self) -> tuple[str, float | None]:
        return self.kernel, self.gamma


@dataclass
class Blocks:
    """Labelled rows as settled and cached matrices and the number of rows per cell, fold and label.

    A matrix is that of a slice of the models or, with `readers`, of all the slices that it names: those whose maps have a
    base in common.
    """

    rows: DataFrame
    maps: list[tuple[str, float | None]]
    sent_maps: Broadcast  # of each map what makes its rows out of their base; None where they are held as they are
    readers: dict[int, list[int]] | None
    slices: list[int]  # of each map: so many tasks share its models
    widths: list[int]
    blocks: int
    dim: int
    counts: np.ndarray  # cells x folds x labels

    def sizes(self, entry: Entry) -> tuple[int, int]:
        """Rows of label 0 and 1 that the entry is trained on."""
        own = self.counts[entry.cell]
        left = own.sum(axis=0) - (own[entry.fold] if entry.fold != ALL_FOLDS else 0)
        return int(left[0]), int(left[1])

    def release(self) -> None:
        self.rows.unpersist()
        self.sent_maps.unpersist()


def weight_rule(mode: str | None, sizes: dict[int, int]) -> dict[int, float]:
    """Weight per class: "count" is the class size itself, "balanced" n / (classes * size), None is 1."""
    n = sum(sizes.values())
    rule = {"count": float, "balanced": lambda s: n / (len(sizes) * s), None: lambda s: 1.0}[mode]
    return {label: rule(size) for label, size in sizes.items()}


def member_bits(words: list[list[int]], cells: int) -> np.ndarray:
    """Rows x cells from the words of WORD_BITS bits."""
    if not words:
        return np.zeros((0, cells), bool)
    packed = np.array(words, np.int64).reshape(len(words), -1)
    cell = np.arange(cells)
    return (packed[:, cell // WORD_BITS] >> (cell % WORD_BITS) & 1).astype(bool)


SCHEMA = fields(["n", "width"], ["label", "fold", "member", "test", "places", "x"])


def pack_matrix(x: np.ndarray) -> tuple[bytes, bytes]:
    """(places, values) of the cells that are not 0, or no places and all values, whichever is shorter. A pass sends every block
    to Python once more, and term weights are mostly zeros."""
    x = x.astype(np.float32)
    places = np.flatnonzero(x).astype(np.int32)
    return (places.tobytes(), x.ravel()[places].tobytes()) if 2 * len(places) < x.size else (b"", x.tobytes())


def unpack_matrix(n: int, width: int, places: bytes, values: bytes) -> np.ndarray:
    if len(values) == 8 * n * width:
        return np.frombuffer(values).reshape(n, width)
    found = np.frombuffer(values, np.float32)
    if len(found) == n * width:
        return found.reshape(n, width).astype(np.float64)
    out = np.zeros((n, width))
    out.ravel()[np.frombuffer(places, np.int32)] = found
    return out


def make_blocks(
    rows: DataFrame, maps: list[tuple[str, float | None]], kernel_maps: dict[float, KernelMap], cells: int = 1, folds: int = 1,
) -> Blocks:
    """Blocks of rows (features, label, and where they apply: fold, bits as array<long>, test as boolean).

    Without bits a row is in every cell, without fold in fold 0; a test row is in no training set. An empty table has no block,
    and every model fitted on it is zero.
    """
    has, dim, n_rows = rows.columns, width(rows), rows.count()
    bits = F.col("bits") if "bits" in has else F.lit(None).cast("array<long>")
    fold = F.col("fold") if "fold" in has else F.lit(0)
    test = F.col("test") if "test" in has else F.lit(False)
    places, values = places_and_values(dim=dim)
    plain = rows.select(
        F.col("label").cast("int").alias("label"), fold.cast("int").alias("fold"), bits.alias("bits"), test.alias("test"),
        places.alias("indices"), values.alias("values"),
    )
    own = [None if kernel == "linear" else kernel_maps[gamma] for kernel, gamma in maps]
    kinds = [None if m is None else m.kind for m in own]
    widths = [dim if m is None else m.width for m in own]
    context = rows.sparkSession.sparkContext
    cores = context.defaultParallelism
    blocks = max(1, math.ceil(n_rows / BLOCK_ROWS))
    slices = [max(1, round(4 * cores * w / max(1, sum(widths)) / blocks)) for w in widths]
    readers, pieces, block_rows = None, blocks, BLOCK_ROWS
    if blocks >= 2 * cores:
        # enough blocks for every core: a base is held once, whatever the number of maps and slices
        slices, readers = [1] * len(maps), {g: [k for k, own_kind in enumerate(kinds) if own_kind == kind] for g, kind in enumerate(dict.fromkeys(kinds))}
        pieces = pieces_of(blocks, cores)
        each = math.ceil(n_rows / pieces)
        block_rows = min(BLOCK_ROWS, math.ceil(each / math.ceil(each / BLOCK_ROWS)) + pieces)  # rows are dealt to the pieces all but evenly
    homes = {k: list(range(sum(slices[:k]), sum(slices[: k + 1]))) for k in range(len(maps))} if readers is None else {names[0]: [g] for g, names in readers.items()}

    def packed(m: KernelMap | None, dense: np.ndarray) -> tuple[int, bytes, bytes]:
        x = dense if m is None else m.apply(dense) if readers is None else m.base(dense)
        # a landmark map turns small differences of kernel values into features, so its base keeps all digits
        exact = readers is not None and m is not None and m.turn is not None
        return x.shape[1], *((b"", x.tobytes()) if exact else pack_matrix(x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in numbered_batches(batches, block_rows):
            n, words = batch.num_rows, batch.column("bits").to_pylist()
            label, fold, test = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int8) for c in ("label", "fold", "test"))
            member = np.ones((n, cells), bool) if any(w is None for w in words) else member_bits(words, cells)
            member = np.packbits(member & (test == 0)[:, None], axis=1)
            dense = dense_rows(batch.column("indices"), batch.column("values"), dim)
            for k, places in homes.items():
                columns, *matrix = packed(own[k], dense)
                for s in places:
                    yield one_row(SCHEMA, s, number, n, columns, label.tobytes(), fold.tobytes(), member.tobytes(), test.tobytes(), *matrix)

    if readers is None:
        # as many pieces as blocks: a block is full unless it is the last of its piece
        made = plain.coalesce(blocks).mapInArrow(run, ddl(SCHEMA)).repartition(pieces_of(sum(slices) * blocks, cores))
    else:
        made = plain.repartition(pieces).mapInArrow(run, ddl(SCHEMA))  # the rows are moved while they are sparse
    table = settle_for_fits(made)
    sent_maps = context.broadcast([None if m is None or readers is None else m.without_landmarks() for m in own])
    held = Blocks(table, maps, sent_maps, readers, slices, widths, table.select("block").distinct().count(), dim, np.zeros((cells, folds, 2), np.int64))
    held.counts = _count(held, cells, folds)
    return held


@dataclass
class _Block:
    """A block as arrays. With `turn` the rows of a map are x @ turn, which is multiplied with weights before x is."""

    x: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    member: np.ndarray
    test: np.ndarray
    turn: np.ndarray | None = None

    @classmethod
    def read(cls, row: dict, cells: int, kernel_map: KernelMap | None) -> _Block:
        label, fold, test = (np.frombuffer(row[c], np.int8) for c in ("label", "fold", "test"))
        bits = np.unpackbits(np.frombuffer(row["member"], np.uint8).reshape(row["n"], -1), axis=1, count=cells).astype(bool)
        x = unpack_matrix(row["n"], row["width"], row["places"], row["x"])
        if kernel_map is None:
            return cls(x, label, fold, bits, test.astype(bool))
        return cls(kernel_map.unturned(x), label, fold, bits, test.astype(bool), kernel_map.turn)

    def planes(self, weights: np.ndarray) -> np.ndarray:
        """Planes over the features as planes over x."""
        return weights[:, :-1] if self.turn is None else weights[:, :-1] @ self.turn.T


def _pass(held: Blocks, work, sent: dict[int, object], numbers: int) -> dict[int, np.ndarray]:
    cells, sent_maps, readers = len(held.counts), held.sent_maps, held.readers
    map_of = np.repeat(np.arange(len(held.maps)), held.slices).tolist()
    # blocks of slices whose models are all done stay in the cache and are not sent to Python
    read, every = (list(sent), sum(held.slices)) if readers is None else ([g for g, own in readers.items() if any(s in sent for s in own)], len(readers))
    rows = held.rows if len(read) == every else held.rows.where(F.col("slice").isin(read))

    def one(row: dict, given) -> np.ndarray:
        k, own = given
        return work(_Block.read(row, cells, sent_maps.value[k]), own)

    return sweep(rows, held.blocks, {s: (map_of[s], own) for s, own in sent.items()}, one, numbers, readers)


def _count(held: Blocks, cells: int, folds: int) -> np.ndarray:
    def work(block: _Block, _) -> np.ndarray:
        out = np.zeros((cells, folds, 2))
        for f in range(folds):
            for label in (0, 1):
                out[:, f, label] = block.member[(block.fold == f) & (block.label == label)].sum(axis=0)
        return out.ravel()

    total = _pass(held, work, {0: True}, cells * folds * 2).get(0)
    return np.zeros((cells, folds, 2), np.int64) if total is None else total.reshape(cells, folds, 2).astype(np.int64)


class Descent:
    """Limited-memory BFGS for many functions of the same width, each with its own step: every pass evaluates all that are left."""

    def __init__(self, start: np.ndarray, ridge: np.ndarray, max_iter: int, live: np.ndarray):
        m, d = start.shape
        self.x, self.ridge, self.max_iter, self.live = start.copy(), ridge, max_iter, live.copy()
        self.value, self.gradient, self.direction = np.full(m, np.inf), np.zeros((m, d)), np.zeros((m, d))
        self.step, self.halved, self.accepted = np.ones(m), np.zeros(m, int), np.zeros(m, int)
        self.moves, self.changes, self.scale = np.zeros((HISTORY, m, d)), np.zeros((HISTORY, m, d)), np.zeros((HISTORY, m))
        self.at = np.zeros(m, int)

    def trial(self) -> tuple[np.ndarray, np.ndarray]:
        own = np.flatnonzero(self.live)
        return own, self.x[own] + self.step[own, None] * self.direction[own]

    def take(self, own: np.ndarray, point: np.ndarray, found: np.ndarray) -> None:
        """`found` has per trial point the gradient and the value without the ridge, which leaves the intercept free."""
        flat = point.copy()
        flat[:, -1] = 0
        value = found[:, -1] + self.ridge[own] / 2 * np.einsum("ij,ij->i", flat, flat)
        gradient = found[:, :-1] + self.ridge[own, None] * flat
        new = np.isinf(self.value[own])
        slope = np.einsum("ij,ij->i", self.gradient[own], self.direction[own])
        before = np.where(new, 0.0, self.value[own])
        good = new | (value <= before + 1e-4 * self.step[own] * slope)
        bad = own[~good]
        t, over = self.step[bad], value[~good] - before[~good] - slope[~good] * self.step[bad]
        fit = -slope[~good] * t * t / np.maximum(2 * over, 1e-300)  # where a parabola through both values has its minimum
        self.step[bad] = np.clip(fit, 0.1 * t, 0.5 * t)
        self.halved[bad] += 1
        self.live[bad[self.halved[bad] > HALVINGS]] = False

        ok = own[good]
        moved, changed = point[good] - self.x[ok], gradient[good] - self.gradient[ok]
        inner = np.einsum("ij,ij->i", moved, changed)
        useful = ~new[good] & (inner > 1e-10 * np.einsum("ij,ij->i", changed, changed))
        k = ok[useful]
        self.moves[self.at[k] % HISTORY, k], self.changes[self.at[k] % HISTORY, k] = moved[useful], changed[useful]
        self.scale[self.at[k] % HISTORY, k] = 1 / inner[useful]
        self.at[k] += 1
        gain = before[good] - value[good]
        done = ~new[good] & (gain <= TOLERANCE * np.maximum(np.abs(before[good]), np.abs(value[good])))
        self.x[ok], self.value[ok], self.gradient[ok] = point[good], value[good], gradient[good]
        self.accepted[ok] += ~new[good]
        done |= (np.abs(gradient[good]).max(axis=1, initial=0) <= LEAST_GRADIENT) | (self.accepted[ok] >= self.max_iter)
        self.live[ok[done]] = False
        self._aim(ok[~done])

    def _aim(self, own: np.ndarray) -> None:
        q = self.gradient[own].copy()
        if not len(own):
            return
        kept, alpha = np.minimum(self.at[own], HISTORY), np.zeros((HISTORY, len(own)))
        for h in range(int(kept.max())):
            slot = (self.at[own] - 1 - h) % HISTORY
            alpha[h] = np.where(h < kept, self.scale[slot, own] * np.einsum("ij,ij->i", self.moves[slot, own], q), 0)
            q -= alpha[h][:, None] * self.changes[slot, own]
        last = (self.at[own] - 1) % HISTORY
        last_change = self.changes[last, own]
        size = np.einsum("ij,ij->i", last_change, last_change) * self.scale[last, own]
        first = 1 / np.maximum(np.linalg.norm(self.gradient[own], axis=1), 1e-12)
        q *= np.where(kept > 0, 1 / np.maximum(size, 1e-300), np.minimum(first, 1.0))[:, None]
        for h in reversed(range(int(kept.max()))):
            slot = (self.at[own] - 1 - h) % HISTORY
            beta = self.scale[slot, own] * np.einsum("ij,ij->i", self.changes[slot, own], q)
            q += np.where(h < kept, alpha[h] - beta, 0)[:, None] * self.moves[slot, own]
        uphill = np.einsum("ij,ij->i", q, self.gradient[own]) <= 0
        q[uphill] = self.gradient[own][uphill]
        self.direction[own], self.step[own], self.halved[own] = -q, 1.0, 0


def _gradient(block: _Block, given) -> np.ndarray:
    """Models x (gradient, its intercept, loss) of the weighted rounded hinge."""
    weights, (cell, fold, light, heavy, _) = given
    cell = cell.astype(np.int64)
    positive = (block.label == 1)[:, None]
    part = block.member[:, cell] & ((block.fold[:, None] != fold) | (fold == ALL_FOLDS))
    rows = np.flatnonzero(part.any(axis=1))
    if 4 * len(rows) > 3 * len(part):
        rows = slice(None)  # a copy of most of the block costs more than rows of no weight
    x, part, sign = block.x[rows], part[rows], np.where(positive[rows], 1.0, -1.0)
    margin = sign * (x @ block.planes(weights).T + weights[:, -1])
    share = part * np.where(positive[rows], heavy, light)
    slope = np.clip((1 + SMOOTH - margin) / (2 * SMOOTH), 0, 1)
    loss = (share * np.where(slope < 1, SMOOTH * slope * slope, 1 - margin)).sum(axis=0)
    pull = -sign * share * slope
    drawn = pull.T @ x
    return np.hstack([drawn if block.turn is None else drawn @ block.turn, pull.sum(axis=0)[:, None], loss[:, None]])


def _fit_here(block: _Block, given) -> np.ndarray:
    """The models of a slice, fitted on a block that holds all rows."""
    start, facts, max_iter = given
    out = np.zeros_like(start)
    for at in range(0, len(start), MODELS_AT_ONCE):
        part = slice(at, at + MODELS_AT_ONCE)
        own = facts[:, part]
        descent = Descent(start[part], own[4], max_iter, own[2:4].any(axis=0))
        while descent.live.any():
            live, points = descent.trial()
            descent.take(live, points, _gradient(block, (points, own[:, live])))
        out[part] = descent.x
    return out


def _per_map(entries: list[Entry], held: Blocks) -> list[list[int]]:
    place = {m: k for k, m in enumerate(held.maps)}
    own: list[list[int]] = [[] for _ in held.maps]
    for i, e in enumerate(entries):
        own[place[e.map]].append(i)
    return own


def _sliced(held: Blocks, k: int, n: int) -> list[tuple[int, int, int]]:
    """(slice, from, to) of n models of map k."""
    first = sum(held.slices[:k])
    return [(first + i, a, b) for i, (a, b) in enumerate(cuts(n, held.slices[k])) if b > a]


def _shares(entries: list[Entry], held: Blocks, mode: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per model the weight of a row of label 0 and 1, both over the sum of weights, and the strength of the ridge."""
    light, heavy, ridge = np.zeros(len(entries)), np.zeros(len(entries)), np.ones(len(entries))
    for i, e in enumerate(entries):
        sizes = {label: n for label, n in enumerate(held.sizes(e)) if n}
        weights = weight_rule(mode, sizes)
        total = sum(weights[k] * n for k, n in sizes.items())
        if total:
            light[i], heavy[i], ridge[i] = weights.get(0, 0) / total, weights.get(1, 0) / total, 1 / (e.C * total)
    return light, heavy, ridge


def fit_many(
    held: Blocks, entries: list[Entry], weight_mode: str | None = "balanced", max_iter: int = 100, start: list[np.ndarray] | None = None,
) -> list[np.ndarray]:
    """Weights with the intercept last, per entry: the minimum of |w|^2 / (2 C W) + sum of weighted losses / W, where W is the sum
    of the weights. C has its usual meaning. An entry without rows gets zeros. `start` holds first guesses."""
    shares, cell, fold = _shares(entries, held, weight_mode), np.array([e.cell for e in entries], np.int64), np.array([e.fold for e in entries], np.int64)
    out = [np.zeros(held.widths[held.maps.index(e.map)] + 1) if start is None else start[i] for i, e in enumerate(entries)]
    facts = np.array([cell, fold, *shares])
    own = _per_map(entries, held)
    if held.blocks == 1:
        sent, placed = {}, {}
        for k, ids in enumerate(own):
            for s, a, b in _sliced(held, k, len(ids)):
                placed[s] = ids[a:b]
                sent[s] = np.array([out[i] for i in ids[a:b]]), facts[:, ids[a:b]], max_iter
        for s, flat in _pass(held, _fit_here, sent, sum(w.size for w in out)).items():
            for i, w in zip(placed[s], flat.reshape(len(placed[s]), -1), strict=True):
                out[i] = w
        return out
    first = [np.array([out[i] for i in ids]).reshape(len(ids), w + 1) for ids, w in zip(own, held.widths, strict=True)]
    descents = [Descent(x, facts[4, ids], max_iter, facts[2:4, ids].any(axis=0)) for x, ids in zip(first, own, strict=True)]
    while any(d.live.any() for d in descents):
        sent, asked = {}, []
        for k, descent in enumerate(descents):
            live, points = descent.trial()
            asked.append((live, points))
            for s, a, b in _sliced(held, k, len(live)):
                sent[s] = points[a:b], facts[:, np.array(own[k])[live[a:b]]]
        found = _pass(held, _gradient, sent, sum(points.size + len(live) for live, points in asked))
        for k, (descent, (live, points)) in enumerate(zip(descents, asked, strict=True)):
            if len(live):
                descent.take(live, points, np.concatenate([found[s].reshape(b - a, -1) for s, a, b in _sliced(held, k, len(live))]))
    for ids, descent in zip(own, descents, strict=True):
        for i, w in zip(ids, descent.x, strict=True):
            out[i] = w
    return out


def _confusion(block: _Block, given) -> np.ndarray:
    """Models x (HELD, SEEN, TEST) x (tp, fp, fn, tn)."""
    weights, cell, fold = given
    hit = block.x @ block.planes(weights).T + weights[:, -1] > 0
    yes, member = (block.label == 1)[:, None], block.member[:, cell]
    inside = block.fold[:, None] == fold
    over = [member & inside, member & (~inside | (fold == ALL_FOLDS)), np.broadcast_to(block.test[:, None], hit.shape)]
    cells = [(yes & hit), (~yes & hit), (yes & ~hit), (~yes & ~hit)]
    return np.array([[(o & c).sum(axis=0) for c in cells] for o in over], np.float64).transpose(2, 0, 1)


def count_many(held: Blocks, entries: list[Entry], weights: list[np.ndarray]) -> np.ndarray:
    """Entries x (HELD, SEEN, TEST) x (tp, fp, fn, tn), in one pass."""
    sent, placed = {}, {}
    for k, ids in enumerate(_per_map(entries, held)):
        for s, a, b in _sliced(held, k, len(ids)):
            one = ids[a:b]
            sent[s] = np.array([weights[i] for i in one]), np.array([entries[i].cell for i in one]), np.array([entries[i].fold for i in one])
            placed[s] = one
    out = np.zeros((len(entries), 3, 4))
    for s, total in _pass(held, _confusion, sent, out.size).items():
        out[placed[s]] = total.reshape(-1, 3, 4)
    return out.astype(np.int64)


def f1_of(counts: np.ndarray) -> np.ndarray:
    """F1 of class 1 from (tp, fp, fn, tn) along the last axis; 0 where there is nothing to find and nothing found."""
    tp, fp, fn = counts[..., 0], counts[..., 1], counts[..., 2]
    return np.where(2 * tp + fp + fn > 0, 2 * tp / np.maximum(2 * tp + fp + fn, 1), 0.0)
