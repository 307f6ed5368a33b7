"""Passes over feature rows held as matrices, for fits that read the same rows again and again.

Rows lie in blocks: one row of a table per block, with the matrix in a binary column. A pass computes one array per slice
of the models in every block; the arrays are summed by a tree of grouped sums, so no task and not the driver gets more than
FAN_IN arrays of a slice at once, however many rows there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_IN = 64
DRIVER_BYTES = 64 << 20  # of arrays that the driver adds up itself
PIECES_A_TASK = 4
_DDL = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}


def places_and_values(features: str = "features", dim: int | None = None) -> tuple[Column, Column]:
    """Indices and values of a vector column; with `dim` the indices of dense vectors too."""
    raw = F.unwrap_udt(features)
    places = raw["indices"] if dim is None else F.coalesce(raw["indices"], F.sequence(F.lit(0), F.lit(dim - 1)))
    return places, raw["values"]


def width(df: DataFrame, features: str = "features") -> int:
    """Length of the vectors, read from one of them; 0 without rows."""
    raw = F.unwrap_udt(features)
    first = df.select(F.coalesce(raw["size"], F.size(raw["values"])).alias("n")).first()
    return first.n if first else 0


def numbered_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a task in pieces of `rows` rows (the last may be shorter), each with a number that no other task gives."""
    from pyspark import TaskContext

    number, held, n = TaskContext.get().partitionId() << 33, [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        while n >= rows:
            whole = pa.concat_batches(held)
            yield number, whole.slice(0, rows)
            number, held, n = number + 1, [whole.slice(rows)], n - rows
    if n:
        yield number, pa.concat_batches(held)


def fields(ints: list[str], binaries: list[str]) -> pa.Schema:
    """Columns of a table of blocks: slice, block, whole numbers, and bytes."""
    return pa.schema([("slice", pa.int32()), ("block", pa.int64()), *((c, pa.int32()) for c in ints), *((c, pa.binary()) for c in binaries)])


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


def one_row(schema: pa.Schema, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def pack_rows(places: pa.Array, values: pa.Array) -> tuple[bytes, bytes, bytes]:
    """Sparse vectors of a block as bytes: lengths, places and values."""
    lengths = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
    flat = places.flatten().to_numpy(zero_copy_only=False).astype(np.int32), values.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return lengths.tobytes(), flat[0].tobytes(), flat[1].tobytes()


def unpack_rows(row: dict) -> np.ndarray:
    """The matrix of a block with the columns width, lengths, places and values."""
    lengths = np.frombuffer(row["lengths"], np.int32)
    out = np.zeros((len(lengths), row["width"]))
    out[np.repeat(np.arange(len(lengths)), lengths), np.frombuffer(row["places"], np.int32)] = np.frombuffer(row["values"], np.float32)
    return out


EVERY_SLICE = -1
LEAST_SLICES = 8


def copies_of_blocks(blocks: int, cores: int) -> tuple[int, list[int]]:
    """(slices of the models, the slices that a block is written for).

    Few blocks are copied, so that every core has a slice of the models to work on; many blocks keep all cores busy as they
    are. The sums of each slice meet in a task of their own either way.
    """
    slices = max(LEAST_SLICES, round(2 * cores / blocks))
    return slices, [EVERY_SLICE] if blocks >= cores else list(range(slices))


def pieces_of(written: int, cores: int) -> int:
    """Tasks for so many written blocks: each gets few enough to hold them all at once."""
    return min(written, max(4 * cores, math.ceil(written / PIECES_A_TASK)))


def deal(sizes: list[int], slices: int) -> list[list[int]]:
    """Numbers of the models of each slice, the largest first to the slice that has least to do."""
    own: list[list[int]] = [[] for _ in range(slices)]
    load = [0] * slices
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        s = load.index(min(load))
        own[s].append(i)
        load[s] += sizes[i]
    return own


_PARTIAL = pa.schema([("slice", pa.int32()), ("part", pa.int64()), ("total", pa.binary())])
PARTIAL = ddl(_PARTIAL)


def _add(group: pd.DataFrame) -> pd.DataFrame:
    parts = group.sort_values("before")
    total = np.sum([np.frombuffer(b) for b in parts["total"]], axis=0)
    return parts.iloc[:1][["slice", "part"]].assign(total=[total.tobytes()])


def _value(cell: pa.Scalar) -> object:
    return cell.as_buffer() if hasattr(cell, "as_buffer") else cell.as_py()


def sweep(
    held: DataFrame, blocks: int, sent: dict[int, object], work: Callable[[dict, object], np.ndarray], numbers: int | None = None,
    readers: dict[int, list[int]] | None = None,
) -> dict[int, np.ndarray]:
    """work(row of `held` as a dict, sent[slice]) summed over all blocks, for every slice that has something sent.

    `held` has the columns slice, or EVERY_SLICE, and block; `blocks` says about how many blocks there are. What is sent
    is broadcast: it has the size of the models' parameters. Binary columns reach `work` as buffers. `numbers` says how many
    numbers all the sums have: where those of all blocks fit DRIVER_BYTES, the driver adds them and no shuffle is made. With
    `readers`, the number in the column slice stands for all the slices that it names.
    """
    broadcast = held.sparkSession.sparkContext.broadcast(sent)
    names = held.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: _value(column[i]) for name, column in zip(names, batch.columns, strict=True)}
                own = [row["slice"]] if readers is None else readers[row["slice"]]
                for s in broadcast.value if row["slice"] == EVERY_SLICE else [s for s in own if s in broadcast.value]:
                    got = work(row, broadcast.value[s])
                    if s in sums:
                        sums[s][1] += got
                    else:
                        sums[s] = [row["block"], got.astype(np.float64)]
        for s, (block, total) in sums.items():
            yield one_row(_PARTIAL, s, block, total.tobytes())

    rows = held.mapInArrow(run, PARTIAL)
    if numbers is not None and blocks <= FAN_IN and blocks * numbers * 8 <= DRIVER_BYTES:
        found = {}
        for r in sorted(rows.collect(), key=lambda r: (r["slice"], r["part"])):
            found[r["slice"]] = found.get(r["slice"], 0) + np.frombuffer(r["total"])
        broadcast.destroy()
        return found
    parts = blocks
    while parts > 1:
        parts = math.ceil(parts / FAN_IN)
        dealt = rows.withColumn("before", F.col("part")).withColumn("part", F.pmod(F.xxhash64("part"), F.lit(parts)))
        rows = dealt.groupBy("slice", "part").applyInPandas(_add, PARTIAL)
    found = {r["slice"]: np.frombuffer(r["total"]) for r in rows.collect()}
    broadcast.destroy()
    return found


def cuts(n: int, pieces: int) -> list[tuple[int, int]]:
    """range(n) in `pieces` consecutive parts."""
    ends = [n * i // pieces for i in range(pieces + 1)]
    return list(zip(ends[:-1], ends[1:], strict=True))
