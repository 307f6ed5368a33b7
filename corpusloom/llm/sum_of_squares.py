"""Sum-of-squares packing of tokenised documents into sequences of fixed length.

A piece is placed where the sum over all residual gaps g of (number of open sequences with gap g) squared becomes
smallest. That keeps the gaps varied, so that the pieces to come find one that fits.

Only lengths are packed, and packing is spread: pieces are dealt to groups by a hash, each group is packed on its own,
and what lies in sequences that stayed open is dealt to fewer groups and packed again, until one group is left to pack.
A group has a bounded number of pieces at the first level, and each further level takes only the open sequences of the
level before it.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.pretokens import BYTE_BPE, word_ids
from corpusloom.operators.storage import settle

PIECES = "piece int, start long, length long, ids_crc32 long"
GROUP_PIECES = 40_000
MOST_LEVELS = 64
SHRINKING = 0.8  # a further level has to start with at most this share of the pieces of the one before


def cut_places(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document. Only the first piece of a long document may be shorter."""
    first = total % capacity or capacity
    starts = [0, *range(first, total, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], total], strict=True)]


def token_pieces(
    docs: DataFrame, capacity: int = 2048, end_id: int = 0, text: str = "text", id_col: str = "doc_id",
    tokenizer: str = BYTE_BPE,
) -> DataFrame:
    """One row per piece of each document: the document's ids and one end id, cut only if longer than a sequence."""
    schema = T.StructType([docs.schema[id_col], *T._parse_datatype_string(PIECES).fields])
    end = np.array([end_id], "<u4").tobytes()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        for batch in rows:
            out = []
            for key, ids in zip(batch.column(0), encoder.encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids += end
                for i, (start, n) in enumerate(cut_places(len(ids) // 4, capacity)):
                    out.append((key.as_py(), i, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            types = [batch.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema.names)

    return docs.select(id_col, text).mapInArrow(run, schema)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, taken in the order given, and the gap left in each sequence."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences per gap; closed ones (gap 0) do not count
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps: list[int] = []
    number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        fitting = count[n : capacity + 1]
        change = 2 * (count[: capacity + 1 - n] - fitting + 1)
        change[0] = 1 - 2 * fitting[0]
        change[fitting == 0] = np.iinfo(np.int64).max
        at = int(change.argmin())  # of equal places the tightest
        fresh = 2 * count[capacity - n] + 1 if n < capacity else 0
        if len(change) and fitting[at] and change[at] <= fresh:
            gap = n + at
            k = waiting[gap].pop()
            count[gap] -= 1
        else:
            gap, k = capacity, len(gaps)
            gaps.append(capacity)
        number[i], offset[i] = k, capacity - gap
        gaps[k] = gap - n
        if gap > n:
            count[gap - n] += 1
            waiting[gap - n].append(k)
    return number, offset, np.array(gaps, np.int64)


def packing_order(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Longest first, and what is shorter than an eighth of a sequence last, in a fixed shuffled order.

    The rule of squares expects mixed lengths; long pieces at the end would find no place, short ones nearly always do.
    """
    order = np.argsort(-lengths, kind="stable")
    long = int((lengths > capacity // 8).sum())
    order[long:] = np.random.default_rng(0).permutation(order[long:])
    return order


def _pack_group(group: pd.DataFrame, capacity: int, keys: list[str]) -> pd.DataFrame:
    group = group.sort_values(["length", *keys], kind="stable", ignore_index=True)
    group = group.iloc[packing_order(group["length"].to_numpy(), capacity)]
    number, offset, gaps = place(group["length"].to_numpy(), capacity)
    return group.assign(_number=number, offset=offset, _full=gaps[number] == 0)


def pack(
    pieces: DataFrame, capacity: int = 2048, keys: tuple[str, ...] = ("doc_id", "piece"), group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """Adds sequence_id and offset to every piece; offsets in a sequence leave no gap.

    Repeated rows are packed as often as they occur. Ties are broken by the key columns, and rows that agree in all of
    them are interchangeable. A length outside 1..capacity is an error. An empty table gives an empty table. Levels end
    when one group holds all open sequences, or when dealing anew no longer fills a fifth of them.
    """
    bad = (F.col("length") < 1) | (F.col("length") > capacity) | F.col("length").isNull()
    checked = F.when(bad, F.raise_error(F.lit("a piece has 1 to capacity tokens")).cast("long")).otherwise(F.col("length"))
    left = settle(pieces.drop("_group", "_number", "_full", "offset", "sequence_id").withColumn("length", checked))
    added = T._parse_datatype_string("_group long, _number long, offset long, _full boolean").fields
    schema = T.StructType([*left.schema.fields, *added])
    names, levels, n = left.columns, [], left.count()
    while True:
        groups, level = max(1, -(-n // group_pieces)), len(levels)
        row = F.xxhash64(F.monotonically_increasing_id(), F.lit(level))  # stable: the rows are settled
        dealt = left.withColumn("_group", F.pmod(row, F.lit(groups)))
        done = settle(dealt.groupBy("_group").applyInPandas(lambda g: _pack_group(g, capacity, list(keys)), schema))
        sequence = F.col("_number") * (groups * MOST_LEVELS) + F.col("_group") * MOST_LEVELS + level
        done = done.withColumn("sequence_id", sequence)
        open_ = done.where(~F.col("_full")).count()
        if groups == 1 or open_ > SHRINKING * n or level == MOST_LEVELS - 1:
            levels.append(done)
            break
        levels.append(done.where("_full"))
        left, n = done.where(~F.col("_full")).select(*names), open_
    placed = [d.select(*names, "sequence_id", "offset") for d in levels]
    return functools.reduce(DataFrame.unionByName, placed)
