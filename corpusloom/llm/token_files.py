"""Token ids on disk: every document compressed on its own with one shared zstandard dictionary.

A folder holds two Parquet tables. `dictionary` has one row: the dictionary trained on serialised id arrays of some
documents, its SHA-256 and the width of an id. `shards` has a row per block of consecutive documents in ascending id
order: the frames of the documents one after the other, and per document its id, the offset and size of its frame and
its number of tokens, with the lowest and the highest id and the hash of the dictionary that the frames need. A short document is read from its block by
slicing one frame. Spark's committer writes the tables, so a lost executor leaves no half-written file behind.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.pretokens import BYTE_BPE, batches, tokenizer_file, word_ids

SAMPLE_DOCS = 1_000  # bound of the sample that the dictionary is trained on, with SAMPLE_CHARS per document
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 64 << 10
BLOCK_BYTES = 4 << 20


def id_type(tokenizer: str) -> str:
    """Narrowest little-endian unsigned type for the ids of a vocabulary."""
    spec = tokenizer_file(tokenizer)
    largest = max([*spec["model"]["vocab"].values(), *[t["id"] for t in spec["added_tokens"]]])
    return "<u2" if largest < 1 << 16 else "<u4"


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the samples' own bytes where there are too few to train on."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _sampled(docs: DataFrame, text: str, tokenizer: str, dtype: str) -> list[bytes]:
    short = docs.where(F.length(text).between(1, SAMPLE_CHARS)).select(text)
    share = min(1.0, 3 * SAMPLE_DOCS / max(1, docs.count()))
    texts = [r[0] for r in short.sample(share, seed=1).limit(SAMPLE_DOCS).collect()]
    return list(word_ids(tokenizer, dtype).encode(texts))


def _shard_type(id_field: T.StructField) -> T.StructType:
    arrays = [T.StructField("ids", T.ArrayType(id_field.dataType))]
    arrays += [T.StructField(n, T.ArrayType(T.LongType())) for n in ("offsets", "sizes", "tokens")]
    numbers = [T.StructField(n, T.LongType()) for n in ("part", "first_start", "n_tokens")]
    numbers += [T.StructField(n, id_field.dataType) for n in ("least_id", "greatest_id")]
    return T.StructType([*numbers, T.StructField("dictionary_sha256", T.StringType()), *arrays, T.StructField("frames", T.BinaryType())])


def _block(part: int, written: int, digest: str, docs: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    keys, frames, tokens = map(list, zip(*docs, strict=True))
    sizes = [len(f) for f in frames]
    offsets = [sum_ - n for sum_, n in zip(itertools.accumulate(sizes), sizes, strict=True)]
    numbers = {"part": part, "first_start": written, "n_tokens": sum(tokens)}
    columns = {k: pa.array([v], pa.int64()) for k, v in numbers.items()}
    known = [k for k in keys if k is not None]  # in ascending order
    columns |= {"least_id": pa.array(known[:1] or [None], id_type), "greatest_id": pa.array(known[-1:] or [None], id_type)}
    columns |= {"dictionary_sha256": pa.array([digest]), "ids": pa.array([keys], pa.list_(id_type))}
    columns |= {k: pa.array([v], pa.list_(pa.int64())) for k, v in (("offsets", offsets), ("sizes", sizes), ("tokens", tokens))}
    return pa.RecordBatch.from_pydict(columns | {"frames": pa.array([b"".join(frames)], pa.binary())})


def write_token_files(
    docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id", tokenizer: str = BYTE_BPE, end_id: int = 2,
    block_bytes: int = BLOCK_BYTES,
) -> None:
    """Write the ids of all documents, each followed by the end id, in ascending order of the id column.

    A null text is written as an empty one, an empty one as the end id alone. Null ids come first; documents that share
    an id stay in the order of their texts. Further columns are not written. An empty table gives an index without rows.
    """
    spark, dtype = docs.sparkSession, id_type(tokenizer)
    shared = train_dictionary(_sampled(docs, text, tokenizer, dtype))
    digest = hashlib.sha256(shared).hexdigest()
    spark.createDataFrame([(digest, shared, dtype)], "sha256 string, data binary, id_type string").coalesce(1).write.parquet(f"{path}/dictionary")
    sent = spark.sparkContext.broadcast(shared)
    end, schema = np.array([end_id], dtype).tobytes(), _shard_type(docs.schema[id_col])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer, dtype)
        packer = zstandard.ZstdCompressor(dict_data=_dictionary(sent.value))
        part, written, waiting, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in rows:
            id_type = batch.schema.field(0).type
            keys = batch.column(0).to_pylist()
            for key, ids in zip(keys, encoder.encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids += end
                waiting.append((key, packer.compress(ids), len(ids) // len(end)))
                size += len(waiting[-1][1])
                if size >= block_bytes:
                    yield _block(part, written, digest, waiting, id_type)
                    written += sum(n for *_, n in waiting)
                    waiting, size = [], 0
        if waiting:
            yield _block(part, written, digest, waiting, id_type)

    ranged = docs.select(id_col, text).repartitionByRange(id_col).sortWithinPartitions(id_col, text)
    ranged.mapInArrow(run, schema).write.parquet(f"{path}/shards")


def _read_dictionary(spark: SparkSession, path: str) -> tuple[str, bytes, str]:
    row = spark.read.parquet(f"{path}/dictionary").collect()[0]
    if hashlib.sha256(row["data"]).hexdigest() != row["sha256"]:
        raise ValueError(f"the dictionary in {path} is damaged")
    return row["sha256"], bytes(row["data"]), row["id_type"]


def _may_hold(only: list) -> Column:
    """Whether the range of a block's ids holds one of these; blocks with a null id have to be looked into for a null."""
    near = [(F.col("least_id") <= k) & (F.col("greatest_id") >= k) for k in sorted({k for k in only if k is not None})]
    if None in only:
        near.append(F.exists("ids", lambda k: k.isNull()))
    return functools.reduce(operator.or_, near, F.lit(False))


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", only: list | None = None) -> DataFrame:
    """One row per document: id, start (ids of all documents before it), n_tokens and the ids, 4 bytes each.

    With `only`, a scan skips the blocks whose lowest and highest id leave none of these ids between them, by the file's own
    statistics, and just the frames asked for are decompressed. A null in `only` asks for documents without an id.
    """
    digest, shared, dtype = _read_dictionary(spark, path)
    shards = spark.read.parquet(f"{path}/shards")
    # one row per task that wrote, so this window is small however many documents there are
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    if only is not None:
        shards = shards.where(_may_hold(only))
    placed = shards.join(F.broadcast(starts), "part").withColumn("first_start", F.col("first_start") + F.col("part_start"))
    key_type = shards.schema["ids"].dataType.elementType
    numbers = T._parse_datatype_string("start long, n_tokens long, token_ids binary").fields
    schema, wanted = T.StructType([T.StructField(id_col, key_type), *numbers]), None if only is None else set(only)
    sent = spark.sparkContext.broadcast(shared)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(sent.value))
        for batch in rows:
            kind = batch.column("ids").type.value_type
            for block in batch.to_pylist():
                if block["dictionary_sha256"] != digest:
                    raise ValueError("a block was written with another dictionary")
                starts = [block["first_start"] + t - n for t, n in zip(itertools.accumulate(block["tokens"]), block["tokens"], strict=True)]
                out = []
                for key, start, offset, size, n in zip(block["ids"], starts, block["offsets"], block["sizes"], block["tokens"], strict=True):
                    if wanted is None or key in wanted:
                        ids = np.frombuffer(unpacker.decompress(block["frames"][offset : offset + size]), dtype).astype("<u4")
                        if len(ids) != n:
                            raise ValueError("a frame has another number of ids than its index")
                        out.append((key, start, n, ids.tobytes()))
                for group in batches(out, lambda r: len(r[3]), 8 << 20):
                    columns = zip(*group, strict=True)
                    types = (kind, pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema.names)

    return placed.select("first_start", "dictionary_sha256", "ids", "offsets", "sizes", "tokens", "frames").mapInArrow(run, schema)
