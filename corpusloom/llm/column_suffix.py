"""Removal of repeated byte strings by suffix sorting of many documents, column by column.

Every string of WINDOW bytes that starts at two or more places is found, in four steps.

1. Each window names the lowest hash among its byte grams, so equal windows name the same gram. The windows that
   name one occurrence of a gram are neighbours; with the bytes that they cover they are a context. Contexts of grams
   that occur once hold nothing that repeats and are dropped, as are copies of whole texts, which are counted instead.
2. Contexts of one gram with the same bytes are a class: all windows of a class of two or more repeat. One context of
   every class goes on, if its gram has another class and any class of one.
3. The contexts of a gram meet in one task. They are the documents of a collection whose Burrows-Wheeler transform is
   built column-wise: a document is read as symbols of SYMBOL bytes, once for every phase, and each round inserts the
   next symbol from the right of every document into the sorted list of all suffixes so far. The list lies in a file
   that a round reads from front to back while it writes the next one. Common prefixes are then found by one pass per
   symbol of a window.
4. A gram with very many classes would make a collection too large for a task. Its contexts are cut into parts by the
   place of the gram in the window, and a part is named anew by the bytes that all windows of that place have in common.
   Parts are classed like contexts, and those that are still too many are cut again, to single windows if need be.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.storage import save_artifact, scratch_path, settle

WINDOW, GRAM, SYMBOL = 400, 128, 50
COLLECTION_BYTES = 2_000_000
MOST_CONTEXTS = 4_096  # different ones of one gram in one task
SALTS = 16
SEGMENT = 1 << 23  # bytes of a text looked at together
BLOCK = 1 << 18  # rows of the suffix file read together

ROW = np.dtype([("first", "<i4"), ("rest", "<i4"), ("before", "<i4")])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def string_hashes(data: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of the `width` bytes from each place on, put together from hashes of runs of 1, 2, 4, ... bytes."""
    run, size = _mix(data.astype(np.uint64) + np.uint64(1 + 257 * seed)), 1
    out, done = None, 0
    while size <= width:
        if width & size:
            if out is None:
                out = run
            else:
                n = min(len(out), len(run) - done)
                out = _mix(out[:n] * np.uint64(0xD6E8FEB86659FD93) + run[done : done + n])
            done += size
        if size * 2 <= width:
            run = _mix(run[:-size] * np.uint64(0xA0761D6478BD642F) + run[size:]) if len(run) > size else run[:0]
        size *= 2
    return out[: max(0, len(data) - width + 1)]


def window_grams(data: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(hash, place, first window, last window) of every gram that windows name: the lowest, and of equal ones the left."""
    n = len(data) - window + 1
    if n <= 0:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    parts = []
    for begin in range(0, n, SEGMENT):
        piece = data[begin : begin + SEGMENT + window - 1]
        hashes = string_hashes(piece, gram)
        low = (hashes & ~np.uint64(SEGMENT * 2 - 1)) | np.arange(len(hashes), dtype=np.uint64)
        width, wanted = 1, window - gram + 1
        while width * 2 <= wanted:
            low, width = np.minimum(low[:-width], low[width:]), width * 2
        rest = wanted - width
        low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
        starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        place = (low[starts] & np.uint64(SEGMENT * 2 - 1)).astype(np.int64)
        ends = np.concatenate([starts[1:], [len(low)]]) - 1
        parts.append((_mix(hashes[place]).view(np.int64), place + begin, starts + begin, ends + begin))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


class SuffixFile:
    """The sorted suffixes of a collection, one row each, in a file that is only read and written front to back.

    A row holds the first symbol of the suffix (-1 for the empty one), the row of the suffix without it, and, once it
    is known, the symbol before the suffix, which is its entry of the Burrows-Wheeler transform (-1: none).
    """

    def __init__(self, folder: str, documents: int):
        self.path, self.rows, self.folder, self.round = os.path.join(folder, "0"), documents, folder, 0
        empty = np.full(documents, -1, "<i4")
        with open(self.path, "wb") as file:
            np.rec.fromarrays([empty, empty, empty], dtype=ROW).tofile(file)

    def blocks(self) -> Iterator[np.ndarray]:
        with open(self.path, "rb") as file:
            while len(block := np.fromfile(file, ROW, BLOCK)):
                yield block

    def insert(self, symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put each symbol before the suffix in row `at`. Returns the rows of the new suffixes, and where old rows moved."""
        scale = self.rows + 1
        order = np.lexsort((at, symbols))
        keys = symbols[order].astype(np.int64) * scale + at[order]
        before = np.full(self.rows, -1, "<i4")
        before[at] = symbols
        places = np.empty(len(keys), np.int64)
        done = row = 0
        for block in self.blocks():  # where the new rows go
            own = block["first"].astype(np.int64) * scale + block["rest"]
            upto = np.searchsorted(keys, own[-1], side="right") if len(own) else done
            places[done:upto] = row + np.searchsorted(own, keys[done:upto])
            done, row = upto, row + len(block)
        places[done:] = self.rows
        moved = np.bincount(places, minlength=self.rows + 1)[: self.rows].cumsum() + np.arange(self.rows)
        rows = places + np.arange(len(places))
        new = np.empty(len(keys), ROW)
        new["first"], new["rest"], new["before"] = symbols[order], moved[at[order]], -1
        path = os.path.join(self.folder, str(self.round + 1))
        done = row = 0
        with open(path, "wb") as file:
            for block in self.blocks():
                known = before[row : row + len(block)]
                block["before"] = np.where(known >= 0, known, block["before"])
                inner = block["rest"] >= 0
                block["rest"][inner] = moved[block["rest"][inner]]
                upto = np.searchsorted(places, row + len(block), side="left")
                np.insert(block, places[done:upto] - row, new[done:upto]).tofile(file)
                done, row = upto, row + len(block)
            new[done:].tofile(file)
        os.remove(self.path)
        self.path, self.round, self.rows = path, self.round + 1, self.rows + len(new)
        out = np.empty(len(rows), np.int64)
        out[order] = rows
        return out, moved

    def transform(self) -> np.ndarray:
        return np.concatenate([b["before"] for b in self.blocks()])

    def repeats(self, depth: int) -> np.ndarray:
        """Whether a suffix shares its first `depth` symbols with a neighbour in the list."""
        table = [(b["first"].copy(), b["rest"].copy()) for b in self.blocks()]
        first, rest = (np.concatenate(c) for c in zip(*table, strict=True))
        group = np.zeros(self.rows, np.int32)
        for _ in range(depth):
            other = np.ones(self.rows, bool)
            other[1:] = (first[1:] != first[:-1]) | (first[1:] < 0) | (group[rest[1:]] != group[rest[:-1]])
            group = other.cumsum(dtype=np.int32)
        same = group[1:] == group[:-1]
        return np.concatenate([[False], same]) | np.concatenate([same, [False]])


def repeated_windows(contexts: list[bytes], window: int = WINDOW, symbol: int = SYMBOL) -> list[np.ndarray]:
    """For each context which of its windows start at another place of the collection as well."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    names = np.unique(string_hashes(data, symbol), return_inverse=True)[1].astype(np.int32)
    begins = np.cumsum(sizes) - sizes
    # the document of phase r is read from byte r on
    begin = np.repeat(begins, symbol) + np.tile(np.arange(symbol), len(contexts))
    length = (np.repeat(sizes, symbol) - np.tile(np.arange(symbol), len(contexts))) // symbol
    kept = length >= window // symbol
    begin, length = begin[kept], length[kept]
    out = np.zeros(len(data) + 1, bool)
    with tempfile.TemporaryDirectory() as folder:
        suffixes = SuffixFile(folder, len(begin))
        at, where = np.arange(len(begin)), []
        for k in range(1, int(length.max(initial=0)) + 1):
            going = np.flatnonzero(length >= k)
            place = begin[going] + (length[going] - k) * symbol
            rows, moved = suffixes.insert(names[place], at[going])
            where = [(p, moved[r]) for p, r in where] + [(place, rows)]
            at = moved[at]
            at[going] = rows
        again = suffixes.repeats(window // symbol)
        for place, rows in where:
            out[place] = again[rows]
    return [out[b : b + n - window + 1] for b, n in zip(begins, sizes, strict=True)]


NAMED = ("gram", "place", "first", "last", "d1", "d2")


def _grams(docs: DataFrame) -> DataFrame:
    """(key, n_bytes, grams): a digest of each text and its named grams, each with a digest of its context."""
    schema = f"key binary, n_bytes long, grams array<struct<{','.join(f'{n}:long' for n in NAMED)}>>"
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in NAMED]))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            keys, sizes, found, digests = [], [], [], []
            for text in batch.column(0).to_pylist():
                data = (text or "").encode()
                keys.append(_md5(data))
                sizes.append(len(data))
                found.append(window_grams(np.frombuffer(data, np.uint8)))
                digests += [_md5(data[a : b + WINDOW]) for a, b in zip(found[-1][2].tolist(), found[-1][3].tolist(), strict=True)]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(f[0]) for f in found])]).astype(np.int32))
            flat = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(4)]
            flat += list(np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2).T)
            structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in flat], fields=list(kind.value_type))
            grams = pa.ListArray.from_arrays(offsets, structs, type=kind)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), grams], ["key", "n_bytes", "grams"])

    return docs.mapInArrow(run, schema)


def _md5(data: bytes) -> bytes:
    return hashlib.md5(data, usedforsecurity=False).digest()


CONTEXT = {"gram": pa.int64(), "key": pa.binary(), "place": pa.int64(), "first": pa.int64(), "alone": pa.bool_(), "bytes": pa.binary()}
CONTEXTS = "gram long, key binary, place long, first long, alone boolean, bytes binary"


def _contexts(texts: DataFrame) -> DataFrame:
    """(gram, key, place, first, alone, bytes) from rows of (key, text, grams)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out, size = [], 0
            for key, text, grams in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "grams")), strict=True):
                data = (text or "").encode()
                for g in grams:
                    out.append((g["gram"], key, g["place"], g["first"], g["alone"], data[g["first"] : g["last"] + WINDOW]))
                    size += len(out[-1][-1])
                    if size > 16 << 20:
                        yield _batch(out, CONTEXT)
                        out, size = [], 0
            if out:
                yield _batch(out, CONTEXT)

    return texts.mapInArrow(run, CONTEXTS)


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], list(types))


def _parts(contexts: DataFrame, width: int) -> DataFrame:
    """Contexts cut where the place of the gram in the window passes a multiple of `width`; a part's gram is a hash of the
    old one, the multiple and the bytes that all windows between two multiples have in common."""
    types = {**CONTEXT, "last": pa.int64(), "d1": pa.int64(), "d2": pa.int64()}

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for gram, key, place, first, alone, data in zip(*(batch.column(c).to_pylist() for c in CONTEXT), strict=True):
                last = first + len(data) - WINDOW
                for multiple in range((place - last) // width, (place - first) // width + 1):
                    near, far = place - multiple * width, place - (multiple + 1) * width + 1  # latest and earliest start
                    name = _md5(np.array([gram, width, multiple], "<i8").tobytes() + data[near - first : far + WINDOW - first])
                    a, b = max(first, far), min(last, near)
                    part = data[a - first : b - first + WINDOW]
                    d1, d2 = np.frombuffer(_md5(part), "<i8").tolist()
                    out.append((int(np.frombuffer(name, "<i8")[0]), key, place, a, alone, part, b, d1, d2))
            yield _batch(out, types)

    return contexts.mapInArrow(run, f"{CONTEXTS}, last long, d1 long, d2 long")


def _salted(rows: DataFrame, few: DataFrame, on: list[str], salt: Column, how: str = "inner") -> DataFrame:
    """Join of `rows` with one row per key; a key may stand in very many rows."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>"))
    return rows.withColumn("salt", F.pmod(salt, F.lit(SALTS))).join(few.withColumn("salt", salts), [*on, "salt"], how).drop("salt")


def _classed(members: DataFrame, most_contexts: int) -> tuple[DataFrame, DataFrame]:
    """Spans of all contexts that have a twin, and one context of each class that has to be compared with other classes.

    A context is alone while nothing is known to repeat it; `hot` says that its gram has more classes than a task takes.
    """
    own = [c for c in members.columns if c not in ("gram", "d1", "d2")]
    order = ["key", "first", *[c for c in own if c not in ("key", "first")]]
    classes = settle(members.groupBy("gram", "d1", "d2").agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("c")))
    twins = _salted(members.where("alone"), classes.where("n > 1").select("gram", "d1", "d2"), ["gram", "d1", "d2"], F.xxhash64("key", "first"), "left_semi")
    alone = (F.col("n") == 1) & F.col("c.alone")
    kinds = classes.groupBy("gram").agg(F.count("*").alias("kinds"), F.max(alone).alias("open")).where("kinds > 1 and open")
    left = _salted(classes, kinds, ["gram"], F.col("d1"))
    rest = [F.col(f"c.{c}") for c in own if c != "alone"]
    return twins.select("key", F.col("first").alias("start"), (F.col("last") + WINDOW).alias("end")), left.select("gram", *rest, alone.alias("alone"), (F.col("kinds") > most_contexts).alias("hot"))


def _runs(marked: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


SPAN = {"key": pa.binary(), "start": pa.int64(), "end": pa.int64()}


def _sorted_spans(contexts: DataFrame) -> DataFrame:
    """Byte spans of repeated windows; contexts come sorted by gram, whole grams are taken together."""

    def solve(held: list[tuple]) -> pa.RecordBatch:
        marks = repeated_windows([c[4] for c in held])
        return _batch([(c[1], c[2] + a, c[2] + b + WINDOW - 1) for c, m in zip(held, marks, strict=True) if c[3] for a, b in _runs(m)], SPAN)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in rows:
            for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "key", "first", "alone", "bytes")), strict=True):
                if held and row[0] != held[-1][0] and size >= COLLECTION_BYTES:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[-1])
        if held:
            yield solve(held)

    return contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "key binary, start long, end long")


def remove_repeats(docs: DataFrame, text: str = "text", most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """Adds spans (start and end of each removed run of bytes) and kept (the bytes that remain) to every row.

    A null text counts as empty. Texts below WINDOW bytes are never touched, not even in copies. Repeated rows are
    documents of their own, so a row that is repeated loses all its bytes if it has WINDOW or more. Further columns
    stay; those named like a new one are replaced. An empty table gives an empty table.
    """
    texts = docs.select(F.coalesce(text, F.lit("")).alias("text"))
    keyed = texts.select(F.unhex(F.md5("text")).alias("key"), "text")
    classes = _grams(texts).groupBy("key").agg(F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes"), F.first("grams").alias("grams"))
    classes = save_artifact(classes, scratch_path(docs.sparkSession, "suffix-grams"))
    named = classes.select("key", F.explode("grams").alias("g")).select("key", "g.*")
    again = named.groupBy("gram").agg(F.count("*").alias("contexts")).where("contexts > 1").select("gram")
    members = _salted(named, again, ["gram"], F.xxhash64("key", "place")).withColumn("alone", F.lit(True))
    members = save_artifact(members, scratch_path(docs.sparkSession, "suffix-contexts"))
    spans, left = _classed(members, most_contexts)
    grams = [F.collect_list(F.when(which, F.struct("gram", "place", "first", "last", "alone"))) for which in (~F.col("hot"), F.col("hot"))]
    chosen = settle(left.groupBy("key").agg(grams[0].alias("grams"), grams[1].alias("hot")))
    once = keyed.where(F.octet_length("text") >= WINDOW).groupBy("key").agg(F.first("text").alias("text"))
    with_text = once.join(chosen, "key")
    contexts = _contexts(with_text.where(F.size("grams") > 0).select("key", "text", "grams"))
    hot, width = chosen.where(F.size("hot") > 0), 1 << (WINDOW - GRAM).bit_length() - 1
    if not hot.isEmpty():
        hot = _contexts(once.join(hot, "key").select("key", "text", F.col("hot").alias("grams")))
        while width and not hot.isEmpty():
            twins, left = _classed(settle(_parts(hot, width)), most_contexts)
            left = settle(left)
            spans, contexts = spans.unionByName(twins), contexts.unionByName(left.where("not hot").select(*CONTEXT))
            hot, width = left.where("hot").select(*CONTEXT), width // 2
    spans = spans.unionByName(_sorted_spans(contexts))
    whole = classes.where((F.col("copies") > 1) & (F.col("n_bytes") >= WINDOW)).select("key", F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))
    found = spans.unionByName(whole).groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("found"))
    return _cut(docs, settle(found), text)


def _cut(docs: DataFrame, found: DataFrame, text: str) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name not in ("spans", "kept")]
    names = [f"c{i}" for i in range(len(kept))]
    plain = docs.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(kept, names, strict=True)])
    at = [f.name for f in kept].index(text)
    joined = plain.withColumn("key", F.unhex(F.md5(F.coalesce(names[at], F.lit(""))))).join(found, "key", "left").select(*names, "found")
    schema = T.StructType([*kept, *T._parse_datatype_string("spans array<struct<start:long,end:long>>, kept binary").fields])
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            spans, left = [], []
            for body, found in zip(batch.column(at).to_pylist(), batch.column("found").to_pylist(), strict=True):
                data, merged = (body or "").encode(), []
                for span in found or ():
                    if merged and span["start"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], span["end"])
                    else:
                        merged.append(dict(span))
                spans.append(merged)
                ends = [0, *[s["end"] for s in merged]]
                left.append(b"".join(data[a:b] for a, b in zip(ends, [*[s["start"] for s in merged], len(data)], strict=True)))
            columns = [batch.column(i) for i in range(len(kept))] + [pa.array(spans, span_type), pa.array(left, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(run, schema)
