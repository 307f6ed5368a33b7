"""Near-duplicates by ProbMinHash: sketches for the probability Jaccard similarity of weighted word shingles.

A document is its shingles of five words, weighted by how often they occur. Every shingle starts a Poisson process with
its weight as rate; a point of it arrives at one register of the sketch, all registers once in a random order. The
register keeps the shingle that arrives first. Both documents draw the same points for the same shingle, so a register
agrees with the probability Jaccard similarity as its probability. A shingle stops as soon as its next point comes
later than what all registers have.

Documents with the same words are one node. Bands of registers propose links. In each bucket of a band the sketches of all
nodes are compared with that of the one that shares most buckets with others, as an original does with its copies; and,
once the links found so far are joined to components, with those of the nodes of other components in the bucket. So every two
nodes in a bucket are in one component in the end, or their sketches have been compared. This is done where the bucket's
sketches and texts lie, a large bucket being cut into blocks. Pairs whose sketches agree are verified on the shingles
themselves, and only links that join something are put out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.components import connected_components
from corpusloom.llm.pretokens import Remembered, batches
from corpusloom.operators.storage import save_artifact, scratch_path, settle

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SHINGLE_WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 40, 6  # at a similarity of 0.8 all bands miss with a probability of 5e-6
SIZE = BANDS * ROWS
ORDERS = 4096
CHARS_AT_ONCE = 2_000_000
SKETCH_LEAST = 0.65  # a pair at SIMILARITY falls below it with a probability of 2e-8
BLOCK_NODES = 2048  # of a bucket in one task
PART_PAIRS = 256  # of one node in one task
ROWS_AT_ONCE = 64

_GOLDEN, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(Remembered):
    def compute(self, word: str) -> int:
        return xxhash.xxh3_64_intdigest(word.encode())


_words = WordHashes()
_orders = np.argsort(np.random.default_rng(7).random((ORDERS, SIZE)), axis=1).astype(np.int16)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles and how often each occurs. Fewer than five words are one shingle."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE_WORDS, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = mix(total + hashes[k : len(words) - width + 1 + k] + _GOLDEN)
    return np.unique(total, return_counts=True)


def sketches(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Documents x registers: the shingle that arrives first at each register. A document has at least one shingle."""
    doc = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
    element = np.concatenate([h for h, _ in sets])
    rate = np.concatenate([w for _, w in sets]).astype(np.float64)
    order = (mix(element + np.uint64(1)) & np.uint64(ORDERS - 1)).astype(np.int64)
    arrival = np.zeros(len(element))
    times = np.full(len(sets) * SIZE, np.inf)
    first = np.zeros(len(sets) * SIZE, np.uint64)
    latest = np.full(len(sets), np.inf)
    for j in range(SIZE):
        draw = mix(element + np.uint64((j + 2) * int(_GOLDEN) % 2**64)) >> np.uint64(11)
        # without replacement: the registers that are left share the rate
        gap = -np.log((draw.astype(np.float64) + 0.5) * 2.0**-53) * (SIZE / (SIZE - j))
        arrival = arrival + gap / rate
        place = doc * SIZE + _orders[order, j]
        sooner = np.flatnonzero(arrival < times[place])
        where, when = place[sooner], arrival[sooner]
        np.minimum.at(times, where, when)
        won = times[where] == when
        first[where[won]] = element[sooner[won]]
        open_ = np.unique(doc)
        latest[open_] = times.reshape(-1, SIZE)[open_].max(axis=1)
        going = np.flatnonzero(arrival < latest[doc])
        if not len(going):
            break
        doc, element, rate, order, arrival = doc[going], element[going], rate[going], order[going], arrival[going]
    return first.reshape(len(sets), SIZE)


def band_hashes(sketch: np.ndarray) -> np.ndarray:
    """Documents x bands; the number of the band is part of the hash."""
    rows = sketch.reshape(len(sketch), BANDS, ROWS)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for k in range(ROWS):
        total = mix(total + rows[:, :, k] * _GOLDEN + _GOLDEN)
    return total.view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """sum over common d of 1 / sum over e of max(a_e / a_d, b_e / b_d), by one sort along a_e / b_e."""
    every = np.union1d(a[0], b[0])
    if not len(every):
        return 1.0
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a[0])], y[np.searchsorted(every, b[0])] = a[1], b[1]
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    upto = np.concatenate([[0], np.cumsum(y)])[np.searchsorted(ratio, ratio)]
    rest = x.sum() - np.concatenate([[0], np.cumsum(x)])[np.searchsorted(ratio, ratio)]
    common = np.flatnonzero((x > 0) & (y > 0))
    return float((1 / (rest[common] / x[common] + upto[common] / y[common])).sum())


def node_of(words: list[str], text: str | None) -> int:
    """Equal for documents with equal words; without words, for equal texts."""
    named = "\x01" + " ".join(words) if words else "\x02" + (text or "")
    return int.from_bytes(hashlib.md5(named.encode(), usedforsecurity=False).digest()[:8], "big", signed=True)


def _sketched(docs: DataFrame) -> DataFrame:
    """(id, digest, node, bands, sketch) of every row; without words there are no bands."""
    schema = T.StructType([docs.schema["id"], *T._parse_datatype_string("digest long, node long, bands array<long>, marks binary, sketch binary").fields])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            nodes, bands, marks, bytes_ = [], [], [], []
            for group in batches(batch.column("text").to_pylist(), lambda t: len(t or ""), CHARS_AT_ONCE):
                words = [words_of(t) for t in group]
                nodes += [node_of(w, t) for w, t in zip(words, group, strict=True)]
                worded = [shingles(w) for w in words if w]
                sketch = sketches(worded) if worded else np.empty((0, SIZE), np.uint64)
                hashed, short = iter(band_hashes(sketch)), iter((sketch & np.uint64(255)).astype(np.uint8))
                own = [next(hashed) if w else np.empty(0, np.int64) for w in words]
                bands += [h.tolist() for h in own]
                marks += [h.tobytes() for h in own]
                bytes_ += [next(short).tobytes() if w else b"" for w in words]
            columns = [batch.column("id"), batch.column("digest"), pa.array(nodes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary()), pa.array(bytes_, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema)


def _agreement(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated similarity of sketches of a byte per register; two that differ still agree in one byte of 256."""
    return ((one == others).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def _sketch_rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, SIZE)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _near_centres(members: DataFrame) -> DataFrame:
    """(a, b): the centre of a bucket and each of its nodes whose sketch agrees.

    `members` has band, node, centre, parts and sketch. A large bucket is dealt over its parts, each with the centre's row.
    """
    own = members.where("node <> centre").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    lead = members.where("node = centre").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = lead.unionByName(own).select("band", "part", (F.col("node") != F.col("centre")).alias("other"), "node", "sketch")
    dealt = rows.repartition("band", "part").sortWithinPartitions("band", "part", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_node, last_sketch = np.zeros(1, np.int64), np.zeros((1, SIZE), np.uint8)
        for batch in batches:
            other = batch.column("other").to_numpy(zero_copy_only=False)
            nodes = np.concatenate([last_node, batch.column("node").to_numpy()])
            sketch = np.concatenate([last_sketch, _sketch_rows(batch)])
            # the row of the centre that stands before each row; 0 is the last one of the batch before
            lead = np.maximum.accumulate(np.where(np.concatenate([[False], ~other]), np.arange(len(nodes)), 0))
            at = np.flatnonzero(other) + 1
            alike = at[_agreement(sketch[at], sketch[lead[at]]) >= SKETCH_LEAST]
            yield _pairs(nodes[lead[alike]], nodes[alike])
            last_node, last_sketch = nodes[lead[-1:]], sketch[lead[-1:]]

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _linked_others(members: DataFrame, least: float) -> DataFrame:
    """(a, b): links between nodes of different components that share a bucket, as many as it takes to join them.

    `members` has band, node, component, n, sketch, marks (a short hash per band) and text. A bucket of n nodes is cut into blocks,
    and each pair of blocks is a run of its own: the rows of the first as the left side, those of the second as the right
    one. A pair is looked at in its first common band only. Where the sketches agree, most alike pairs first, the texts
    are compared, unless links found in this run join the two already.
    """
    blocks = F.ceil(F.col("n") / BLOCK_NODES).cast("int")
    cut = members.withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("node"), blocks).cast("int")})
    # block p is left of all blocks from p on, and right of all up to p
    both = lambda q: F.struct(F.least("block", q).alias("p"), F.greatest("block", q).alias("q"), (F.col("block") <= q).alias("left"), (F.col("block") >= q).alias("right"))
    sides = cut.withColumn("side", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), both)))
    rows = sides.select("band", "side.p", "side.q", "side.left", "side.right", "node", "component", "sketch", "marks", "text")
    dealt = rows.repartition("band", "p", "q").sortWithinPartitions("band", "p", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right, node, component, sketch, marks, band, text in _runs(batches):
            own = (marks == band[0]).argmax(axis=1)  # the number of this band
            found = []
            for at in range(0, len(node), ROWS_AT_ONCE):
                some = np.arange(at, min(at + ROWS_AT_ONCE, len(node)))
                some = some[left[some]]
                possible = (component[some, None] != component[None]) & right[None] & ((node[some, None] < node[None]) | ~(left & right)[None])
                i, j = np.nonzero(possible)
                for k in range(0, len(i), 1 << 17):
                    x, y = some[i[k : k + (1 << 17)]], j[k : k + (1 << 17)]
                    share = _agreement(sketch[x], sketch[y])
                    alike = np.flatnonzero(share >= SKETCH_LEAST)
                    x, y, share = x[alike], y[alike], share[alike]
                    first = (marks[x] == marks[y]).argmax(axis=1) == own[x]
                    found.append((x[first], y[first], share[first]))
            if sum(len(f[0]) for f in found):
                yield _spanning(*(np.concatenate(c) for c in zip(*found, strict=True)), node, component, text, least)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _spanning(x: np.ndarray, y: np.ndarray, share: np.ndarray, node: np.ndarray, component: np.ndarray, text: np.ndarray, least: float) -> pa.RecordBatch:
    """The pairs that pass and join what no pair before has joined."""
    root: dict[int, int] = {}

    def find(k: int) -> int:
        while (up := root.setdefault(k, k)) != k:
            root[k] = root[up] if up in root else up
            k = root[k]
        return k

    sets: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def shingles_of(i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in sets:
            sets[i] = shingles(words_of(text[i]))
        return sets[i]

    kept = []
    for k in np.argsort(-share, kind="stable").tolist():
        i, j = int(x[k]), int(y[k])
        a, b = find(int(component[i])), find(int(component[j]))
        if a != b and probability_jaccard(shingles_of(i), shingles_of(j)) >= least:
            root[a] = b
            kept.append((int(node[i]), int(node[j])))
    return _pairs(*np.array(kept, np.int64).reshape(-1, 2).T)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of the rows that agree in band, p and q, across the batches."""
    held, last = [], None
    for batch in batches:
        keys = np.array([batch.column(c).to_numpy() for c in ("band", "p", "q")])
        marks = np.frombuffer(b"".join(batch.column("marks").to_pylist()), np.int64).reshape(-1, BANDS)
        rest = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("left", "right", "node", "component")]
        rest += [_sketch_rows(batch), marks, keys[0], np.array(batch.column("text").to_pylist(), object)]
        starts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *starts.tolist()], [*starts.tolist(), batch.num_rows], strict=True):
            if b == a:
                continue
            key = tuple(keys[:, a].tolist())
            if held and key != last:
                yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
                held = []
            held.append([c[a:b] for c in rest])
            last = key
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def _verified(pairs: DataFrame, body: DataFrame, least: float) -> DataFrame:
    """Pairs whose similarity is at least so high. The text of a travels once for each part of its pairs, that of b once a pair."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART_PAIRS).alias("parts"))
    counted = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    text = body.withColumnRenamed("node", "b")
    right = counted.join(text, "b").select("a", "part", "b", "text")
    left = parts.join(body.withColumnRenamed("node", "a"), "a").select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "text")
    dealt = left.unionByName(right).repartition("a", "part").sortWithinPartitions("a", "part", "b")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in rows:
            found: list[tuple[int, int]] = []
            for a, b, text in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text")), strict=True):
                if b is None:
                    known = shingles(words_of(text))  # the first row of its part
                elif probability_jaccard(known, shingles(words_of(text))) >= least:
                    found.append((a, b))
            yield _pairs(*np.array(found, np.int64).reshape(-1, 2).T)

    return dealt.select("a", "b", "text").mapInArrow(run, "a long, b long")


def near_duplicate_classes(docs: DataFrame, text: str = "text", id_col: str = "doc_id", least: float = SIMILARITY) -> DataFrame:
    """(id, digest, class_node, class_id) per row of `docs`: its class and the lowest id of all documents linked to it,
    directly or not.

    Documents whose lower-cased words are the same are linked; those without words only if their texts are the same, a
    null text counting as empty. Others are linked at a similarity of at least `least`. A null id is never a class id
    unless all ids of a class are null. `digest` is xxhash64 of the text, to tell rows with the same id apart.
    """
    own = F.col(f"`{text}`")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(own).alias("digest"), own.alias("text"))
    spark = docs.sparkSession
    rows = save_artifact(_sketched(texts), scratch_path(spark, "sketches"))
    first = F.first(F.struct("id", "digest", "bands", "marks", "sketch")).alias("one")
    nodes = save_artifact(rows.groupBy("node").agg(F.min("id").alias("least_id"), first).select("node", "least_id", "one.*"), scratch_path(spark, "nodes"))
    banded = nodes.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = settle(banded.join(buckets, "band"))
    # what others are copies of shares buckets with most of them, so it is the one to compare with
    shares = settle(shared.groupBy("node").agg(F.sum("n").alias("shares")))
    sketch = nodes.select("node", "sketch", "marks")
    ranked = shared.join(shares, "node")
    middle = ranked.groupBy("band").agg(F.max(F.struct("shares", "node")).alias("top")).select("band", F.col("top.node").alias("centre"))
    members = settle(shared.join(middle, "band"))
    own = nodes.join(shares.select("node"), "node", "left_semi").select("node", F.col("id").alias("_id"), F.col("digest").alias("_digest"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    body = settle(texts.join(own, same).select("node", "text").dropDuplicates(["node"]))

    parts = F.ceil(F.col("n") / BLOCK_NODES).alias("parts")
    stars = settle(_near_centres(members.select("band", "node", "centre", parts).join(sketch.drop("marks"), "node")))
    found = settle(_verified(stars, body, least))
    joined = connected_components(found)
    placed = settle(members.select("band", "node", "n").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")))
    mixed = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("band")
    full = sketch.join(body, "node")
    more = settle(_linked_others(placed.join(mixed, "band", "left_semi").join(full, "node"), least))
    joined = connected_components(found.unionByName(more))
    classes = nodes.select("node", "least_id").join(joined, "node")
    lowest = classes.groupBy("component").agg(F.min("least_id").alias("class_id"))
    linked = settle(classes.join(lowest, "component").select("node", "component", F.col("class_id").alias("linked_id")))
    labelled = nodes.select("node", "least_id").join(linked, "node", "left")
    labelled = labelled.select("node", F.coalesce("component", "node").alias("class_node"), F.coalesce("linked_id", "least_id").alias("class_id"))
    return rows.select("id", "digest", "node").join(labelled, "node").select("id", "digest", "class_node", "class_id")


def keep_one_per_class(docs: DataFrame, text: str = "text", id_col: str = "doc_id", least: float = SIMILARITY) -> DataFrame:
    """The document with the lowest id of each class; one row of it where rows are repeated. Columns stay as they are."""
    classes = settle(near_duplicate_classes(docs, text, id_col, least))
    lowest = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "digest")).alias("kept")
    kept = classes.groupBy("class_node").agg(lowest).select(F.col("kept.id").alias("k_id"), F.col("kept.digest").alias("k_digest"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    own_id, own_text = (names[docs.columns.index(c)] for c in (id_col, text))
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    out = plain.join(kept, F.col(own_id).eqNullSafe(F.col("k_id")) & (F.xxhash64(own_text) == F.col("k_digest")), "left_semi")
    repeated = classes.groupBy("id", "digest").agg(F.count("*").alias("n")).where("n > 1")
    out = out if repeated.isEmpty() else out.dropDuplicates([own_id, own_text])
    return out.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
