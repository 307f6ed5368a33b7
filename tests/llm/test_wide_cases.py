"""Long texts, large groups, many blocks and clashing column names."""

import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, line_chunks, prob_minhash, token_files


def words(rng, n, kinds=10**6):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def test_decontamination_is_linear_in_the_text(spark):
    rng = random.Random(1)
    long = words(rng, 700_000, 5_000)
    item, short = words(rng, 14), words(rng, 4)
    long[300_000:300_000] = item
    long[-4:] = short
    docs = [(1, " ".join(long)), (2, " ".join(item[:9])), (3, "x " + " ".join(item[1:11]))]
    table = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(short)), (9, "w1 w2")], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.contained_items(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()}
    want = plain.contaminated(docs, [(7, " ".join(item)), (8, " ".join(short)), (9, "w1 w2")])
    assert got == {k: (n, hit, items) for k, n, hit, items in want}
    assert got[1][2][:2] == ["7", "8"] and got[3] == (11, 10, ["7"])


def test_names_of_the_caller_stay(spark):
    text = "a b c d e f g h i j k"
    names = ["doc_id", "text", "_id", "_digest", "_d", "_size", "_n", "id", "digest", "w", "c1", "hit", "a.b", "salt", "n_hit"]
    df = spark.createDataFrame([(1, text, *range(13)), (1, text, *range(13))], ", ".join(f"`{n}` {'string' if n == 'text' else 'long'}" for n in names))
    items = spark.createDataFrame([(5, text)], "item_id long, text string")
    for limit in (decontaminate.BROADCAST_BYTES, 0):
        out = decontaminate.contained_items(df, items, broadcast_bytes=limit)
        assert out.columns == [*names[:-1], "n_words", "n_hit", "items"] and [r.n_hit for r in out.collect()] == [11, 11]
    kept = prob_minhash.keep_one_per_class(df)
    assert kept.columns == names and [tuple(r) for r in kept.collect()] == [(1, text, *range(13))]
    assert line_chunks.dedup_lines(df).columns == [*names, "n_lines", "n_removed_lines"]


@pytest.fixture(scope="module")
def groups():
    """A group of near copies, and texts that share half of their words, some with a near copy of their own."""
    rng = random.Random(2)
    texts, passage, base = [], words(rng, 60), words(rng, 90)
    for i in range(50):
        own = base[:]
        own[rng.randrange(90)] = f"x{i}"
        texts.append((i, " ".join(own)))
    texts += [(1_000 + i, " ".join(passage + words(rng, 30))) for i in range(50)]
    texts += [(2_000 + i, texts[50 + i][1] + f" tail{i}") for i in range(0, 20, 2)]
    return texts, plain.classes(texts)


@pytest.mark.parametrize("nodes, pairs", [(2048, 256), (8, 4)])
def test_large_buckets_in_blocks(spark, monkeypatch, groups, nodes, pairs):
    monkeypatch.setattr(prob_minhash, "BLOCK_NODES", nodes)
    monkeypatch.setattr(prob_minhash, "PART_PAIRS", pairs)
    texts, want = groups
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = {r.id: r.class_id for r in prob_minhash.near_duplicate_classes(df).collect()}
    assert got == want and len({got[i] for i in range(50)}) == 1 and len(set(got.values())) == 51


def test_only_links_that_join_are_put_out(spark):
    rng = random.Random(3)
    base = words(rng, 120)
    texts = [" ".join(words(rng, 120)) for _ in range(40)] + [" ".join([*base[:-1], f"x{i}"]) for i in range(30)]
    sets = [prob_minhash.shingles(t.split()) for t in texts]
    sketch = prob_minhash.sketches(sets)
    marks = prob_minhash.band_hashes(sketch)
    short = (sketch & np.uint64(255)).astype(np.uint8)
    rows = [
        (int(marks[i, k]), i, len(texts), i, bytearray(short[i].tobytes()), bytearray(marks[i].tobytes()), texts[i])
        for i in range(len(texts)) for k in range(prob_minhash.BANDS)
    ]
    members = spark.createDataFrame(rows, "band long, node long, n long, component long, sketch binary, marks binary, text string")
    links = [tuple(r) for r in prob_minhash._linked_others(members, 0.8).collect()]
    assert {k for pair in links for k in pair} == set(range(40, 70)) and 29 <= len(links) < 29 * 8
    own = members.where(F.col("band") == rows[40 * prob_minhash.BANDS][0])
    led = own.select("band", "node", F.lit(40).cast("long").alias("centre"), F.lit(4).cast("long").alias("parts"), "sketch")
    assert {tuple(r) for r in prob_minhash._near_centres(led).collect()} == {(40, r.node) for r in own.collect() if r.node != 40}


def test_lookup_of_one_document_reads_its_block(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i} " * 30) for i in range(400)] + [(None, "nobody")], "key long, text string")
    token_files.write_token_files(docs, str(tmp_path), id_col="key", block_bytes=300)
    every = {r.key: r.token_ids for r in token_files.read_token_files(spark, str(tmp_path), "key").collect()}
    assert len(every) == 401
    some = token_files.read_token_files(spark, str(tmp_path), "key", only=[17, None, 10**9])
    assert {r.key: r.token_ids for r in some.collect()} == {17: every[17], None: every[None]}
    plan = token_files.read_token_files(spark, str(tmp_path), "key", only=[17])._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(least_id,17)" in plan
    shards = spark.read.parquet(f"{tmp_path}/shards")
    near = shards.where(token_files._may_hold([17])).count()
    assert shards.count() > 20 and near == 1
    assert token_files.read_token_files(spark, str(tmp_path), "key", only=[]).count() == 0


def test_very_long_text_in_line_dedup(spark):
    rng = random.Random(4)
    block = [" ".join(words(rng, 12)) for _ in range(20_000)]
    docs = [(1, "\n".join(block)), (2, "start\n" + "\n".join(block) + "\nend"), (3, "x" * 3_000_000)]
    got = {r.doc_id: r for r in line_chunks.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1].n_removed_lines == 0 and got[2].n_removed_lines > 19_900 and got[3].text == docs[2][1]
