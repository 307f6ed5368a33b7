"""Token counts, token files and packing against the tokenizers library and a plain recount."""

import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as spark_entry
from corpusloom.llm import sum_of_squares, token_counts, token_files
from corpusloom.llm.pretokens import BYTE_BPE, Splitter, WordIds, compose_scan
from corpusloom.operators.storage import scratch_path

ODD = [
    "", " ", "\n", "x'r", "x'v", "x'll 's've 'S", "\r\n 'll", "'" * 5 + "s", "a" * 3000, " " * 3000, "日本語" * 300, "é ½ ²",
    "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endof", "tab\t\tx  y", "😀😀 '😀", "\x00\x1f", "ab" * 2000 + "\n",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rnd = random.Random(3)
    marks = [*"abcdrevlstm'' \n\t é日😀0½!.,", "'s", "'re", "'ll", "<|endoftext|>", "  ", "\n\n", "ing", "the", " '"]
    mixed = ["".join(rnd.choice(marks) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    return ODD + mixed + [r[0] for r in rows]


@pytest.mark.parametrize("chunk", [1, 7, 1024])
def test_counts_equal_the_library_for_any_chunk_length(texts, library, chunk):
    counter = token_counts.TokenCounter(splitter=Splitter(chunk))
    want = [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert counter.counts(texts) == want


def test_counting_stays_right_when_compiled_states_are_dropped(texts, library):
    counter = token_counts.TokenCounter()
    counter.machine.kept, counter.most = 50, 20
    want = [len(e.ids) for e in library.encode_batch_fast(texts[:400], add_special_tokens=False)]
    assert counter.counts(texts[:400]) == want


def test_scan_composes_maps_from_left_to_right():
    rng = np.random.default_rng(0)
    maps, first = rng.integers(0, 4, (9, 4)), np.array([0, 0, 0, 0, 4, 5, 5, 5, 5])
    got = compose_scan(maps, first)
    for i, f in enumerate(first):
        state = np.arange(4)
        for k in range(f, i + 1):
            state = maps[k][state]
        assert got[i].tolist() == state.tolist()


def test_ids_equal_the_library(texts, library):
    got = list(WordIds().encode(texts))
    for e, g in zip(library.encode_batch_fast(texts, add_special_tokens=False), got, strict=True):
        assert e.ids == np.frombuffer(g, "<u4").tolist()


def test_a_piece_is_looked_up_once_for_all_its_places(library):
    asked = []

    class Asked(WordIds):
        def __getitem__(self, piece):
            asked.append(piece)
            return super().__getitem__(piece)

    rows = ["ab é cd 😀" * 50, "", "<|endoftext|> cd", " cd é" * 70]
    got = list(Asked().encode(rows))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode(r, add_special_tokens=False).ids for r in rows]
    assert sorted(asked) == sorted(set(asked)) and " cd" in asked


def test_count_tokens_keeps_rows_and_columns(spark):
    rows = [(1, None, "x", 9), (1, None, "x", 9), (None, "the cat", None, 9), (2, "a " * 1025, "y", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, other string, n_tokens int")
    got = sorted(map(tuple, token_counts.count_tokens(df).drop("text").collect()), key=repr)
    assert got == sorted([(1, "x", 0, 0, False)] * 2 + [(None, None, 7, 2, False), (2, "y", 2050, 1026, True)], key=repr)
    assert token_counts.count_tokens(df.limit(0)).count() == 0


def expected_ids(library, text, end):
    return [*library.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark, sf_dir, library):
    got = spark_entry.queries()["op1_token_counts"](spark, sf_dir).toPandas().set_index("doc_id")
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet").set_index("doc_id")
    want = [len(e.ids) for e in library.encode_batch_fast(docs["text"].tolist(), add_special_tokens=False)]
    assert got.loc[docs.index, "n_tokens"].tolist() == want
    assert got.loc[docs.index, "n_bytes"].tolist() == [len(t.encode()) for t in docs["text"]]
    assert got.loc[docs.index, "over_limit"].tolist() == [n > 1024 for n in want]


def test_op5(spark, sf_dir, library):
    got = spark_entry.queries()["op5_token_files"](spark, sf_dir).toPandas().sort_values("doc_id")
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet").sort_values("doc_id")
    start = 0
    for (key, text), row in zip(docs[["doc_id", "text"]].itertuples(index=False), got.itertuples(), strict=True):
        ids = expected_ids(library, text, 2)
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (key, start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_round_trip_odd_rows(spark, library):
    rows = [(i % 7 if i else None, t, "x") for i, t in enumerate(ODD)] + [(3, None, "y")]
    df = spark.createDataFrame(rows, "key long, text string, start string").repartition(3)
    path = scratch_path(spark, "odd")
    token_files.write_token_files(df, path, id_col="key", block_bytes=200)
    got = token_files.read_token_files(spark, path, "key").orderBy("start").collect()
    want = sorted(((-1 if k is None else k), t or "") for k, t, _ in rows)
    keys = [-1 if r.key is None else r.key for r in got]
    assert keys == [k for k, _ in want]
    assert sorted(bytes(r.token_ids) for r in got) == sorted(np.array(expected_ids(library, t, 2), "<u4").tobytes() for _, t in want)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    some = token_files.read_token_files(spark, path, "key", only=[3]).collect()
    assert sorted(r.start for r in some) == sorted(r.start for r in got if r.key == 3)
    hashes = {r[0] for r in spark.read.parquet(f"{path}/shards").select("dictionary_sha256").collect()}
    assert hashes == {spark.read.parquet(f"{path}/dictionary").first()["sha256"]}


def test_empty_table_gives_files_without_documents(spark):
    path = scratch_path(spark, "none")
    token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), path)
    assert token_files.read_token_files(spark, path).count() == 0


def check_packing(packed, capacity):
    for _, group in packed.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group["offset"].tolist() == [0, *group["length"].cumsum().tolist()[:-1]]
        assert group["length"].sum() <= capacity


def test_op8(spark, sf_dir, library):
    got = spark_entry.queries()["op8_sum_of_squares_packing"](spark, sf_dir).toPandas()
    check_packing(got, 2048)
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet").set_index("doc_id")["text"]
    assert set(got["doc_id"]) == set(docs.index)
    for key, pieces in got.groupby("doc_id"):
        ids, pieces = expected_ids(library, docs[key], 0), pieces.sort_values("piece")
        assert pieces["piece"].tolist() == list(range(len(pieces)))
        assert pieces["start"].tolist() == [0, *pieces["length"].cumsum().tolist()[:-1]]
        assert pieces["length"].sum() == len(ids) and (pieces["length"].iloc[1:] == 2048).all()
        assert pieces["ids_crc32"].tolist() == [crc(ids[a : a + n]) for a, n in zip(pieces["start"], pieces["length"], strict=True)]
    assert got["sequence_id"].nunique() <= 1.02 * -(-got["length"].sum() // 2048)


def plain_place(lengths, capacity):
    """Sum of squares by definition: try every open sequence and a fresh one."""
    gaps, out = [], []
    for n in lengths:
        options = []
        for k in [*range(len(gaps)), len(gaps)]:
            trial = [*gaps, capacity] if k == len(gaps) else list(gaps)
            if trial[k] >= n:
                trial[k] -= n
                counts = {g: trial.count(g) for g in trial if g}
                options.append((sum(c * c for c in counts.values()), k == len(gaps), trial[k], trial))
        best = min(options, key=lambda o: o[:3])
        gaps = best[3]
        out.append(best[0])
    return sorted(gaps), out


def test_placing_follows_the_definition():
    rng = np.random.default_rng(5)
    for _ in range(30):
        lengths = rng.integers(1, 21, 40)
        *_, gaps = sum_of_squares.place(lengths, 20)
        assert sorted(gaps.tolist()) == plain_place(lengths.tolist(), 20)[0]


def test_packing_in_groups_keeps_all_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(1, 0, int(n), "x", "y") for n in rng.integers(1, 101, 3000)] + [(None, None, 100, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, length long, offset string, extra string")
    got = sum_of_squares.pack(df, capacity=100, group_pieces=200).toPandas()
    check_packing(got, 100)
    assert sorted(got["length"]) == sorted(r[2] for r in rows)
    assert got["sequence_id"].nunique() <= 1.05 * -(-sum(r[2] for r in rows) // 100)
    assert sum_of_squares.pack(df.limit(0)).count() == 0
    big = spark.range(50).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(70).cast("long").alias("length"))
    assert sum_of_squares.pack(big, capacity=100, group_pieces=10).select("sequence_id").distinct().count() == 50
