"""Decontamination, near-duplicates, line chunks and repeated byte strings against plain versions."""

import collections
import random

import numpy as np
import pandas as pd
import plain
import pytest

import __spark_entry__ as spark_entry
from corpusloom.llm import column_suffix, decontaminate, line_chunks, prob_minhash
from corpusloom.llm.components import connected_components


@pytest.fixture(scope="module")
def docs(sf_dir):
    return pd.read_parquet(f"{sf_dir}/documents.parquet")[["doc_id", "text"]]


ODD = [
    (1, None, 0), (2, "", 0), (3, "one two THREE four", 0), (3, "one two THREE four", 0), (4, "###", 0), (5, "!!!", 0), (None, "", 0),
    (None, "a b c d e f g h i j k l m", 1), (7, "x a b c d e f g h i j k l m y", 1), (8, "the " * 300, 2), (9, "the " * 300, 2), (10, "é ß 漢字 " * 60, 3), (None, "nobody has this", 3),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, n_hit int").repartition(3)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_decontamination_of_odd_rows(spark, odd, limit):
    items = [(1, "a b c d e f g h i j k"), (2, "one two"), (2, "two three"), (3, None), (4, ""), (None, "the"), (5, "the the the"), (5, "the the the")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontaminate.contained_items(odd, table, broadcast_bytes=limit).select("doc_id", "n_words", "n_hit", "items"))
    want = plain.contaminated([(k, t) for k, t, _ in ODD], items)
    assert got == sorted(want, key=repr)
    assert {r[2] for r in decontaminate.contained_items(odd, table.limit(0), broadcast_bytes=limit).select("doc_id", "n_words", "n_hit").collect()} == {0}
    assert decontaminate.contained_items(odd.limit(0), table, broadcast_bytes=limit).count() == 0


def test_op4_join_without_broadcast_gives_the_same(spark, sf_dir, docs):
    items = pd.read_parquet(f"{sf_dir}/benchmark.parquet")
    table = spark.createDataFrame(items)
    got = rows(decontaminate.contained_items(spark.createDataFrame(docs), table, broadcast_bytes=0).select("doc_id", "n_words", "n_hit", "items"))
    assert got == sorted(plain.contaminated(docs.itertuples(index=False), items[["item_id", "text"]].itertuples(index=False)), key=repr)


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5)]
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in pairs:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: find(k) for k in root}


def test_sketch_estimates_the_probability_jaccard():
    rng = np.random.default_rng(0)
    shares, exact = [], []
    for _ in range(150):
        h = np.unique(rng.integers(0, 2**63, 100).astype(np.uint64))
        a, b = (h[:88], rng.integers(1, 4, 88)), (h[12:], rng.integers(1, 4, len(h) - 12))
        s = prob_minhash.sketches([a, b])
        shares.append((s[0] == s[1]).mean())
        exact.append(prob_minhash.probability_jaccard(a, b))
        x, y = (collections.Counter(dict(zip(k.tolist(), v.tolist(), strict=True))) for k, v in (a, b))
        every = x.keys() | y.keys()
        assert exact[-1] == pytest.approx(sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in every) for d in x.keys() & y.keys()))
    assert np.mean(shares) == pytest.approx(np.mean(exact), abs=0.01)


def test_near_duplicates(spark, sf_dir, docs):
    rng = random.Random(4)
    texts = [(int(k), t) for k, t in docs.itertuples(index=False)]
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    for i in range(40):  # a chain: neighbours alike, the ends not
        base = base[:]
        base[rng.randrange(150)] = f"n{i}"
        texts.append((10_000 + i, " ".join(base)))
    texts += [(20_000 + i, t) for i, (k, t) in enumerate(texts[:20]) for _ in range(2)][: 30]
    texts = list(dict(texts).items())
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = {r.id: r.class_id for r in prob_minhash.near_duplicate_classes(df).collect()}
    assert got == plain.classes(texts)
    kept = prob_minhash.keep_one_per_class(df).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == sorted(set(got.values()))


def test_near_duplicates_of_odd_rows(spark, odd):
    got = prob_minhash.near_duplicate_classes(odd).select("id", "class_id").collect()
    want = {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 7: 7, 8: 8, 9: 8, 10: 10}
    assert {r.id: r.class_id for r in got if r.id is not None} == want
    assert sorted([r.class_id for r in got if r.id is None], key=repr) == [1, 7, None] and len(got) == len(ODD)
    kept = prob_minhash.keep_one_per_class(odd)
    assert sorted([r.doc_id for r in kept.collect()], key=repr) == sorted([1, 3, 4, 5, 7, 8, 10, None], key=repr)
    assert kept.columns == odd.columns
    assert prob_minhash.near_duplicate_classes(odd.limit(0)).count() == 0


def test_op3(spark, sf_dir, docs):
    got = spark_entry.queries()["op3_prob_minhash"](spark, sf_dir).toPandas()
    assert dict(zip(got["doc_id"], got["class_id"], strict=True)) == plain.classes([(int(k), t) for k, t in docs.itertuples(index=False)])


def test_line_chunks_resist_shifts():
    rng = random.Random(1)
    lines = [f"line {rng.random()}" for _ in range(200)]
    whole = {tuple(c) for c in line_chunks.chunks("\n".join(lines))}
    moved = {tuple(c) for c in line_chunks.chunks("\n".join([*lines[:50], "new", *lines[50:]]))}
    assert len(whole - moved) <= 2


def test_dedup_lines_of_odd_rows(spark):
    block = "\n".join(f"a shared line {i}" for i in range(12))
    table = [
        (1, None, "x", 5), (2, "", "x", 5), (3, block, "x", 5), (4, "own\n" + block + "\ntail", "y", 5), (5, block, None, 5), (5, block, None, 5),
        (6, "\n\n\n\n", "x", 5), (7, "\n\n\n\n", "x", 5), (None, block, "n", 5),
    ]
    df = spark.createDataFrame(table, "doc_id long, text string, chunks string, n_lines int").repartition(3)
    out = line_chunks.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "chunks", "n_lines", "n_removed_lines"]
    got = {(r.doc_id, r.chunks): (r.text, r.n_lines) for r in out.collect()}
    assert out.count() == len(table)
    assert got[1, "x"] == (None, 0) and got[2, "x"] == ("", 1) and got[6, "x"][0] == "\n\n\n\n" == got[7, "x"][0]
    assert got[None, "n"][0] == block  # a null id comes first
    lost = len(block.split("\n")) - len(got[3, "x"][0].split("\n"))
    assert lost >= 6 and got[5, None] == got[3, "x"] and got[4, "y"][0].startswith("own\n") and got[4, "y"][0].endswith("tail")
    assert line_chunks.dedup_lines(df.limit(0)).count() == 0


def test_op9(spark, sf_dir, docs):
    got = spark_entry.queries()["op9_line_chunks"](spark, sf_dir).toPandas()
    assert dict(zip(got["doc_id"], got["text"], strict=True)) == plain.without_chunks(docs.itertuples(index=False))


def test_line_passages_are_removed_whole(spark):
    rng = random.Random(5)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passages = [[line(60) for _ in range(rng.randint(6, 12))] for _ in range(20)]
    texts = []
    for d in range(120):
        parts = [[line(8) for _ in range(rng.randint(1, 4))], passages[d % 20], [line(8)] * (d % 3 > 0)]
        texts.append("\n".join(x for p in parts for x in p))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.text or "").split("\n") for r in line_chunks.dedup_lines(table, least=2).collect()}
    left = collections.Counter(x for t in got.values() for x in t)
    every = collections.Counter(x for t in texts for x in t.split("\n"))
    # without chunks: lines that stand in a repeated run of lines, but for one copy of each
    runs = collections.Counter(p for t in texts for p in zip(t.split("\n"), t.split("\n")[1:], strict=False))
    repeated = {x for p, n in runs.items() if n > 1 for x in p}
    surplus, lost = sum(every[x] - 1 for x in repeated), sum(every[x] - left[x] for x in repeated)
    inner = {x for p in passages for x in p[3:-3]}
    assert all(left[x] for x in every) and all(left[x] == every[x] for x in every.keys() - repeated)
    assert lost >= 0.6 * surplus and max(left[x] for x in inner) < 6  # no inner line stays in every copy


def test_last_line_is_compared_with_the_chunk_before():
    for seed in range(40):
        rng = random.Random(seed)
        cut = line_chunks.chunks("\n".join(f"line {rng.random()}" for _ in range(30)), 2)
        assert all(line_chunks.n_worded(c) >= 2 for c in cut[:-1])
        last = line_chunks.compared(cut, len(cut) - 1, 2)
        assert last == (cut[-1] if len(cut[-1]) > 1 else cut[-2] + cut[-1])


def test_suffix_list_is_sorted_and_its_transform_right():
    rng = random.Random(0)
    for _ in range(60):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(4, 16))) for _ in range(rng.randint(1, 8))]
        counts = collections.Counter(t[i : i + 4] for t in texts for i in range(len(t) - 3))
        for symbol in (1, 2, 4):
            got = column_suffix.repeated_windows(texts, 4, symbol)
            assert [g.tolist() for g in got] == [[counts[t[i : i + 4]] > 1 for i in range(len(t) - 3)] for t in texts]


def test_transform_of_a_collection(tmp_path):
    texts, suffixes = ["banana", "ananas", "nab"], column_suffix.SuffixFile(str(tmp_path), 3)
    at = np.arange(3)
    for k in range(1, 7):
        going = np.array([i for i, t in enumerate(texts) if len(t) >= k])
        rows_, moved = suffixes.insert(np.array([ord(texts[i][-k]) for i in going], np.int32), at[going])
        at = moved[at]
        at[going] = rows_
    # an empty suffix sorts by its document, a suffix by its symbols and then by the empty suffix that ends it
    every = sorted((tuple(map(ord, t[i:])) + (d - 3,), (ord(t[i - 1]) if i else -1)) for d, t in enumerate(texts) for i in range(len(t) + 1))
    assert suffixes.transform().tolist() == [b for _, b in every]


@pytest.mark.parametrize("most", [column_suffix.MOST_CONTEXTS, 1])
def test_repeats_of_odd_rows(spark, most):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = text(700)
    texts = [None, "", shared, shared, text(600), text(300) + shared[50:600] + text(200), shared[:399], "ab" * 500, "z" * 399, "z" * 399]
    texts += [text(100) + shared[100:520], "é" * 200 + "x", "é" * 200 + "y"]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, key string").repartition(3)
    got = column_suffix.remove_repeats(df, most_contexts=most).orderBy("doc_id").collect()
    for r, (gone, runs, kept) in zip(got, plain.without_repeats(texts), strict=True):
        assert (sum(s["end"] - s["start"] for s in r.spans), len(r.spans), bytes(r.kept)) == (gone, runs, kept), r.doc_id
    assert column_suffix.remove_repeats(df.limit(0)).count() == 0


def test_equal_contexts_go_on_once(spark):
    columns = "gram long, key binary, place long, first long, last long, d1 long, d2 long, alone boolean"
    rows = [(1, bytes([i]), 50, 0, 40, 7, 7, True) for i in range(5)] + [(1, b"x", 60, 10, 45, 8, 7, True)]
    rows += [(2, bytes([i]), 50, 3, 9, 7, 7, True) for i in range(3)]  # nothing else to compare with
    for most in (2, 1):
        spans, left = column_suffix._classed(spark.createDataFrame(rows, columns), most)
        twins = [(bytes(r.key), r.start, r.end) for r in spans.collect()]
        assert sorted(twins) == sorted([(bytes([i]), 0, 440) for i in range(5)] + [(bytes([i]), 3, 409) for i in range(3)])
        assert sorted((r.gram, r.alone, r.hot) for r in left.collect()) == [(1, False, most < 2), (1, True, most < 2)]


def test_parts_of_contexts_hold_equal_windows_together(spark):
    rng = random.Random(4)
    core = rng.randbytes(700)
    contexts = []  # windows around the gram at byte 350 of the core, with other bytes on either side
    for i in range(40):
        left, right = rng.randint(100, 349), rng.randint(500, 699)
        data = rng.randbytes(20) + core[left:right] + rng.randbytes(20)
        contexts.append((1, bytes([i]), 20 + 350 - left, 0, True, data[: max(400, len(data))] + rng.randbytes(max(0, 400 - len(data)))))
    df, width = spark.createDataFrame(contexts, column_suffix.CONTEXTS), 256
    windows = collections.Counter(c[5][s : s + 400] for c in contexts for s in range(len(c[5]) - 399))
    while width:
        df = column_suffix._parts(df, width)
        parts = df.collect()
        assert len(parts) <= 2 * len(contexts) or width < 256
        held = [(p.gram, bytes(p.bytes)[s : s + 400]) for p in parts for s in range(p.last - p.first + 1)]
        assert collections.Counter(w for _, w in held) == windows
        assert len(set(held)) == len(windows)  # equal windows, equal names
        df, width = df.select(*column_suffix.CONTEXT), width // 2
    assert len({g for g, _ in held}) == len(windows)


def test_op6(spark, sf_dir, docs):
    got = spark_entry.queries()["op6_column_suffix_dedup"](spark, sf_dir).toPandas().set_index("doc_id").loc[docs["doc_id"]]
    want = plain.without_repeats(docs["text"])
    assert got["n_removed"].tolist() == [w[0] for w in want]
    assert got["n_spans"].tolist() == [w[1] for w in want]
    assert got["kept_sha256"].tolist() == [plain.sha(w[2]) for w in want]


def test_hot_rows_reach_no_plan_with_a_cross_join(spark, odd):
    plan = prob_minhash.near_duplicate_classes(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
