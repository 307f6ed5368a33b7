"""Conversation repair, language identification and centroid clustering against plain versions."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import plain
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from corpusloom.llm import conversation_repair as repair
from corpusloom.llm import cross_parsing as parsing
from corpusloom.llm import shallot_clusters as shallot

ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", " ", "User"]
TEXTS = ["a.", "b!", "c", " ", "", "d?", "e.", "f. \n", "g. ", "h"]


def random_rows(rng, most):
    return [(rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(rng.randrange(most))]


def faults_of(rows):
    return [repair.fault_of(*row, row in rows[:i]) for i, row in enumerate(rows)]


def test_edits_are_the_cheapest_with_the_least_letters():
    rng = random.Random(1)
    for _ in range(1500):
        rows = random_rows(rng, 12)
        faults = faults_of(rows)
        rows_as = [repair.row_transfer(r[:1], f) for (r, _), f in zip(rows, faults, strict=True)]
        found = list(repair.edits_of([r for r, _ in rows], faults, repair.START, repair.last_state(rows_as), True))
        out = tuple((new, "" if i is None else rows[i][1]) for i, letter, new, _ in found if letter != "D")
        assert (sum(e[3] for e in found), "".join(e[1] for e in found), out) == plain.repaired(rows)


def test_pieces_meet_where_the_whole_would_cross():
    rng = random.Random(2)
    for _ in range(500):
        rows = random_rows(rng, 40) + [("user", "z.")] * 2
        faults = faults_of(rows)
        each = [repair.row_transfer(r[:1], f) for (r, _), f in zip(rows, faults, strict=True)]
        ends = [0, *sorted(rng.sample(range(1, len(rows)), rng.randrange(1, len(rows)))), len(rows)]
        spans = list(zip(ends[:-1], ends[1:], strict=True))
        pieces = [repair.piece_transfer(each[a:b]) for a, b in spans]
        met = repair.crossings(pieces, repair.START, repair.last_state(pieces))
        whole = repair.crossings(each, repair.START, repair.last_state(each))
        assert met == [whole[e] for e in ends]


SCHEMA = "conv_id long, turn long, role string, text string, place string, sub int, conv string"


def by_hand(rows):
    """The contract's report of damaged rows, conversation by conversation."""
    found = {}
    for conv in {r[0] for r in rows}:
        hurt = []
        for _, turn, role, text in (r[:4] for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            hurt += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        hurt.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        pairs = [r[1:] for r in hurt]
        faults = collections.Counter(faults_of(pairs))
        turns = [r[0] for r in hurt if r[0] is not None]
        initials = [r[:1] for r, _ in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, out = plain.repaired(pairs)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        found[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha)
    return found


def reported(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def odd_conversations():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(ROLES), f"{rng.choice(TEXTS)}{t % 5}{rng.choice(TEXTS)}") for c in range(30) for t in range(rng.randrange(9))]
    rows += [(99, None, None, None), (99, 4, "user", "x."), (99, None, "user", "y."), (None, 1, "user", "lone"), (None, None, "assistant", None)]
    rows += [(7, 2, "user", "same.")] * 3 + [(8, 5, "assistant", "long " * 400_000 + "end.")]
    rows += [(500, t, ROLES[1 + t % 2] if rng.random() < 0.8 else rng.choice(ROLES), rng.choice(["ok.", f"turn {t}.", f"turn {t}"])) for t in range(900)]
    return [(*r, "x", 1, "y") for r in rows]


@pytest.mark.parametrize("parts", [1, 7])
def test_report_of_odd_conversations(spark, parts):
    rows = odd_conversations()
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        edits = repair.repair_conversations(repair.damage(df))
        assert len(edits) == (1 if parts == 1 else 2)  # conversation 500 lies in several partitions
        got = reported(repair.damage_report(df))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == by_hand(rows)


def test_repaired_rows_are_legal(spark):
    df = spark.createDataFrame(odd_conversations(), SCHEMA).where("conv_id < 30")
    edits = repair.repair_conversations(df)
    assert set(edits[0].columns) == {"conv", "place", "sub", "turn", "old_role", "fault", "letter", "cost", "role", "text"}
    rows = [r for e in edits for r in e.collect()]
    order = collections.defaultdict(str)
    for r in sorted(rows, key=lambda r: (r.conv, r.place, r.sub)):
        order[r.conv] += "" if r.letter == "D" else r.role[0]
    assert len(order) > 20 and all(re.fullmatch("(s?(ua)+)?", o) for o in order.values())


def test_no_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair.damage_report(df).collect() == []


def test_parse_is_greedy():
    rng = random.Random(4)
    for alphabet in (b"ab", b"abcd ", bytes(range(60, 90))):
        sample = bytes(rng.choice(alphabet) for _ in range(300)) + parsing.BREAK + bytes(rng.choice(alphabet) for _ in range(200))
        language = parsing.Language("x", len(sample), 1, parsing.suffix_automaton(sample))
        texts = [bytes(rng.choice(alphabet + b"z") for _ in range(rng.choice([0, 1, 5, 1023, 1024, 1025, 3000]))) for _ in range(20)]
        got = parsing.bits(texts, [language], [language.tables()])[:, 0]
        for text, value in zip(texts, got, strict=True):
            wanted = plain.fewest_phrases(text, sample, parsing.STRETCH)
            assert value == pytest.approx(wanted * np.log2(parsing.LEAST_SIZE) / max(1, len(text)))


def test_languages_of_documents(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet").set_index("doc_id")
    got = spark_entry.queries()["op12_cross_parsing"](spark, sf_dir).toPandas().set_index("doc_id")
    held = pd.Series({i: zlib.crc32(str(i).encode()) % 5 == 0 for i in docs.index})
    assert (got.held_out == held.reindex(got.index)).all() and got.score.between(0, 1).all()
    right = got.lang_pred == docs.lang.reindex(got.index)
    assert right[got.held_out].mean() >= 0.97 and right.mean() >= 0.97
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learned = parsing.train_languages(df.where(~parsing.fifth()), most=6_000)
    assert [x.name for x in learned] == sorted(docs.lang.unique()) and all(x.size <= 6_000 for x in learned)
    texts = [parsing.letters(t) for t in docs.text[:12]]
    samples = {x.name: parsing.bits(texts, [x], [x.tables()])[:, 0] for x in learned}
    found = parsing.identify_languages(df.where(F.col("doc_id").isin(docs.index[:12].tolist())), learned).toPandas().set_index("doc_id")
    for i, doc_id in enumerate(docs.index[:12]):
        assert samples[found.lang_pred[doc_id]][i] == min(s[i] for s in samples.values()) == found.bits[doc_id]


def test_odd_texts_and_no_languages(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 ½ !!", None), (3, "12 ½ !!", None), (None, "the cat sat on the mat", "en"), (4, "le chat dans la maison", "fr"), (5, "the house on the mat and the cat sat " * 80_000, "en")]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, lang string, bits int, score string")
    learned = parsing.train_languages(df)
    assert {x.name: x.documents for x in learned} == {"en": 2, "fr": 1}
    found = parsing.identify_languages(df, learned)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score", "bits"]
    got = sorted((r.doc_id or 0, r.lang_pred) for r in found.collect())
    assert got == [(0, "en"), (1, "und"), (2, "und"), (3, "und"), (3, "und"), (4, "fr"), (5, "en")]
    none = parsing.train_languages(df.where("lang = 'xx'"))
    assert none == [] and {r.lang_pred for r in parsing.identify_languages(df, none).collect()} == {"und"}
    assert parsing.identify_languages(df.where("doc_id = 77"), learned).count() == 0


def test_a_small_sample_is_not_cheap():
    rng = random.Random(12)
    some = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(3)) for _ in range(n)).encode()
    large, small = some("abcde", 8_000), some("axyz", 6)
    languages = [parsing.Language(n, len(s), 1, parsing.suffix_automaton(s)) for n, s in (("large", large), ("small", small))]
    best, _ = parsing.choose(parsing.bits([some("abcde", 20), small], languages, [x.tables() for x in languages]), languages)
    assert best.tolist() == [0, 1]


def test_equal_languages_go_to_the_more_common():
    sample = parsing.suffix_automaton(b" abc ")
    languages = [parsing.Language("a", 5, 2, sample), parsing.Language("b", 5, 9, sample), parsing.Language("c", 5, 9, sample)]
    best, score = parsing.choose(parsing.bits([b" abc "], languages, [x.tables() for x in languages]), languages)
    assert best.tolist() == [1] and score.tolist() == [0.0]


def test_search_finds_the_nearest_and_skips_work():
    rng = np.random.default_rng(5)
    centres = rng.integers(-60, 60, (16, 8))
    x = centres[rng.integers(0, 16, 3000)] + rng.integers(-9, 10, (3000, 8))
    points, before = x[:16].copy(), None
    points[5] = points[4]  # equal centroids
    bounds, spent = shallot.unknown(len(x), 16), []
    for _ in range(6):
        bounds, measured = shallot.search(x, bounds, shallot.Centroids(points, before))
        gaps = ((x[:, None] - points[None]) ** 2).sum(axis=2)
        assert (bounds.first == gaps.argmin(axis=1)).all()
        others = np.sqrt(np.where(np.arange(16) == bounds.first[:, None], 1 << 40, gaps).min(axis=1))
        assert (bounds.upper >= np.sqrt(gaps.min(axis=1)) - 1e-9).all() and (bounds.lower <= others + 1e-9).all()
        spent.append(measured)
        before, points = points, np.array([x[bounds.first == j].sum(axis=0) // max(1, (bounds.first == j).sum()) if (bounds.first == j).any() else points[j] for j in range(16)])
    assert spent[-1] < spent[0] / 4 and spent[0] < 16 * len(x)


def test_clusters_of_odd_vectors(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([rng.uniform(-1, 1), 0.25 * rng.randrange(-2, 3)]) for _ in range(4)]) for i in range(200)]
    rows += [(None, [0.5] * 4), (3, [0.5] * 4), (3, [0.5] * 4), (777, [-1e30, 1e30, 0.0, 0.1])]
    bad = [(900, None), (901, []), (902, [1.0] * 3), (903, [1.0] * 5), (904, [1.0, None, 1.0, 1.0]), (905, [float("nan")] * 4), (906, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2.0, "z") for r in rows + bad], "vec_id long, embedding array<double>, id int, x double, first string")
    placed, points = shallot.cluster_vectors(df, k=5, rounds=3, dims=4)
    cut = lambda e: int(np.floor(min(max(64 * e, -shallot.MOST), shallot.MOST)))
    whole = [(i, [cut(e) for e in v]) for i, v in rows]
    wanted, centroids = plain.k_means(whole, 5, 3)
    got = collections.Counter((r.id, r.cluster, r.distance) for r in placed.collect())
    assert points.tolist() == centroids
    assert got == collections.Counter((i, c, d) for (i, _), (c, d) in zip(whole, wanted, strict=True))
    facts = shallot.with_inertia(placed, points).collect()
    assert all(r.inertia == sum(d for _, d in wanted) for r in facts)
    assert all(r.centroid_sha256 == plain.sha(",".join(map(str, centroids[r.cluster])).encode()) for r in facts)


def test_fewer_vectors_than_centroids(spark):
    schema = "vec_id long, embedding array<float>"
    one, points = shallot.cluster_vectors(spark.createDataFrame([(1, [0.5, 0.5])], schema), dims=2)
    assert [tuple(r) for r in one.collect()] == [(1, 0, 0)] and points.tolist() == [[32, 32]]
    none, points = shallot.cluster_vectors(spark.createDataFrame([], schema))
    assert shallot.with_inertia(none, points).collect() == []
