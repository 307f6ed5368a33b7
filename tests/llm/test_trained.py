"""The trained operators: the field, toxicity, quality, language-model scores, and the pipeline."""

import itertools
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import plain
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline
from corpusloom.llm import attention, crf, line_quality, lm_scoring, prob_minhash, toxic_spans


@pytest.fixture(scope="module")
def docs(sf_dir):
    return pd.read_parquet(f"{sf_dir}/documents.parquet")


def path_score(scores, moves, labels):
    return sum(s[k] for s, k in zip(scores, labels, strict=True)) + sum(moves[a, b] for a, b in itertools.pairwise(labels))


def test_field_against_all_label_sequences():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 1, 5, 2])
    scores, moves = rng.normal(size=(11, 2)), rng.normal(size=(2, 2))
    shares, best = crf.marginals(scores, lengths, moves), crf.viterbi(scores, lengths, moves)
    assert np.allclose(crf.marginals_of_two(scores[:, 1] - scores[:, 0], lengths, moves), shares[:, 1])
    assert np.allclose(crf.marginals_of_two(np.array([1e9, -1e9, 1e9]), np.array([3]), moves), [1, 0, 1])
    at = 0
    for n in lengths:
        own = scores[at : at + n]
        paths = {p: path_score(own, moves, p) for p in itertools.product((0, 1), repeat=int(n))}
        total = np.logaddexp.reduce(list(paths.values()))
        for i in range(n):
            one = np.exp(np.logaddexp.reduce([v for p, v in paths.items() if p[i]]) - total)
            assert shares[at + i, 1] == pytest.approx(one)
        assert tuple(best[at : at + n]) == max(paths, key=paths.get)
        assert best[at : at + n].tolist() == (plain.best_labels(own, moves) if n else [])
        at += n


def test_field_learns_what_the_labels_say():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 8, 80)
    n = lengths.sum()
    features = rng.integers(0, 6, n)
    labels = (features >= 4).astype(int)
    model = crf.train(features, np.ones(n, int), labels, lengths, 6)
    assert (crf.viterbi(model.scores(features, np.ones(n, int)), lengths, model.moves) == labels).mean() > 0.98
    kinds = crf.train(np.arange(6), np.ones(6, int), labels, lengths, 6, rows=features)
    assert np.allclose(kinds.weights, model.weights) and np.allclose(kinds.moves, model.moves)


ODD = [(1, None, 5), (2, "", 5), (3, "### || !!!", 5), (3, "### || !!!", 5), (None, "word " * 3000, 5), (4, "x", None)]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, score int").repartition(2)


def test_toxicity_on_held_out_documents(spark):
    got = spark_entry.queries()["op2_toxic_spans"](spark, "/root/testdata/sf0.01").toPandas()
    assert got["held_out"].tolist() == [zlib.crc32(str(k).encode()) % 5 == 0 for k in got["doc_id"]]
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.5).astype(int) == got["predicted"]).all()
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    held = got[got["held_out"]].merge(labels, on="doc_id")
    assert (held["predicted"] == held["toxic"]).mean() >= 0.93


def test_toxic_spans_of_planted_words(spark):
    rng = np.random.default_rng(2)
    text = lambda: [f"w{rng.integers(0, 300)}" for _ in range(40)]
    bad = [" ".join([*text(), "Zorgly", *text()]) for _ in range(60)]
    table = [(i, t, 1) for i, t in enumerate(bad)] + [(100 + i, " ".join(text()), 0) for i in range(200)]
    df = spark.createDataFrame(table, "doc_id long, text string, toxic int")
    tagger = toxic_spans.train_tagger(df, df.select("doc_id", "toxic"))
    new = [(1, "Fine words. ZORGLY! " * 2), (2, "fine words only"), (3, None), (4, ""), (5, "Zorgly")]
    got = {r.doc_id: r for r in toxic_spans.score_documents(spark.createDataFrame(new, "doc_id long, text string"), tagger).collect()}
    assert [(s.start, s.end) for s in got[1].toxic_spans] == [(12, 18), (32, 38)] and got[1].predicted == got[5].predicted == 1
    assert got[2].predicted == got[3].predicted == got[4].predicted == 0 and got[3].score == got[4].score


def test_scoring_without_labels_and_of_odd_rows(spark, odd):
    none = spark.createDataFrame([(1, 7, None), (None, 1, 1)], "doc_id long, toxic int, quality int")
    tagger = toxic_spans.train_tagger(odd, none)
    got = toxic_spans.score_documents(odd, tagger)
    assert got.columns == ["doc_id", "text", "score", "predicted", "toxic_spans"]
    assert [r.score for r in got.collect()] == [0.5] * len(ODD)
    model = line_quality.train_line_model(odd, none)
    judged = line_quality.judge_documents(odd.withColumnRenamed("score", "kept"), model)
    assert sorted(r.kept for r in judged.collect()) == [False] * len(ODD)  # too few words, or all repeated
    assert judged.where("doc_id = 1").first().n_words == 0
    assert toxic_spans.score_documents(odd.limit(0), tagger).count() == line_quality.judge_documents(odd.limit(0), model).count() == 0


def judged(model, text):
    """Verdict of one text by definition."""
    facts = plain.base_facts(text)
    features, sizes, *_ = line_quality.document_lines(text or "")
    scores = np.array([model.weights[f].sum(axis=0) for f in features])
    labels = np.array(plain.best_labels(scores, model.moves))
    share = float(np.dot(labels == line_quality.CONTENT, sizes)) / max(1, sum(sizes))
    return (*facts, not facts[-1] and share >= line_quality.CONTENT_SHARE)


def test_op10(spark, sf_dir, docs):
    got = spark_entry.queries()["op10_line_labelling_quality"](spark, sf_dir).toPandas().set_index("doc_id")
    model = line_quality.train_line_model(spark.createDataFrame(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    for key, text in zip(docs["doc_id"], docs["text"], strict=True):
        assert tuple(got.loc[key, names]) == judged(model, text)
    labels = pd.read_parquet(f"{sf_dir}/labels.parquet").set_index("doc_id")["quality"]
    both = got.join(labels, how="inner")
    long = both[both["n_words"] >= 50]
    assert (long.loc[long["quality"] == 1, "kept"]).mean() >= 0.95


def test_windows_score_every_place_once():
    lengths = np.array([0, 1, attention.LENGTH, attention.LENGTH + 1, 100, 1])
    targets = np.arange(lengths.sum()) % 50
    read, wanted, scored, owner = attention.windows(targets, lengths)
    assert np.bincount(owner, scored.sum(axis=1), len(lengths)).tolist() == lengths.tolist()
    starts = np.cumsum(lengths) - lengths
    for i, n in enumerate(lengths):
        own = targets[starts[i] : starts[i] + n]
        assert wanted[owner == i][scored[owner == i]].tolist() == own.tolist()
        before = [attention.BEGIN, *own[:-1]] if n else []
        assert read[owner == i][scored[owner == i]].tolist() == before


def test_held_out_score_gains_from_longer_context():
    assert attention.LENGTH >= 2 * attention.FRESH  # a scored place reads half a window before it, or all there is
    rng = np.random.default_rng(4)
    text = lambda: np.repeat(rng.integers(0, 100, 2), 50)[rng.permutation(100)]
    targets, lengths = np.concatenate([text() for _ in range(300)]), np.full(300, 100)
    start = attention.fresh_weights(np.full(attention.CLASSES, 1 / attention.CLASSES))
    model = attention.fit(start, *attention.windows(targets, lengths)[:3], 400)
    read, wanted, scored, _ = attention.windows(np.concatenate([text() for _ in range(50)]), np.full(50, 100))
    near = np.flatnonzero(scored[1])[0]  # the second window's first scored place, which reads the places before it
    p = attention.log_probabilities(model, read, wanted)
    assert near >= 32 and p[1::3, near:].mean() > p[0::3, :6].mean() + 0.1


def test_attention_looks_back_only_and_its_gradient_is_right():
    rng = np.random.default_rng(0)
    weights = attention.fresh_weights(np.full(attention.CLASSES, 1 / attention.CLASSES))
    read, wanted, scored, _ = attention.windows(rng.integers(0, 60, 70), np.array([50, 20]))
    p = attention.log_probabilities(weights, read, wanted)
    later = read.copy()
    later[:, 10:] = 3
    assert np.allclose(attention.log_probabilities(weights, later, wanted)[:, :10], p[:, :10])
    total = sum(10.0 ** attention.log_probabilities(weights, read[:1, :], np.full((1, attention.LENGTH), k)) for k in range(attention.CLASSES))
    assert np.allclose(total, 1, atol=1e-5)
    exact = {k: v.astype(np.float64) for k, v in weights.items()}
    _, slope = attention.gradients(exact, read, wanted, scored)
    for name, value in exact.items():
        at = np.unravel_index(np.abs(slope[name]).argmax(), value.shape)
        around = []
        for step in (1e-5, -1e-5):
            moved = {k: v.copy() for k, v in exact.items()}
            moved[name][at] += step
            around.append(attention.gradients(moved, read, wanted, scored)[0])
        assert slope[name][at] == pytest.approx((around[0] - around[1]) / 2e-5, rel=1e-3)


def base_scores(rows):
    """(n_tokens, n_known, N, base score) per row (text, held out), by definition."""
    texts = [(lm_scoring.words_of(t) + [None], h) for t, h in rows]
    c = Counter(w for ws, h in texts if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(len(ws), sum(c[w] > 0 for w in ws), n, sum(np.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for ws, _ in texts]


def test_op7(spark, sf_dir, docs):
    got = spark_entry.queries()["op7_attention_lm"](spark, sf_dir).toPandas().set_index("doc_id").loc[docs["doc_id"]]
    held = [zlib.crc32(str(k).encode()) % 7 == 2 for k in docs["doc_id"]]
    assert got["held_out"].tolist() == held
    want = base_scores(zip(docs["text"], held, strict=True))
    assert [tuple(r) for r in got[["n_tokens", "n_known", "train_tokens"]].itertuples(index=False)] == [w[:3] for w in want]
    assert np.allclose(got["base_score"], [w[3] for w in want], rtol=1e-9)
    assert (got["score"] < 0).all() and np.isfinite(got["score"]).all()
    # far better than ids without any context, at the same ids
    assert got.loc[held, "score"].sum() / got.loc[held, "n_tokens"].sum() > -6


def test_every_training_document_takes_part_in_the_fit(spark):
    texts = [t for t in (f"one two three {i} four five six" for i in range(100)) if zlib.crc32(t.encode()) % 16]
    classes = attention.id_classes(np.ones(300_000))
    start = attention.flat(attention.fresh_weights(np.full(attention.CLASSES, 1 / attention.CLASSES)))
    for held, same in ((False, False), (True, True)):
        df = spark.createDataFrame([(i, t, held) for i, t in enumerate(texts)], "id long, text string, held_out boolean").coalesce(1)
        blocks = lm_scoring._blocks(df, lm_scoring.BYTE_BPE)
        got = lm_scoring._averaged(blocks, spark.sparkContext.broadcast(classes), start)
        assert np.array_equal(got, start) == same


def test_lm_scores_of_odd_rows(spark):
    rows = [(1, None, False), (1, "", True), (2, "A\tb  a\n", False), (2, "A\tb  a\n", False), (3, "İ ß new", True), (None, "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, mark boolean").repartition(2)
    got = lm_scoring.score_texts(df, F.col("mark")).collect()
    want = base_scores([(t, h is None or h) for _, t, h in rows])
    line = lambda r: (r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9))
    assert sorted(map(line, got)) == sorted((*w[:3], round(w[3], 9)) for w in want)
    assert lm_scoring.score_texts(df.limit(0), F.col("mark")).count() == 0
    alone = lm_scoring.score_texts(df, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in alone} == {(0, 0, 0.0)}


def test_pipeline_against_plain_versions(spark, sf_dir, docs):
    table = spark.createDataFrame(docs)
    model = line_quality.train_line_model(table, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    left = [(int(k), t) for k, t in zip(docs["doc_id"], docs["text"], strict=True) if judged(model, t)[-1]]
    left = list(plain.without_chunks(left).items())
    groups = plain.classes(left)
    left = [(k, t) for k, t in left if groups[k] == k]
    items = pd.read_parquet(f"{sf_dir}/benchmark.parquet")[["item_id", "text"]]
    hits = {k: n for k, _, n, _ in plain.contaminated(left, items.itertuples(index=False))}
    left = dict((k, t) for k, t in left if not hits[k])
    got = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert set(got["doc_id"]) == set(left)
    from corpusloom.llm.sum_of_squares import token_pieces

    want = token_pieces(spark.createDataFrame(list(left.items()), "doc_id long, text string")).toPandas()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got[key].to_numpy())) == sorted(map(tuple, want[key].to_numpy()))
    for _, group in got.groupby("sequence_id"):
        assert group.sort_values("offset")["offset"].tolist() == [0, *group.sort_values("offset")["length"].cumsum().tolist()[:-1]]
        assert group["length"].sum() <= 2048


def test_stages_keep_the_columns_of_documents(spark, sf_dir, docs):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, sf_dir)
        assert out.dtypes == table.dtypes
        assert stage(spark, table.limit(0), sf_dir).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert prob_minhash.SIMILARITY == 0.8 and prob_minhash.SHINGLE_WORDS == 5


def test_only_scored_places_reach_the_last_layer():
    """A long text has windows that score their last places only: the same numbers as from all places, and the slope of the loss."""
    rng = np.random.default_rng(8)
    weights = {k: v.astype(np.float64) for k, v in attention.fresh_weights(np.full(attention.CLASSES, 1 / attention.CLASSES)).items()}
    lengths = np.array([5, 0, 200, attention.LENGTH + 1])
    read, wanted, scored, _ = attention.windows(rng.integers(0, 60, lengths.sum()), lengths)
    assert np.allclose(attention.log_probabilities(weights, read, wanted, scored), attention.log_probabilities(weights, read, wanted) * scored, atol=1e-12)
    looked, forward = [], attention._forward
    attention._forward = lambda w, r, begin: looked.append((len(r), begin)) or forward(w, r, begin)
    try:
        loss, slope = attention.gradients(weights, read, wanted, scored)
    finally:
        attention._forward = forward
    assert looked == [(3, 0), (len(read) - 3, attention.LENGTH - attention.FRESH)]
    every = attention.log_probabilities(weights, read, wanted)[scored]
    assert loss == pytest.approx(-every.mean() * np.log(10))
    for name in ("embed", "place", "query", "key", "value", "mixed", "own", "out"):
        step, at = 1e-5, tuple(rng.integers(0, n) for n in weights[name].shape)
        if name == "embed":
            at = (int(wanted[0, 0]), 3)
        around = []
        for sign in (1, -1):
            moved = {k: v.copy() for k, v in weights.items()}
            moved[name][at] += sign * step
            around.append(attention.gradients(moved, read, wanted, scored)[0])
        assert slope[name][at] == pytest.approx((around[0] - around[1]) / (2 * step), rel=1e-3, abs=1e-7)
