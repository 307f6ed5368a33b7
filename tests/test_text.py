import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.encoding import PieceTrie, basic_words, word_pieces
from corpusloom.functions import stemming
from corpusloom.functions.stemming import stem
from corpusloom.operators import encode, features, text
from corpusloom.operators.storage import ROWS_A_BATCH, TEXTS_AT_ONCE


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def test_token_rules(spark):
    words = "a ab " + "x" * 15 + " " + "y" * 16 + " ab1cd _led in_side ÉTÉ naïve don't"
    tokens = text.tokenize(docs(spark, words), "text").first().tokens
    assert tokens == ["ab", "x" * 15, "ab", "cd", "in_side", "été", "naïve", "don"]
    assert text.tokenize(docs(spark, "1 2 !"), "text").first().tokens == []


def test_stop_words_keep_repeats_and_order(spark):
    df = text.remove_stopwords(text.tokenize(docs(spark, "The cell et the cell de la wall"), "text"))
    assert df.first().tokens == ["cell", "cell", "wall"]
    plain = text.remove_stopwords(text.tokenize(docs(spark, "the cell et"), "text"), words=["the"])
    assert plain.first().tokens == ["cell", "et"]


@pytest.mark.parametrize("word, want", [
    ("consistency", "consist"), ("knightly", "knight"), ("skies", "sky"), ("dying", "die"), ("happy", "happi"),
    ("enjoy", "enjoy"), ("generalization", "general"), ("relational", "relat"), ("hopping", "hop"), ("hoping", "hope"),
    ("agreed", "agre"), ("feed", "feed"), ("gas", "gas"), ("kiwis", "kiwi"), ("ties", "tie"), ("cries", "cri"),
    ("innings", "inning"), ("proceed", "proceed"), ("adoption", "adopt"), ("controll", "control"), ("rate", "rate"),
    ("cease", "ceas"), ("sky", "sky"), ("is", "is"), ("communism", "communism"), ("news", "news"), ("sensational", "sensat"),
])
def test_stems(word, want):
    assert stem(word) == want


def test_only_words_with_an_ending_of_a_rule_go_through_the_rules():
    rnd = random.Random(5)
    ends = [*stemming.STEP2, *stemming.STEP3, *stemming.STEP4, *stemming.PAST, "s", "ies", "ied", "sses", "y", "ay", "e", "ll", ""]
    words = [*stemming.IRREGULAR, *stemming.SETTLED, "yyy", "Yaa", "aYa", "naïve", "été", "ſſſ", "ooo"]
    words += ["".join(rnd.choices("aeiouybcdlnrstéY", k=rnd.randint(1, 8))) + rnd.choice(ends) for _ in range(20_000)]
    by_rules = stemming._stem_by_rules
    before = by_rules.cache_info().currsize
    assert stem("ratatouo") == "ratatouo" and by_rules.cache_info().currsize == before  # left alone at once
    assert [(w, stem(w)) for w in words] == [(w, by_rules(w) if len(w) > 2 else w) for w in words]


def test_stem_arrays_keep_shape(spark):
    rows = [(1, ["cells", "cells", "dividing"]), (2, []), (3, None)]
    df = text.stem_tokens(spark.createDataFrame(rows, "id int, tokens array<string>"))
    got = {r.id: r.tokens for r in df.collect()}
    assert got == {1: ["cell", "cell", "divid"], 2: [], 3: None}


@F.arrow_udf(T.IntegerType())
def rows_at_once(tokens: pa.Array) -> pa.Array:
    return pa.array([len(tokens)] * len(tokens), pa.int32())


@pytest.mark.parametrize("given, most", [("10000", TEXTS_AT_ONCE), ("0", TEXTS_AT_ONCE), ("100", 100)])
def test_a_worker_gets_few_texts_at_once(spark, given, most):
    before = spark.conf.get(ROWS_A_BATCH)
    spark.conf.set(ROWS_A_BATCH, given)
    try:
        rows = spark.range(3 * TEXTS_AT_ONCE + 7, numPartitions=1).select(F.array(F.concat(F.lit("cells"), F.col("id").cast("string"))).alias("tokens"))
        seen = [r[0] for r in text.stem_tokens(rows).select(rows_at_once("tokens")).collect()]
        split = encode.word_piece_tokens(rows.select(F.col("tokens")[0].alias("text")), "text", spark.createDataFrame([("cells",)], "term string"))
        pieces = [r[0] for r in split.select(rows_at_once("tokens")).collect()]
    finally:
        spark.conf.set(ROWS_A_BATCH, before)
    assert len(seen) == len(pieces) == 3 * TEXTS_AT_ONCE + 7
    assert max(seen) == max(pieces) == most


def test_punctuation(spark):
    assert text.remove_punctuation(docs(spark, "a--b  c"), "text").first().tokens == ["ab", "", "c"]
    assert text.remove_punctuation(docs(spark, 'It\'s [A\\B] "q"+='), "text").first().tokens == ["Its", "AB", "q+="]


def test_word_count_and_histogram(spark):
    df = docs(spark, *["w " * n for n in (1, 2, 2, 3, 3, 3, 4, 4, 10)])
    assert text.word_count(docs(spark, "a_b c-d 1,2 é"), "text").first().n_words == 6
    bins = text.word_histogram(df, "text").orderBy("bin").collect()
    # quartiles 2 and 4: width = min(2 * 2 / 9^(1/3), 9 / (log2(9) + 1)) = 1.923, so 5 bins over 1..10
    assert len(bins) == 5 and sum(b.docs for b in bins) == 9
    assert bins[0].bin_start == 1.0 and bins[-1].bin_end == 10.0 and bins[-1].docs == 1
    same = text.word_histogram(docs(spark, "a b", "c d"), "text").collect()
    assert [(b.bin, b.docs) for b in same] == [(0, 2)]


def test_vocab_filter_small_and_large(spark):
    rows = [(1, ["a", "b", "a", "c"]), (2, ["z"]), (3, ["b"]), (1, ["b"]), (4, []), (5, None)]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    vocab = spark.createDataFrame([("a",), ("b",), ("b",)], "term string")
    for literals in (10, 1):
        got = sorted(map(tuple, text.vocab_filter(df, vocab, "id", literals=literals).collect()))
        assert got == [(1, ["a", "b", "a"]), (1, ["b"]), (3, ["b"])]


def test_word_frequencies_by_group(spark):
    df = spark.createDataFrame([("x", ["the", "a1", "bb", "bb"]), ("y", ["cc"])], "cluster string, tokens array<string>")
    got = {(r.cluster, r.term): (r.n, r.frequency) for r in text.group_word_frequencies(df, "cluster", top=5).collect()}
    assert got == {("x", "bb"): (2, 1.0), ("x", "a1"): (1, 0.5), ("y", "cc"): (1, 1.0)}


def test_document_frequency_limits(spark):
    rows = [(i, ["all"] + (["most"] if i < 19 else []) + (["one"] if i == 0 else []) + ["two"] * (i < 2)) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    vocab = features.vocabulary(df, max_features=10, min_df=2, max_df=0.95)
    assert vocab.terms == ["most", "two"]  # "most" is in exactly 95 %, "all" in more, "one" in one document


def test_tfidf_by_hand(spark):
    import math

    df = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["b"]), (3, ["stop"])], "id int, tokens array<string>")
    vocab = features.Vocabulary(["a", "b"], [2, 2], [1, 2], 3)
    cells = features.long_form(features.tfidf_features(df, vocab), vocab, "id")
    got = {(r.id, r.term): r.weight for r in cells.collect()}
    a, b = 2 * (math.log(4 / 2) + 1), math.log(4 / 3) + 1
    norm = math.hypot(a, b)
    assert got == pytest.approx({(1, "a"): a / norm, (1, "b"): b / norm, (2, "b"): 1.0})
    assert features.tfidf_features(df, vocab).count() == 3  # the empty document keeps its row


def test_ngrams(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a"])], "id int, tokens array<string>")
    got = {r.id: r.tokens for r in features.ngrams(df, longest=3).collect()}
    assert got == {1: ["a", "b", "c", "a b", "b c", "a b c"], 2: ["a"]}


def test_encoding(spark):
    df = spark.createDataFrame([(1, ["x", "q"]), (2, ["x"] * 3), (3, ["x"] * 4)], "id int, tokens array<string>")
    vocab = spark.createDataFrame([("[PAD]", 0), ("[UNK]", 1), ("[CLS]", 2), ("[SEP]", 3), ("x", 9)], "term string, id int")
    want = {1: ([2, 9, 1, 3, 0], [1, 1, 1, 1, 0]), 2: ([2, 9, 9, 9, 3], [1, 1, 1, 1, 1])}
    rows = encode.encode_tokens(df, vocab, "id", max_len=5).collect()
    assert {r.id: (r.ids, r.mask) for r in rows} == want
    assert all(r.segments == [0] * 5 for r in rows)


def test_ids_do_not_depend_on_the_size_of_the_vocabulary(spark):
    rows = [(1, ["x", "q"], "e"), (1, ["x"], "e"), (2, [], None), (3, None, "e"), (4, [None, "x"], "e")]
    df = spark.createDataFrame(rows, "id int, tokens array<string>, extra string")
    vocab = spark.createDataFrame([("x", 7), ("x", 5), ("y", 6)], "term string, id int")
    want = sorted([(1, [5, 1, 0], "e"), (1, [5, 0, 0], "e"), (2, [0, 0, 0], None), (3, None, "e"), (4, [1, 5, 0], "e")], key=repr)
    for terms in (10, 1):
        got = encode.encode_token_ids(df, vocab, "id", max_len=3, lookup_terms=terms)
        assert got.columns == ["id", "tokens", "extra", "ids"]
        assert sorted([(r.id, r.ids, r.extra) for r in got.collect()], key=repr) == want
        assert sorted([r.tokens for r in got.collect()], key=repr) == sorted([r[1] for r in rows], key=repr)


def test_budget_edges(spark):
    df = spark.createDataFrame([(n, ["x"] * n) for n in (898, 899)], "id int, tokens array<string>")
    assert [r.id for r in text.within_token_budget(df).collect()] == [898]
    with pytest.raises(Exception, match="more tokens than the input length"):
        encode.encode_masks(df, max_len=10).collect()


def test_segments(spark):
    rows = [(1, ["a", "b"]), (2, ["a", "[SEP]"]), (3, ["a", "[SEP]", "b", "[SEP]"])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    got = {r.id: r.segments for r in encode.encode_segments(df, max_len=5).collect()}
    assert got == {1: [0] * 5, 2: [0] * 5, 3: [0, 0, 1, 1, 0]}


def test_word_pieces(spark):
    vocab = {"un", "##aff", "##able", "cafe", "!", "the"}
    assert word_pieces("unaffable", PieceTrie(vocab)) == ["un", "##aff", "##able"]
    assert word_pieces("unknown", PieceTrie(vocab)) == ["[UNK]"] == word_pieces("un" * 101, PieceTrie({"un", "##un"}))
    assert basic_words("Café!x") == ["cafe", "!", "x"]
    table = spark.createDataFrame([(t, i) for i, t in enumerate(sorted(vocab))], "term string, id int")
    df = encode.word_piece_tokens(docs(spark, "The  unaffable Café!", " ", "zzz"), "text", table)
    got = {r.id: r.tokens for r in df.collect()}
    assert got == {0: ["the", "un", "##aff", "##able", "cafe", "!"], 1: [], 2: ["[UNK]"]}


def longest_match(word, vocab):
    """The greedy split by trying every end from the right."""
    pieces, start = [], 0
    while start < len(word):
        mark = "##" if start else ""
        end = next((e for e in range(len(word), start, -1) if mark + word[start:e] in vocab), None)
        if end is None:
            return ["[UNK]"]
        pieces.append(mark + word[start:end])
        start = end
    return pieces


def test_piece_trie_matches_the_greedy_split():
    rng = random.Random(8)
    some = lambda n, letters="ab#": "".join(rng.choice(letters) for _ in range(n))
    for _ in range(400):
        vocab = {rng.choice(["", "##"]) + some(rng.randrange(1, 5)) for _ in range(rng.randrange(1, 12))} | {"##"} - {rng.choice(["##", "x"])}
        trie = PieceTrie(vocab)
        for word in [some(rng.randrange(0, 9)) for _ in range(20)]:
            assert word_pieces(word, trie) == longest_match(word, vocab), (word, vocab)


def plain_pairs(docs, least):
    """Counts of single words and accepted pairs, by the definition of the test."""
    import collections
    import math

    single, pair = collections.Counter(w for d in docs for w in d), collections.Counter(p for d in docs for p in zip(d, d[1:], strict=False))
    n, out = sum(single.values()), collections.Counter(single)
    log = lambda k, m, x: math.log(max(x, 1e-10)) * k + math.log(max(1 - x, 1e-10)) * (m - k)
    for (a, b), c in pair.items():
        first, second = single[a], single[b]
        if n > first and n > second:
            p, with_, without = second / n, c / first, (second - c) / (n - first)
            if 2 * (log(c, first, with_) + log(second - c, n - first, without) - log(c, first, p) - log(second - c, n - first, p)) > least:
                out[a] -= c
                out[b] -= c
                out[f"{a} {b}"] = c
    return {t: c for t, c in out.items() if c > 0}


def test_pairs_of_words(spark):
    rng = random.Random(9)
    docs = [[w for _ in range(rng.randrange(12)) for w in (["new", "york"] if rng.random() < 0.3 else [rng.choice("abcdefg")])] for _ in range(120)] + [[], ["a"]]
    df = spark.createDataFrame([(i, i % 2, d) for i, d in enumerate(docs)], "id int, g int, tokens array<string>")
    got = {r.term: r.n for r in text.word_frequencies(df, words=["zz"], top=1000, pairs=True).collect()}
    assert got == plain_pairs(docs, text.PAIR_SCORE) and got["new york"] > 50
    by = text.group_word_frequencies(df, "g", words=["zz"], top=1000, pairs=True).collect()
    for g in (0, 1):
        assert {r.term: r.n for r in by if r.g == g} == plain_pairs(docs[g::2], text.PAIR_SCORE)
    stop = {r.term for r in text.word_frequencies(df, words=["york"], top=1000, pairs=True).collect()}
    assert "new york" not in stop and "york" not in stop and "new" in stop


def test_pairs_are_joined_with_counted_words_of_known_size(spark, monkeypatch):
    seen, counts = [], text.pair_counts
    monkeypatch.setattr(text, "pair_counts", lambda df, col, stop, singles, *rest: seen.append(singles) or counts(df, col, stop, singles, *rest))
    df = spark.createDataFrame([(["new", "york", "the", "new", "york", None, "york"],), (["one"],), ([],), (None,)], "tokens array<string>")
    terms = {r.term: r.n for r in text.word_frequencies(df, words=["the"], pairs=True).collect()}
    assert terms == {"new": 2, "york": 3, "one": 1}
    assert seen[0].inputFiles()  # a file, not a checkpoint of unknown size
    found = counts(df, "tokens", ["the"], seen[0], [], least=-1)
    assert [tuple(r) for r in found.collect()] == [("new", "york", 2)]


def test_token_head_and_cluster_join(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"])], "paper_number int, tokens array<string>")
    clusters = spark.createDataFrame([(1, 4)], "paper_number int, cluster int")
    assert text.cluster_tokens(clusters, df, "paper_number", n=2).first().tokens == ["a", "b"]
    assert text.cluster_count(clusters).first().clusters == 1
    assert df.select(F.size("tokens")).first()[0] == 3


def test_large_vocabularies_on_moved_rows(spark):
    """Rows behind a shuffle: each is numbered once, whatever is computed again."""
    rng = random.Random(11)
    rows = [(i % 40, [rng.choice("abcdefgh") + str(rng.randrange(3)) for _ in range(rng.randrange(6))]) for i in range(120)] + [(7, None), (7, [])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>").repartition(5)
    vocab = spark.createDataFrame([(f"{c}{n}", 10 + i) for i, (c, n) in enumerate((c, n) for c in "abcd" for n in range(3))], "term string, id int")
    for large, small in (
        (text.vocab_filter(df, vocab, "id", literals=0), text.vocab_filter(df, vocab, "id")),
        (encode.encode_token_ids(df, vocab, "id", max_len=8, lookup_terms=0), encode.encode_token_ids(df, vocab, "id", max_len=8)),
    ):
        assert sorted(map(repr, large.collect())) == sorted(map(repr, small.collect()))
