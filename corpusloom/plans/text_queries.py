"""Tokens, word statistics, features and encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.encoding import basic_words
from corpusloom.operators import encode, features, text
from corpusloom.operators.storage import settle
from corpusloom.plans import inputs, sql
from corpusloom.plans.registry import query


def _joined(df, col="tokens"):
    return df.select("paper_number", F.array_join(col, " ").alias("tokens"))


_TOKENS = sql.with_(sql.CORPUS, sql.LISTS, sql.TOKENS)
_JOIN_BACK = (
    "SELECT paper_number, coalesce(string_agg(term, ' ' ORDER BY pos), '') AS tokens "
    "FROM corpus LEFT JOIN {} USING (paper_number) GROUP BY paper_number"
)


@query("tokenize", sql.with_(sql.CORPUS, sql.LISTS) + "SELECT paper_number, array_to_string(tokens, ' ') AS tokens FROM lists")
def tokenize(spark, sf_dir):
    return _joined(inputs.tokens(spark, sf_dir))


@query("remove_stopwords", sql.with_(sql.CORPUS, sql.LISTS, sql.TOKENS, sql.KEPT) + _JOIN_BACK.format("kept"))
def remove_stopwords(spark, sf_dir):
    return _joined(text.remove_stopwords(inputs.tokens(spark, sf_dir)))


@query(
    "stem_tokens",
    sql.with_(sql.CORPUS, sql.LISTS, sql.TOKENS, "kept AS (SELECT * FROM tokens)", sql.STEMS, sql.CLEAN)
    + _JOIN_BACK.format("clean"),
)
def stem_tokens(spark, sf_dir):
    return _joined(text.stem_tokens(inputs.tokens(spark, sf_dir)))


@query("clean_tokens", sql.CLEANED + _JOIN_BACK.format("clean"))
def clean_tokens(spark, sf_dir):
    return _joined(inputs.cleaned(spark, sf_dir))


@query(
    "remove_punctuation",
    f"SELECT doc_id AS paper_number, len(string_split(translate(text, '{sql.MARKS}', ''), ' ')) AS n_tokens, "
    f"array_to_string(string_split(translate(text, '{sql.MARKS}', ''), ' '), '|') AS tokens FROM documents",
)
def remove_punctuation(spark, sf_dir):
    split = text.remove_punctuation(inputs.corpus(spark, sf_dir), "text")
    return split.select("paper_number", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", "|").alias("tokens"))


@query("join_tokens", sql.CLEANED.rstrip() + ",\n" + sql.SEEN + "\n" + _JOIN_BACK.format("seen").replace("AS tokens", "AS document"))
def join_tokens(spark, sf_dir):
    return text.join_tokens(inputs.vector_input(spark, sf_dir)).select("paper_number", "document")


@query(
    "word_count",
    r"SELECT doc_id AS paper_number, len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS n_words FROM documents",
)
def word_count(spark, sf_dir):
    return text.word_count(inputs.corpus(spark, sf_dir), "text").select("paper_number", "n_words")


@query(
    "word_histogram",
    r"""WITH sizes AS (SELECT len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS x FROM documents),
stats AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM sizes),
widths AS (SELECT *, (hi - lo) / (log2(n) + 1) AS sturges, 2 * iqr / pow(n, 1.0 / 3.0) AS fd FROM stats),
bins AS (SELECT lo, hi, CASE WHEN hi = lo THEN 1
  ELSE cast(ceil((hi - lo) / CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END) AS INT) END AS b FROM widths),
placed AS (SELECT CASE WHEN hi = lo THEN 0 ELSE least(cast(floor((x - lo) * b / (hi - lo)) AS INT), b - 1) END AS bin FROM sizes, bins),
grid AS (SELECT unnest(range(0, b)) AS bin, lo, hi, b FROM bins)
SELECT g.bin::INT AS bin, round(lo + g.bin * ((hi - lo) / b), 6) AS bin_start, round(lo + (g.bin + 1) * ((hi - lo) / b), 6) AS bin_end,
  (SELECT count(*) FROM placed p WHERE p.bin = g.bin) AS docs FROM grid g""",
)
def word_histogram(spark, sf_dir):
    bins = text.word_histogram(inputs.corpus(spark, sf_dir), "text")
    return bins.withColumns({c: F.round(c, 6) for c in ("bin_start", "bin_end")})


_COUNTS = "counts AS (SELECT term, count(*) AS n FROM {} GROUP BY term)"


@query("total_word_counts", _TOKENS + "SELECT term, count(*) AS n FROM tokens GROUP BY term")
def total_word_counts(spark, sf_dir):
    return text.term_counts(inputs.tokens(spark, sf_dir))


@query("top_common_words", _TOKENS + "SELECT term, count(*) AS n FROM tokens GROUP BY term ORDER BY n DESC, term LIMIT 10")
def top_common_words(spark, sf_dir):
    return text.top_terms(text.term_counts(inputs.tokens(spark, sf_dir)), 10)


@query(
    "word_frequencies",
    sql.with_(sql.CORPUS, sql.LISTS, sql.TOKENS, f"kept AS (SELECT * FROM tokens WHERE term NOT IN ({sql.STOP}))", _COUNTS.format("kept"))
    + "SELECT term, n, round(n / max(n) OVER (), 6) AS frequency FROM (SELECT * FROM counts ORDER BY n DESC, term LIMIT 200)",
)
def word_frequencies(spark, sf_dir):
    cloud = text.word_frequencies(inputs.tokens(spark, sf_dir), top=200)
    return cloud.withColumn("frequency", F.round("frequency", 6))


@query("document_frequency", _TOKENS + "SELECT term, count(*) AS tf, count(DISTINCT paper_number) AS df FROM tokens GROUP BY term")
def document_frequency(spark, sf_dir):
    return features.document_frequency(inputs.tokens(spark, sf_dir))


@query("max_features_topk", sql.CLEANED.rstrip() + ",\n" + sql.SEEN + ",\n" + sql.vocab(1500) + "\nSELECT term, tf, df FROM vocab")
def max_features_topk(spark, sf_dir):
    return features.top_vocabulary(features.document_frequency(inputs.vector_input(spark, sf_dir)), 1500)


_SEEN_VOCAB = sql.CLEANED.rstrip() + ",\n" + sql.SEEN + ",\n"


@query(
    "vocabulary",
    _SEEN_VOCAB + sql.vocab(1500) + "\nSELECT cast(row_number() OVER (ORDER BY term) - 1 AS INT) AS idx, term, tf, df FROM vocab",
)
def vocabulary(spark, sf_dir):
    return features.vocabulary(inputs.vector_input(spark, sf_dir), max_features=1500).table(spark)


@query(
    "count_features",
    _SEEN_VOCAB + sql.vocab(100, "df BETWEEN 2 AND 0.95 * n_docs")
    + "\nSELECT paper_number, term, cast(count(*) AS DOUBLE) AS n FROM seen JOIN vocab USING (term) GROUP BY paper_number, term",
)
def count_features(spark, sf_dir):
    seen = settle(inputs.vector_input(spark, sf_dir))
    vocab = features.vocabulary(seen, max_features=100, min_df=2, max_df=0.95)
    return features.long_form(features.count_features(seen, vocab), vocab, "paper_number", out="n")


@query(
    "tfidf_features",
    _SEEN_VOCAB + sql.vocab(1500) + ",\n" + sql.tfidf() + "\nSELECT paper_number, term, weight FROM tfidf",
)
def tfidf_features(spark, sf_dir):
    seen = settle(inputs.vector_input(spark, sf_dir))
    vocab = features.vocabulary(seen, max_features=1500)
    cells = features.long_form(features.tfidf_features(seen, vocab), vocab, "paper_number")
    return cells.withColumn("weight", F.round("weight", 6))


_GRAMS = """places AS (SELECT paper_number, term, row_number() OVER (PARTITION BY paper_number ORDER BY pos) AS at FROM seen),
grams AS (SELECT paper_number, term FROM places UNION ALL SELECT a.paper_number, a.term || ' ' || b.term FROM places a
  JOIN places b ON a.paper_number = b.paper_number AND b.at = a.at + 1)"""


@query(
    "ngram_tfidf",
    _SEEN_VOCAB + _GRAMS + ",\n" + sql.vocab(1500, source="grams") + ",\n" + sql.tfidf("grams")
    + "\nSELECT paper_number, term, weight FROM tfidf",
)
def ngram_tfidf(spark, sf_dir):
    vectors, vocab = features.ngram_tfidf(settle(inputs.vector_input(spark, sf_dir)), longest=2, max_features=1500)
    return features.long_form(vectors, vocab, "paper_number").withColumn("weight", F.round("weight", 6))


_IN_VOCAB = _TOKENS.rstrip() + ",\n" + sql.vocab(1500, source="tokens") + "\n"


def _token_vocab(spark, sf_dir, n=1500):
    return features.top_vocabulary(features.document_frequency(inputs.tokens(spark, sf_dir)), n)


@query(
    "vocab_filter",
    _IN_VOCAB + "SELECT paper_number, string_agg(term, ' ' ORDER BY pos) AS tokens FROM tokens JOIN vocab USING (term) GROUP BY paper_number",
)
def vocab_filter(spark, sf_dir):
    return _joined(text.vocab_filter(inputs.tokens(spark, sf_dir), _token_vocab(spark, sf_dir), "paper_number"))


@query(
    "semi_join_vocab",
    _IN_VOCAB + "SELECT term, count(*) AS n FROM tokens WHERE term IN (SELECT term FROM vocab) GROUP BY term",
)
def semi_join_vocab(spark, sf_dir):
    kept = text.semi_join_vocab(inputs.tokens(spark, sf_dir), _token_vocab(spark, sf_dir), "paper_number")
    return kept.groupBy("term").agg(F.count("*").alias("n"))


@query(
    "token_head",
    _TOKENS + "SELECT paper_number, string_agg(term, ' ' ORDER BY pos) AS tokens FROM tokens WHERE pos <= 3000 GROUP BY paper_number "
    "UNION ALL SELECT paper_number, '' FROM lists WHERE len(tokens) = 0",
)
def token_head(spark, sf_dir):
    return _joined(text.token_head(inputs.tokens(spark, sf_dir)))


@query(
    "filter_token_budget",
    sql.with_(sql.CORPUS, sql.LISTS) + "SELECT paper_number, len(tokens) AS n_tokens FROM lists WHERE len(tokens) + 2 <= 900",
)
def filter_token_budget(spark, sf_dir):
    fitting = text.within_token_budget(inputs.tokens(spark, sf_dir), max_len=900)
    return fitting.select("paper_number", F.size("tokens").cast("bigint").alias("n_tokens"))


_CLUSTER_TOKENS = sql.CLEANED.rstrip() + """,
clustered AS (SELECT d.lang AS cluster, c.paper_number, c.term, c.pos FROM (SELECT paper_number, term,
    row_number() OVER (PARTITION BY paper_number ORDER BY pos) AS pos FROM clean) c
  JOIN documents d ON d.doc_id = c.paper_number WHERE c.pos <= 3000)
"""


@query("join_cluster_tokens", _CLUSTER_TOKENS + "SELECT cluster, term, count(*) AS n FROM clustered GROUP BY cluster, term")
def join_cluster_tokens(spark, sf_dir):
    joined = text.cluster_tokens(inputs.clusters(spark, sf_dir), inputs.cleaned(spark, sf_dir), "paper_number")
    return text.term_counts(joined, by=["cluster"])


@query("cluster_count", "SELECT count(DISTINCT lang) AS clusters FROM documents")
def cluster_count(spark, sf_dir):
    return text.cluster_count(inputs.clusters(spark, sf_dir))


# Vocabulary of the encoder: four markers, then the 1500 most frequent tokens.
_ENCODER = sql.vocab(1500, source="tokens") + """,
encoder AS (SELECT term, 3 + row_number() OVER (ORDER BY term) AS id FROM vocab)"""


def _encoder(spark, sf_dir):
    vocab = features.vocabulary(inputs.tokens(spark, sf_dir), max_features=1500)
    words = vocab.table(spark).select("term", (F.col("idx") + 4).alias("id"))
    markers = spark.createDataFrame([("[PAD]", 0), ("[UNK]", 1), ("[CLS]", 2), ("[SEP]", 3)], "term string, id int")
    return markers.unionByName(words)


@query(
    "encode_token_ids",
    _TOKENS.rstrip() + ",\n" + _ENCODER + """,
fitting AS (SELECT paper_number, len(tokens) AS n FROM lists WHERE len(tokens) + 2 <= 900),
looked_up AS (SELECT paper_number, string_agg(coalesce(id, 1), ' ' ORDER BY pos) AS ids
  FROM tokens LEFT JOIN encoder USING (term) GROUP BY paper_number)
SELECT paper_number, '2 ' || coalesce(ids || ' ', '') || '3' || repeat(' 0', 900 - 2 - n) AS ids
FROM fitting LEFT JOIN looked_up USING (paper_number)""",
)
def encode_token_ids(spark, sf_dir):
    marked = encode.with_markers(inputs.tokens(spark, sf_dir), max_len=900)
    ids = encode.encode_token_ids(marked, _encoder(spark, sf_dir), "paper_number", max_len=900)
    return ids.select("paper_number", F.array_join("ids", " ").alias("ids"))


@query(
    "encode_masks",
    sql.with_(sql.CORPUS, sql.LISTS)
    + "SELECT paper_number, trim(repeat('1 ', len(tokens) + 2) || repeat('0 ', 900 - 2 - len(tokens))) AS mask "
    "FROM lists WHERE len(tokens) + 2 <= 900",
)
def encode_masks(spark, sf_dir):
    marked = encode.with_markers(inputs.tokens(spark, sf_dir), max_len=900)
    return encode.encode_masks(marked, max_len=900).select("paper_number", F.array_join("mask", " ").alias("mask"))


@query(
    "encode_segments",
    sql.with_(
        sql.ARTICLES,
        f"pairs AS (SELECT paper_id, len({sql.token_list('abstract')}) + 2 AS n1, len({sql.token_list('body')}) + 1 AS n2 FROM articles)",
    )
    + "SELECT paper_id, trim(repeat('0 ', n1) || repeat('1 ', n2) || repeat('0 ', 900 - n1 - n2)) AS segments "
    "FROM pairs WHERE n1 + n2 <= 900",
)
def encode_segments(spark, sf_dir):
    # Abstract and body as the two sequences of one input.
    pairs = text.tokenize(text.tokenize(inputs.articles(spark, sf_dir), "abstract", "first"), "body", "second")
    cls, sep = F.array(F.lit(encode.CLS)), F.array(F.lit(encode.SEP))
    marked = pairs.select("paper_id", F.concat(cls, "first", sep, "second", sep).alias("tokens"))
    fitting = text.within_token_budget(marked, max_len=900, markers=0)
    return encode.encode_segments(fitting, max_len=900).select("paper_id", F.array_join("segments", " ").alias("segments"))


# Vocabulary of the sub-word encoder: the markers, every letter of a frequent token by itself and inside a word, the 1500 most
# frequent tokens, and their last two and three letters.
_PIECE_VOCAB = sql.vocab(1500, source="tokens") + """,
letters AS (SELECT DISTINCT strip_accents(c) AS c FROM (SELECT unnest(string_split(term, '')) AS c FROM vocab)),
listed AS (SELECT strip_accents(term) AS term FROM vocab UNION SELECT c FROM letters UNION SELECT '##' || c FROM letters
  UNION SELECT '##' || right(strip_accents(term), 2) FROM vocab UNION SELECT '##' || right(strip_accents(term), 3) FROM vocab),
pieces AS (SELECT term, 3 + row_number() OVER (ORDER BY term) AS id FROM listed)"""
_MARK = r"!-/:-@\[-`{-~\p{P}"


def _piece_vocabulary(spark, sf_dir):
    """The same vocabulary; it is bounded by the 1500 tokens."""
    frequent = [basic_words(t)[0] for t in features.vocabulary(inputs.tokens(spark, sf_dir), max_features=1500).terms]
    letters = {c for t in frequent for c in t}
    listed = sorted({*frequent, *letters, *(f"##{c}" for c in letters), *(f"##{t[-n:]}" for t in frequent for n in (2, 3))})
    rows = [("[PAD]", 0), ("[UNK]", 1), ("[CLS]", 2), ("[SEP]", 3), *((t, i + 4) for i, t in enumerate(listed))]
    return spark.createDataFrame(rows, "term string, id int")


@query(
    "encode_word_pieces",
    _TOKENS.rstrip() + ",\n" + _PIECE_VOCAB + rf""",
chunks AS (SELECT paper_number, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM
  (SELECT paper_number, regexp_extract_all(strip_accents(lower(text)), '[{_MARK}]|[^\s{_MARK}]+') AS w FROM corpus)),
split AS (WITH RECURSIVE walk AS (SELECT DISTINCT word, 1 AS start, 0 AS n, 0::BIGINT AS id FROM chunks UNION ALL
    SELECT word, start + size, n + 1, id FROM (SELECT k.word, k.start, k.n, length(replace(p.term, '##', '')) AS size, p.id,
      row_number() OVER (PARTITION BY k.word, k.start ORDER BY length(replace(p.term, '##', '')) DESC) AS best
      FROM walk k JOIN pieces p ON starts_with(CASE WHEN k.start > 1 THEN '##' ELSE '' END || substr(k.word, k.start), p.term)
      WHERE k.start <= length(k.word) AND length(k.word) <= 200 AND (k.start = 1 OR length(p.term) > 2)) WHERE best = 1)
  SELECT * FROM walk),
whole AS (SELECT word, max(start) > length(word) AS found FROM split GROUP BY word),
ids AS (SELECT w.word, CASE WHEN found THEN list(id ORDER BY n) FILTER (n > 0) ELSE [1] END AS ids FROM whole w JOIN split USING (word) GROUP BY w.word, found),
placed AS (SELECT paper_number, flatten(list(ids ORDER BY pos)) AS ids FROM chunks JOIN ids USING (word) GROUP BY paper_number),
every AS (SELECT paper_number, coalesce(ids, []) AS ids FROM corpus LEFT JOIN placed USING (paper_number))
SELECT paper_number, array_to_string(list_concat(list_concat([2], list_concat(ids, [3])), list_transform(range(898 - len(ids)), lambda i: 0)), ' ') AS ids
FROM every WHERE len(ids) <= 898""",
)
def encode_word_pieces(spark, sf_dir):
    vocab = _piece_vocabulary(spark, sf_dir)
    pieces = encode.word_piece_tokens(inputs.corpus(spark, sf_dir), "text", vocab).drop("text")
    ids = encode.encode_token_ids(encode.with_markers(pieces, max_len=900), vocab, "paper_number", max_len=900)
    return ids.select("paper_number", F.array_join("ids", " ").alias("ids"))


def _pair_sql(by: str) -> str:
    """Pairs of neighbours that come together far more often than by chance, and single words less those pairs."""
    group = f"{by}, " if by else ""
    same = lambda a, b: f"{a}.{by} = {b}.{by} AND " if by else ""
    l = lambda k, n, x: f"(ln(greatest({x}, 1e-10)) * ({k}) + ln(greatest(1 - {x}, 1e-10)) * (({n}) - ({k})))"  # noqa: E731, E741
    return f"""singles AS (SELECT {group}term, count(*) AS c FROM seen_terms WHERE term NOT IN ({sql.STOP}) GROUP BY ALL),
total AS (SELECT {group}sum(c) AS n FROM singles {'GROUP BY ' + by if by else ''}),
pairs AS (SELECT {group}a.term AS first, b.term AS second, count(*) AS c FROM seen_terms a JOIN (SELECT paper_number, pos, term FROM seen_terms) b
  ON a.paper_number = b.paper_number AND b.pos = a.pos + 1 WHERE a.term NOT IN ({sql.STOP}) AND b.term NOT IN ({sql.STOP}) GROUP BY ALL),
rated AS (SELECT {'p.' + by + ', ' if by else ''}first, second, p.c AS c12, x.c AS c1, y.c AS c2, t.n AS n, y.c / t.n AS p, p.c / x.c AS p1, (y.c - p.c) / (t.n - x.c) AS p2
  FROM pairs p JOIN singles x ON {same('p', 'x')}p.first = x.term JOIN singles y ON {same('p', 'y')}p.second = y.term JOIN total t ON {same('p', 't')}true
  WHERE t.n > x.c AND t.n > y.c),
kept_pairs AS (SELECT * FROM rated WHERE 2 * ({l('c12', 'c1', 'p1')} + {l('c2 - c12', 'n - c1', 'p2')} - {l('c12', 'c1', 'p')} - {l('c2 - c12', 'n - c1', 'p')}) > 30),
less AS (SELECT {group}term, sum(c) AS c FROM (SELECT {group}first AS term, c12 AS c FROM kept_pairs UNION ALL SELECT {group}second, c12 FROM kept_pairs) GROUP BY ALL),
cloud AS (SELECT {'s.' + by + ', ' if by else ''}s.term, s.c - coalesce(l.c, 0) AS n FROM singles s LEFT JOIN less l ON {same('s', 'l')}s.term = l.term
  UNION ALL SELECT {group}first || ' ' || second, c12 FROM kept_pairs)"""


@query(
    "word_pair_frequencies",
    sql.with_(sql.CORPUS, sql.LISTS, sql.TOKENS, "seen_terms AS (SELECT * FROM tokens)", _pair_sql(""))
    + "SELECT term, cast(n AS BIGINT) AS n, round(n / max(n) OVER (), 6) AS frequency FROM (SELECT * FROM cloud WHERE n > 0 ORDER BY n DESC, term LIMIT 200)",
)
def word_pair_frequencies(spark, sf_dir):
    cloud = text.word_frequencies(inputs.tokens(spark, sf_dir), top=200, pairs=True)
    return cloud.withColumn("frequency", F.round("frequency", 6))


@query(
    "cluster_pair_frequencies",
    sql.with_(
        sql.CORPUS, sql.LISTS, sql.TOKENS,
        "seen_terms AS (SELECT paper_number, pos, term, lang AS cluster FROM tokens JOIN documents ON doc_id = paper_number WHERE pos <= 3000)", _pair_sql("cluster"),
    )
    + "SELECT cluster, term, cast(n AS BIGINT) AS n, round(n / max(n) OVER (PARTITION BY cluster), 6) AS frequency FROM "
    "(SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, term) AS rank FROM cloud WHERE n > 0) WHERE rank <= 200",
)
def cluster_pair_frequencies(spark, sf_dir):
    tokens = text.cluster_tokens(inputs.clusters(spark, sf_dir), inputs.tokens(spark, sf_dir), "paper_number")
    cloud = text.group_word_frequencies(tokens, "cluster", top=200, pairs=True)
    return cloud.select("cluster", "term", "n", F.round("frequency", 6).alias("frequency"))
