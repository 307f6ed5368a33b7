"""Token columns and word statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.stemming import stem_array
from corpusloom.functions.words import (
    EXTRA_STOP_WORDS,
    STOP_WORDS,
    count_words,
    drop_words,
    keep_long,
    split_without_punctuation,
    token_array,
)
from corpusloom.operators.ranking import of_group, same_group, top_n_per_group
from corpusloom.operators.storage import in_small_batches, save_artifact, scratch_path, settle

LITERAL_WORDS = 5_000


def explode_terms(df: DataFrame, col: str = "tokens", keep: list[str] | None = None) -> DataFrame:
    """One row per token, in column `term`.

    From a plain explode the optimiser infers size(tokens) > 0, pushes that below the projection and so computes the
    tokens twice. The outer form infers nothing; the null row of an empty document is dropped afterwards.
    """
    return df.select(*(keep or []), F.explode_outer(col).alias("term")).where(F.col("term").isNotNull())


def explode_places(df: DataFrame, col: str, keep: list[str]) -> DataFrame:
    """One row per token with its place `_pos`; see explode_terms."""
    return df.select(*keep, F.posexplode_outer(col).alias("_pos", "term")).where(F.col("term").isNotNull())


def keep_arrays(df: DataFrame, col: str, test) -> DataFrame:
    """Rows whose array passes a test, as a generator: a plain filter would be pushed below the projection and compute
    the array twice."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.explode(F.filter(F.array(col), test)).alias(col))


def tokenize(df: DataFrame, col: str, out: str = "tokens", min_len: int = 2, max_len: int = 15) -> DataFrame:
    return df.withColumn(out, token_array(F.col(col), min_len, max_len))


def remove_stopwords(df: DataFrame, col: str = "tokens", words: list[str] | None = None) -> DataFrame:
    return df.withColumn(col, drop_words(F.col(col), STOP_WORDS + EXTRA_STOP_WORDS if words is None else words))


def stem_tokens(df: DataFrame, col: str = "tokens") -> DataFrame:
    return in_small_batches(df).withColumn(col, stem_array(F.col(col)))


def clean_tokens(df: DataFrame, col: str, out: str = "tokens", words: list[str] | None = None) -> DataFrame:
    """Tokenise, drop stop words, stem."""
    return stem_tokens(remove_stopwords(tokenize(df, col, out), out, words), out)


def remove_punctuation(df: DataFrame, col: str, out: str = "tokens") -> DataFrame:
    return df.withColumn(out, split_without_punctuation(F.col(col)))


def join_tokens(df: DataFrame, col: str = "tokens", out: str = "document") -> DataFrame:
    return df.withColumn(out, F.array_join(col, " "))


def vectoriser_tokens(df: DataFrame, col: str = "tokens", words: list[str] | None = None) -> DataFrame:
    """What a vectoriser sees of cleaned tokens: at least two characters and not on its own stop list."""
    return df.withColumn(col, drop_words(keep_long(F.col(col)), STOP_WORDS if words is None else words))


def token_head(df: DataFrame, col: str = "tokens", n: int = 3000) -> DataFrame:
    return df.withColumn(col, F.slice(col, 1, n))


def within_token_budget(df: DataFrame, col: str = "tokens", max_len: int = 900, markers: int = 2) -> DataFrame:
    """Documents whose tokens plus the markers fit into a fixed-length input."""
    return keep_arrays(df, col, lambda t: F.size(t) + markers <= max_len)


def word_count(df: DataFrame, col: str, out: str = "n_words") -> DataFrame:
    return df.withColumn(out, count_words(F.col(col)))


def word_histogram(df: DataFrame, col: str) -> DataFrame:
    """Histogram of words per document with automatic bins: the narrower of the Freedman-Diaconis and Sturges widths.

    Documents are reduced to (word count, documents) in one pass; quartiles and bins work on that small table.
    """
    sizes = settle(word_count(df, col).groupBy("n_words").agg(F.count("*").alias("docs")))
    stats = sizes.agg(
        F.sum("docs").alias("n"),
        F.min("n_words").alias("lo"),
        F.max("n_words").alias("hi"),
        F.percentile("n_words", F.lit(0.25), F.col("docs")).alias("q1"),
        F.percentile("n_words", F.lit(0.75), F.col("docs")).alias("q3"),
    )
    span = F.col("hi") - F.col("lo")
    sturges = span / (F.log2(F.col("n").cast("double")) + 1)
    by_quartiles = 2 * (F.col("q3") - F.col("q1")) / F.pow(F.col("n").cast("double"), F.lit(1.0 / 3.0))
    width = F.when(by_quartiles > 0, F.least(by_quartiles, sturges)).otherwise(sturges)
    bins = F.when(span == 0, 1).otherwise(F.ceil(span / width)).cast("int")
    grid = stats.select("lo", "hi", bins.alias("bins"), F.explode(F.sequence(F.lit(0), bins - 1)).alias("bin"))
    step = (F.col("hi") - F.col("lo")) / F.col("bins")
    edges = grid.select(
        "bin",
        (F.col("lo") + F.col("bin") * step).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * step).alias("bin_end"),
    )
    plan = stats.select(F.struct("lo", span.alias("span"), bins.alias("bins")).alias("plan")).scalar()
    placed = sizes.withColumn("plan", plan)
    offset = F.floor((F.col("n_words") - F.col("plan.lo")) * F.col("plan.bins") / F.col("plan.span"))
    slot = F.when(F.col("plan.span") == 0, 0).otherwise(F.least(offset, F.col("plan.bins") - 1)).cast("int")
    filled = placed.groupBy(slot.alias("bin")).agg(F.sum("docs").alias("docs"))
    return edges.join(filled, "bin", "left").fillna(0, ["docs"])


def term_counts(df: DataFrame, col: str = "tokens", by: list[str] | None = None) -> DataFrame:
    """Occurrences of every term; each map task sends one partial count per term."""
    by = by or []
    return explode_terms(df, col, by).groupBy(*by, "term").agg(F.count("*").alias("n"))


def top_terms(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), "term").limit(n)


PAIR_SCORE = 30  # how far the likelihood ratio of a pair of words has to exceed chance


def _log_share(k: Column, n: Column, share: Column) -> Column:
    """Log likelihood of k successes out of n."""
    least = F.lit(1e-10)
    return F.ln(F.greatest(share, least)) * k + F.ln(F.greatest(1 - share, least)) * (n - k)


def pair_counts(df: DataFrame, col: str, stop: list[str], singles: DataFrame, by: list[str], least: float = PAIR_SCORE) -> DataFrame:
    """(by, first, second, n) of neighbours in a document, neither on the stop list, that come together far more often than
    their single counts let expect (likelihood ratio test of Dunning, 1993)."""
    longer = keep_arrays(df.select(*by, col), col, lambda t: F.size(t) > 1)
    # a stop word is looked up once, not in both of its pairs
    free = longer.select(*by, F.transform(col, lambda w: F.when(~w.isin(stop), w)).alias("_free"))
    follow = F.arrays_zip(F.slice("_free", 1, F.size("_free") - 1).alias("first"), F.slice("_free", 2, F.size("_free")).alias("second"))
    each = free.select(*by, F.explode_outer(follow).alias("p")).where(F.col("p.first").isNotNull() & F.col("p.second").isNotNull())
    counted = each.groupBy(*by, F.col("p.first").alias("first"), F.col("p.second").alias("second")).agg(F.count("*").alias("n"))
    totals = of_group(singles.groupBy(*by).agg(F.sum("n").alias("_all")), by)
    one, two = (of_group(singles.select(*by, F.col("term").alias(f"_{k}"), F.col("n").alias(f"_n{k}")), by) for k in (1, 2))
    known = counted.join(one, same_group(counted, one, by) & (F.col("first") == F.col("_1"))).select(*[counted[c] for c in counted.columns], "_n1")
    known = known.join(two, same_group(known, two, by) & (F.col("second") == F.col("_2"))).select(*[known[c] for c in known.columns], "_n2")
    known = known.join(totals if by else F.broadcast(totals), same_group(known, totals, by)).select(*[known[c] for c in known.columns], "_all")
    both, first, second, every = (F.col(c) for c in ("n", "_n1", "_n2", "_all"))
    alone, with_, without = second / every, both / first, (second - both) / (every - first)
    score = _log_share(both, first, with_) + _log_share(second - both, every - first, without)
    score = score - _log_share(both, first, alone) - _log_share(second - both, every - first, alone)
    return known.where((every > first) & (every > second)).where(2 * score > least).select(*by, "first", "second", "n")


def _cloud_counts(df: DataFrame, col: str, words: list[str] | None, by: list[str], pairs: bool) -> DataFrame:
    """(by, term, n) outside the stop list; with `pairs`, accepted pairs are terms too and their words count that much less."""
    stop = list(STOP_WORDS if words is None else words)
    singles = explode_terms(df, col, by).where(~F.col("term").isin(stop)).groupBy(*by, "term").agg(F.count("*").alias("n"))
    if not pairs:
        return singles
    # read four times below; as a file it has a size, by which Spark joins the pairs with a small vocabulary where they are
    singles = save_artifact(singles, scratch_path(df.sparkSession, "word-counts"))
    found = settle(pair_counts(df, col, stop, singles, by))
    taken = found.select(*by, F.explode(F.array("first", "second")).alias("term"), (-F.col("n")).alias("n"))
    joined = found.select(*by, F.concat_ws(" ", "first", "second").alias("term"), "n")
    return singles.unionByName(taken).unionByName(joined).groupBy(*by, "term").agg(F.sum("n").alias("n")).where("n > 0")


def word_frequencies(
    df: DataFrame, col: str = "tokens", words: list[str] | None = None, top: int = 200, pairs: bool = False
) -> DataFrame:
    """Word-cloud table: the most frequent terms outside the stop list, scaled by the largest count."""
    ranked = top_terms(_cloud_counts(df, col, words, [], pairs), top)
    largest = F.max("n").over(Window.partitionBy())  # at most `top` rows are left here
    return ranked.withColumn("frequency", F.col("n") / largest)


def group_word_frequencies(
    df: DataFrame, by: str, col: str = "tokens", words: list[str] | None = None, top: int = 200, pairs: bool = False
) -> DataFrame:
    """Word-cloud table per group."""
    ranked = top_n_per_group(_cloud_counts(df, col, words, [by], pairs), [by], [F.desc("n"), F.col("term")], top)
    largest = F.max("n").over(Window.partitionBy(by))
    return ranked.withColumn("frequency", F.col("n") / largest)


def bounded_terms(vocabulary: DataFrame, limit: int = LITERAL_WORDS) -> list[str] | None:
    """The distinct terms if there are at most `limit` of them, else None."""
    rows = vocabulary.select("term").distinct().limit(limit + 1).collect()
    return [r.term for r in rows] if len(rows) <= limit else None


def vocab_filter(
    df: DataFrame, vocabulary: DataFrame, id_col: str, col: str = "tokens", salts: int = 64, literals: int = LITERAL_WORDS
) -> DataFrame:
    """Tokens that are in the vocabulary, in order; documents left empty disappear. Rows that share an id stay apart.

    A small vocabulary becomes a literal hash set and nothing is shuffled. A large one is joined with the terms
    salted, so that a very frequent term is spread over `salts` tasks. Both give the same rows.
    """
    words = bounded_terms(vocabulary, literals)
    if words is not None:
        kept = df.select(id_col, F.filter(col, lambda w: w.isin(words)).alias(col))
        return keep_arrays(kept, col, lambda t: F.size(t) > 0)
    rows = settle(df.select(id_col, col, F.monotonically_increasing_id().alias("_row")))  # numbered once, whatever is lost later
    tokens = explode_places(rows, col, [id_col, "_row"]).withColumn("_salt", salt_of("_row", salts))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    terms = vocabulary.select("term").distinct().withColumn("_salt", every_salt)
    kept = tokens.join(terms, ["term", "_salt"], "left_semi")
    ordered = F.array_sort(F.collect_list(F.struct("_pos", "term")))
    return kept.groupBy("_row", id_col).agg(ordered["term"].alias(col)).drop("_row")


def salt_of(id_col: str, salts: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int")


def semi_join_vocab(df: DataFrame, vocabulary: DataFrame, id_col: str, col: str = "tokens") -> DataFrame:
    """The (document, term) occurrences whose term is in the vocabulary."""
    kept = vocab_filter(df, vocabulary, id_col, col)
    return explode_terms(kept, col, [id_col])


def cluster_tokens(clusters: DataFrame, df: DataFrame, id_col: str, col: str = "tokens", n: int = 3000) -> DataFrame:
    """Cluster id next to the first n tokens of each document."""
    return token_head(df.select(id_col, col), col, n).join(clusters.select(id_col, "cluster"), id_col)


def cluster_count(clusters: DataFrame) -> DataFrame:
    return clusters.agg(F.countDistinct("cluster").alias("clusters"))
