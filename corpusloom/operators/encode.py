"""Fixed-length token inputs: ids, mask and segment columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.encoding import token_id_udf, word_piece_udf
from corpusloom.operators.storage import in_small_batches, settle
from corpusloom.operators.text import salt_of, within_token_budget

LOOKUP_TERMS = 500_000
CLS, SEP, UNK = "[CLS]", "[SEP]", "[UNK]"


def word_piece_tokens(df: DataFrame, text: str, vocab: DataFrame, out: str = "tokens") -> DataFrame:
    """Sub-word tokens of a text. The vocabulary belongs to a model; it is sent to every executor once."""
    terms = sorted(r.term for r in vocab.select("term").distinct().collect())
    split = word_piece_udf(df.sparkSession.sparkContext.broadcast(terms))
    return in_small_batches(df).withColumn(out, split(F.filter(F.split(text, r"\s+"), lambda c: c != "")))


def with_markers(df: DataFrame, col: str = "tokens", max_len: int = 900) -> DataFrame:
    """[CLS] tokens [SEP] of the documents that fit."""
    fitting = within_token_budget(df, col, max_len)
    return fitting.withColumn(col, F.concat(F.array(F.lit(CLS)), F.col(col), F.array(F.lit(SEP))))


def _padded(values: Column, max_len: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(0), F.lit(max_len) - F.size(values)))


def _fits(col: str, max_len: int) -> Column:
    too_long = F.raise_error(F.lit("more tokens than the input length"))
    return F.when(F.size(col) > max_len, too_long.cast("array<string>")).otherwise(F.col(col))


def encode_masks(df: DataFrame, col: str = "tokens", max_len: int = 900, out: str = "mask") -> DataFrame:
    """1 per token, 0 per padding place; more tokens than places is an error."""
    return df.withColumn(out, _padded(F.transform(_fits(col, max_len), lambda t: F.lit(1)), max_len))


def encode_segments(df: DataFrame, col: str = "tokens", max_len: int = 900, out: str = "segments") -> DataFrame:
    """0 up to and including the first [SEP], 1 after it, 0 as padding."""
    first = F.array_position(col, SEP)
    second = F.transform(_fits(col, max_len), lambda t, i: F.when((first > 0) & (i >= first), 1).otherwise(0))
    return df.withColumn(out, _padded(second, max_len))


def encode_token_ids(
    df: DataFrame, vocab: DataFrame, id_col: str, col: str = "tokens", max_len: int = 900, unknown: int = 1,
    out: str = "ids", salts: int = 64, lookup_terms: int = LOOKUP_TERMS,
) -> DataFrame:
    """Vocabulary id of every token, zero-padded to max_len; null for a null token array. A term listed more than once
    has its lowest id.

    A vocabulary of ordinary size is looked up inside each Arrow batch, without a shuffle. A larger one is joined
    with salted terms, so that a frequent term does not end up in one task. Both give the same rows.
    """
    unique = vocab.groupBy("term").agg(F.min("id").alias("id"))
    entries = unique.limit(lookup_terms + 1).collect()
    if len(entries) <= lookup_terms:
        table = [r.term for r in entries], [r.id for r in entries]
        lookup = token_id_udf(df.sparkSession.sparkContext.broadcast(table), unknown)
        return df.withColumn(out, _padded(lookup(col), max_len))
    others = [c for c in df.columns if c not in (col, out)]
    rows = settle(df.withColumns({"_row": F.monotonically_increasing_id(), "_null": F.col(col).isNull()}))  # numbered once
    tokens = rows.select(*others, "_row", "_null", F.posexplode_outer(col).alias("_pos", "term"))
    tokens = tokens.withColumn("_salt", salt_of("_row", salts))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    terms = unique.select("term", F.col("id").alias("_id"), every_salt.alias("_salt"))
    found = tokens.join(terms, ["term", "_salt"], "left")
    cell = F.when(F.col("_pos").isNotNull(), F.struct("_pos", "term", F.coalesce("_id", F.lit(unknown)).cast("int").alias("id")))
    ordered = F.array_sort(F.collect_list(cell))  # at most max_len tokens per document
    whole = found.groupBy("_row").agg(F.first(F.struct(*others, "_null")).alias("_of"), ordered.alias("_cells"))
    present = ~F.col("_of._null")
    back = whole.select("_of.*", F.when(present, F.col("_cells.term")).alias(col), F.when(present, _padded(F.col("_cells.id"), max_len)).alias(out))
    return back.select(*df.columns, *([] if out in df.columns else [out]))


def encode_tokens(df: DataFrame, vocab: DataFrame, id_col: str, col: str = "tokens", max_len: int = 900) -> DataFrame:
    """ids, mask and segments of every document that fits."""
    marked = with_markers(df.select(id_col, col), col, max_len)
    masked = encode_segments(encode_masks(marked, col, max_len), col, max_len)
    return encode_token_ids(masked, vocab, id_col, col, max_len).drop(col)
