"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

An item is cut into windows of ten consecutive words (a shorter item is one window). A window is a set of shingles, each
with its place. A document contains a window if it has all of its shingles at matching places, so of the shingles in
order of rarity a prefix of one is necessary: the one that the fewest windows have, of equally rare ones the longest. The
join goes over that prefix alone, keeps candidates whose place and length leave room for the whole window, and verifies
them on the document's own words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.storage import settle

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same before lower-casing
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE_WORDS = 3
BROADCAST_BYTES = 64 << 20  # what is larger is joined by a shuffle with salted keys
SALTS = 16


def words_of(text: Column) -> Column:
    """Words of a lower-cased text; none for a null text."""
    found = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _runs(words: Column, length: int) -> Column:
    """(place, text) of all runs of so many consecutive words; places count from 0."""
    last = F.size(words) - length + 1
    run = lambda i: F.struct((i - 1).alias("place"), F.array_join(F.slice(words, i, length), " ").alias("shingle"))
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), run))


def item_windows(items: DataFrame, size: int, text: str, id_col: str) -> DataFrame:
    """(item, window, words): the distinct windows of each item. The window is its words as one string."""
    worded = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text)).alias("w")).where(F.size("w") > 0)
    whole = F.array(F.struct(F.lit(0).alias("place"), F.array_join("w", " ").alias("shingle")))
    cut = worded.select("item", F.explode_outer(F.coalesce(_runs(F.col("w"), size), whole)["shingle"]).alias("window"))
    return cut.distinct().withColumn("words", F.split("window", " "))


def window_shingles(windows: DataFrame) -> DataFrame:
    """(window, n_words, n_shingles, place, shingle) of each distinct window."""
    distinct = windows.select("window", "words").distinct()
    whole = F.array(F.struct(F.lit(0).alias("place"), F.col("window").alias("shingle")))
    parts = F.coalesce(_runs(F.col("words"), SHINGLE_WORDS), whole)
    cut = distinct.select("window", F.size("words").alias("n_words"), F.size(parts).alias("n_shingles"), F.explode_outer(parts).alias("s"))
    return cut.select("window", "n_words", "n_shingles", "s.place", "s.shingle")


def _fits(df: DataFrame, text: Column, most: int) -> bool:
    """Whether a table is small enough to be broadcast, by the bytes of its texts and 64 for each row."""
    return (df.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64)).first()[0] or 0) <= most


def prefixes(parts: DataFrame) -> DataFrame:
    """(shingle, window, n_words, place): of each window the shingle that stands in the fewest windows."""
    rarity = parts.groupBy("shingle").agg(F.countDistinct("window").alias("n"))
    order = F.struct("n", (-F.octet_length("shingle")).alias("size"), "place", "shingle")
    first = parts.join(rarity, "shingle").groupBy("window", "n_words").agg(F.min(order).alias("first"))
    return first.select("first.shingle", "window", "n_words", "first.place")


def _join_shingles(left: DataFrame, right: DataFrame, broadcast: bool) -> DataFrame:
    """Inner join on the shingle, where a shingle may hold a third of the rows of `left`."""
    if broadcast:
        return left.join(F.broadcast(right), "shingle")
    salted = left.withColumn("salt", F.pmod(F.xxhash64("id", "digest", "at"), F.lit(SALTS)))
    every = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return salted.join(every, ["shingle", "salt"]).drop("salt")


def contained_items(
    docs: DataFrame, items: DataFrame, size: int = 10, text: str = "text", id_col: str = "doc_id", item_text: str = "text",
    item_id: str = "item_id", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds n_words, n_hit (words inside any occurrence of a window) and items (sorted ids, as strings) to every row.

    Null and empty texts have no words and no hits; an item without words has no window. Items that share an id count
    once; an item without an id hits words, but is not listed. Repeated rows each get their result, further columns stay
    and those named like a new one are replaced. With no documents or no items there are no hits.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "n_hit", "items")]
    names = [f"c{i}" for i in range(len(kept))]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)])
    own_id, own_text = (names[kept.index(c)] for c in (id_col, text))
    keyed = plain.select(F.col(own_id).alias("id"), F.xxhash64(own_text).alias("digest"), F.col(own_text).alias("text"))

    windows = settle(item_windows(items, size, item_text, item_id))
    parts = settle(window_shingles(windows))
    prefix = settle(prefixes(parts))
    lengths = sorted(r[0] for r in prefix.select(F.size(F.split("shingle", " ")).alias("n")).distinct().collect())

    # runs and size are columns before the explode, which then carries neither the words nor the text
    empty = F.array().cast("array<struct<place:int,shingle:string>>")
    worded = keyed.select("id", "digest", words_of(F.col("text")).alias("w"))
    runs = [F.coalesce(_runs(F.col("w"), n), empty) for n in lengths]  # at most SHINGLE_WORDS lengths occur
    placed = worded.select("id", "digest", F.size("w").alias("size"), F.concat(empty, *runs).alias("runs"))
    seen = placed.select("id", "digest", "size", F.explode_outer("runs").alias("s"))
    seen = seen.select("id", "digest", "size", F.col("s.place").alias("at"), "s.shingle").where("shingle is not null")
    begin = (F.col("at") - F.col("place")).alias("begin")
    met = _join_shingles(seen, prefix, _fits(prefix, F.concat("shingle", "window"), broadcast_bytes)).select("id", "digest", "size", begin, "window", "n_words")
    met = met.where((F.col("begin") >= 0) & (F.col("begin") + F.col("n_words") <= F.col("size")))
    # no more candidates than places of the document times windows of a shingle
    grouped = settle(met.groupBy("id", "digest").agg(F.collect_set(F.struct("begin", "n_words", "window")).alias("candidates")))

    room = F.array_join(F.col("candidates.window"), "")
    candidates = grouped.select(F.col("id").alias("c_id"), F.col("digest").alias("c_digest"), "candidates")
    texts = keyed.join(F.broadcast(candidates) if _fits(grouped, room, broadcast_bytes) else candidates, _same("c_"))
    found = F.filter("candidates", lambda c: F.array_join(F.slice("w", c["begin"] + 1, c["n_words"]), " ") == c["window"])
    # as a generator, so that the words are cut once and not inside the function over candidates
    verified = texts.select("id", "digest", "candidates", F.explode(F.array(words_of(F.col("text")))).alias("w")).select("id", "digest", found.alias("found"))
    spans = F.flatten(F.transform("found", lambda c: F.sequence(c["begin"], c["begin"] + c["n_words"] - 1)))
    hits = verified.select("id", "digest", F.size(F.array_distinct(spans)).cast("long").alias("hit"), F.array_distinct(F.col("found.window")).alias("windows"))
    hits = settle(hits.where("hit > 0").dropDuplicates(["id", "digest"]))

    named = windows.where("item is not null").select("window", "item")
    listed = hits.select("id", "digest", F.explode("windows").alias("window"))
    listed = listed.join(F.broadcast(named) if _fits(named, F.concat("window", "item"), broadcast_bytes) else named, "window")
    listed = listed.select("id", "digest", "item").distinct().groupBy("id", "digest").agg(F.sort_array(F.collect_list("item")).alias("listed"))
    listed = listed.select(F.col("id").alias("l_id"), F.col("digest").alias("l_digest"), "listed")
    got = hits.select("id", "digest", "hit").join(listed, _same("l_"), "left").select(F.col("id").alias("g_id"), F.col("digest").alias("g_digest"), "hit", "listed")

    both = plain.withColumns({"id": F.col(own_id), "digest": F.xxhash64(own_text), "n": F.coalesce(F.regexp_count(own_text, F.lit(ANY_WORD)), F.lit(0))})
    both = both.join(got, _same("g_"), "left")
    return both.select(
        *[F.col(n).alias(c) for c, n in zip(kept, names, strict=True)], F.col("n").cast("long").alias("n_words"),
        F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("listed", F.array().cast("array<string>")).alias("items"),
    )


def _same(prefix: str) -> Column:
    """Documents are the same if their ids and the hashes of their texts are."""
    return F.col("id").eqNullSafe(F.col(f"{prefix}id")) & (F.col("digest") == F.col(f"{prefix}digest"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
f AS (SELECT doc_id, i, dw.n AS n, item_id FROM dw JOIN bw USING (s) WHERE dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM f) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM f) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
