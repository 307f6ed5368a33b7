"""Global order without a single-task window: dense ranks, running totals and exact samples.

Two techniques are used throughout.
* Rank by any key: range-partition, number the rows of each partition, add the sizes of the partitions before it.
* Rank by a hash: the leading hex digits are uniform buckets, so bucket counts give the offsets and no range
  sampling is needed.
Only the table of partition or bucket sizes is ever ordered as a whole, and its length is fixed by configuration.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.storage import settle

_SLOT_BITS = 33  # monotonically_increasing_id keeps the partition above bit 33 and the row number below
_BUCKET_DIGITS = 3
BUCKETS = 16**_BUCKET_DIGITS
ABOVE_ALL = "g"  # behind every hexadecimal digit


def hash_order(seed, id_col: Column) -> Column:
    """A reproducible pseudo-random sort key that any SQL engine can recompute."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat(seed.cast("string"), F.lit(":"), id_col.cast("string")))


def _ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    slot = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", slot)
    return settle(placed).withColumn("_part", F.shiftright("_slot", _SLOT_BITS))


def _preceding(sizes: DataFrame, key: str, totals: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """Per key, the sum of each total over all smaller keys. One row per partition or bucket, so the window is small."""
    before = Window.partitionBy(*(by or [])).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(out) for c, out in totals.items()]
    return sizes.select(*(by or []), key, *cols)


def with_dense_index(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Consecutive 0-based position of every row in the global order; the order must be total."""
    rows = _ranged(df, order)
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    base = _preceding(sizes, "_part", {"_n": "_base"})
    position = F.col("_base") + F.col("_slot").bitwiseAND((1 << _SLOT_BITS) - 1)
    return rows.join(F.broadcast(base), "_part").select(*df.columns, position.cast("bigint").alias(out))


def of_group(df: DataFrame, by: list[str]) -> DataFrame:
    """Group columns out of the way of those they will be compared with."""
    return df.withColumnsRenamed({c: f"_of_{c}" for c in by})


def same_group(left: DataFrame, right: DataFrame, by: list[str]) -> Column:
    """Null-safe equality of the groups of `left` and of_group(`right`)."""
    return functools.reduce(operator.and_, [left[c].eqNullSafe(right[f"_of_{c}"]) for c in by], F.lit(True))


def with_running_totals(df: DataFrame, order: list[Column], totals: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """Inclusive running sum of each column in `totals` (input name -> output name) along a global order, or along the order
    within every group of `by`. A group may span any number of range partitions; each adds what its group has before it.
    """
    by = by or []
    rows = _ranged(df, [*(F.col(c) for c in by), *order])
    sizes = rows.groupBy("_part", *by).agg(*[F.sum(c).alias(c) for c in totals])
    base = _preceding(sizes, "_part", {c: f"_base_{c}" for c in totals}, by)
    local = Window.partitionBy("_part", *by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    sums = [(F.col(f"_base_{c}") + F.sum(c).over(local)).cast("bigint").alias(out) for c, out in totals.items()]
    # without groups the table has a row per partition; with groups one more for each, so Spark picks the join
    base = of_group(base, ["_part", *by])
    joined = rows.join(base if by else F.broadcast(base), same_group(rows, base, ["_part", *by]))
    return joined.select(*[rows[c] for c in df.columns], *sums)


def nth_values(df: DataFrame, by: list[str], value: str, nth: Column, out: str) -> DataFrame:
    """Per group the value at 0-based place `nth` of the ascending order; `nth` may use the group's row count `n`.

    Equal values are one row with a count, and a group is ranged over as many partitions as it needs, so no task holds
    all values of a group. Null values are left out; a group without others has no row.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    summed = with_running_totals(counted, [F.col(value)], {"_n": "_upto"}, by)
    sizes = of_group(summed.groupBy(*by).agg(F.sum("_n").alias("n")).select(*by, nth.alias("_nth")), by)
    placed = summed.join(sizes, same_group(summed, sizes, by)).where((F.col("_upto") > F.col("_nth")) & (F.col("_upto") - F.col("_n") <= F.col("_nth")))
    return placed.select(*[summed[c] for c in by], F.col(value).alias(out))


def with_hash_rank(df: DataFrame, seed, id_col: str, out: str, by: list[str] | None = None) -> DataFrame:
    """0-based rank in hash order, overall or per group of `by`.

    The broadcast table has at most BUCKETS rows per group; use it for a handful of groups such as class labels.
    """
    by = by or []
    keyed = df.withColumn("_h", hash_order(seed, F.col(id_col)))
    keyed = keyed.withColumn("_bucket", F.substring("_h", 1, _BUCKET_DIGITS))
    sizes = keyed.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    base = _preceding(sizes, "_bucket", {"_n": "_base"}, by)
    local = Window.partitionBy(*by, "_bucket").orderBy("_h", id_col)
    rank = F.col("_base") + F.row_number().over(local) - 1
    return keyed.join(F.broadcast(base), [*by, "_bucket"]).select(*df.columns, rank.cast("bigint").alias(out))


def sample_n(df: DataFrame, n: int, seed, id_col: str) -> DataFrame:
    """Exactly n rows (all, if fewer) in hash order, without replacement.

    Bucket sizes, at most BUCKETS numbers, tell which buckets belong to the sample as a whole. Only the bucket that
    straddles the end is sorted, so neither a small nor a very large sample passes through one task.
    """
    keyed = df.withColumn("_h", hash_order(seed, F.col(id_col)))
    keyed = keyed.withColumn("_bucket", F.substring("_h", 1, _BUCKET_DIGITS))
    before = 0
    for bucket, size in sorted(keyed.groupBy("_bucket").count().collect()):
        if before + size >= n:
            edge = keyed.where(F.col("_bucket") == bucket).orderBy("_h", id_col).limit(n - before)
            return keyed.where(F.col("_bucket") < bucket).unionByName(edge).select(*df.columns)
        before += size
    return df


def cell_cuts(copies: DataFrame, cell: list[str], hashed: str, wanted: dict[tuple, int], rows_per_cell: int) -> dict[tuple, str]:
    """Per cell the hash of its row number `wanted` in hash order, so that a row belongs to the sample if its own is no larger.

    `copies` has a row per cell and row of the cell; only counts per cell and bucket of leading digits are shuffled, and the
    rows of the one bucket in which the cut lies. A cell with fewer rows gets a cut that no hash exceeds, one that
    wants none gets one below all. The number of cells is a parameter; `rows_per_cell` only sets how fine the buckets are.
    """
    spark = copies.sparkSession
    digits = max(1, min(4, math.ceil(math.log(max(rows_per_cell, 1) / 1_000, 16))))
    keyed = copies.select(*cell, F.col(hashed).alias("_h"), F.substring(hashed, 1, digits).alias("_bucket"))
    schema = T.StructType([*(copies.schema[c] for c in cell), T.StructField("_wanted", T.LongType())])
    asked = spark.createDataFrame([(*c, n) for c, n in wanted.items() if n > 0], schema)
    sizes = keyed.groupBy(*cell, "_bucket").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(*cell).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    total = sizes.join(F.broadcast(asked), cell).withColumn("_upto", F.sum("_n").over(upto))
    at = total.where((F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_n") < F.col("_wanted")))
    at = settle(at.select(*cell, "_bucket", (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_left")))
    nth = F.row_number().over(Window.partitionBy(*cell).orderBy("_h"))
    edge = keyed.join(F.broadcast(at), [*cell, "_bucket"]).withColumn("_rn", nth).where(F.col("_rn") == F.col("_left"))
    found = {tuple(r[c] for c in cell): r["_h"] for r in edge.collect()}
    return {c: "" if n <= 0 else found.get(c, ABOVE_ALL) for c, n in wanted.items()}


def top_n_per_group(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each group with their 1-based rank.

    `rank <= n` on a window lets Spark cut every group to n rows before the shuffle, as long as n stays below
    spark.sql.optimizer.windowGroupLimitThreshold. Beyond that a salted round does the same cut.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(BUCKETS)))
        local = Window.partitionBy(*by, "_salt").orderBy(*order)
        df = salted.withColumn("_rn", F.row_number().over(local)).where(F.col("_rn") <= n).drop("_rn", "_salt")
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= n)
