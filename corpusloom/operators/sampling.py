"""Reproducible samples, splits and set operations over label tables. All orders are hash orders, so any engine can
recompute a sample from the seed and the ids."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.many_svms import WORD_BITS
from corpusloom.operators.ranking import cell_cuts, hash_order, sample_n, top_n_per_group, with_hash_rank
from corpusloom.operators.storage import settle

ID = "paper_number"


def shuffle_subset(df: DataFrame, n: int = 10_000, seed="subset", id_col: str = ID) -> DataFrame:
    return sample_n(df, n, seed, id_col)


def except_labeled(corpus: DataFrame, labeled: DataFrame, id_col: str = ID) -> DataFrame:
    return corpus.join(labeled.select(id_col), id_col, "left_anti")


def holdout_sample(corpus: DataFrame, labeled: DataFrame, n: int = 200, seed="holdout", id_col: str = ID) -> DataFrame:
    """n random documents that nobody labelled yet."""
    return sample_n(except_labeled(corpus, labeled, id_col), n, seed, id_col)


def label_split(labels: DataFrame, sizes: dict[str, int], seed="split", id_col: str = ID) -> DataFrame:
    """Random disjoint parts of the given sizes, in this order; rows beyond the last part are left out."""
    ranked = with_hash_rank(settle(sample_n(labels, sum(sizes.values()), seed, id_col)), seed, id_col, "_rank")
    part, end = None, 0
    for name, size in sizes.items():
        end += size
        below = F.col("_rank") < end
        part = F.when(below, name) if part is None else part.when(below, name)
    return ranked.where(F.col("_rank") < end).withColumn("part", part).drop("_rank")


def balanced_dev_set(labels: DataFrame, per_class: int = 100, seed="dev", id_col: str = ID) -> DataFrame:
    """per_class random rows of every label (all of a smaller class)."""
    order = [hash_order(seed, F.col(id_col)), F.col(id_col)]
    return top_n_per_group(labels, ["label"], order, per_class, "_rank").drop("_rank")


@dataclass
class CurveCells:
    """The training sets of a learning curve as flags on the label rows, not as copies of rows.

    Cell size_idx * repeats + repeat is one training set. A row belongs to it if the hash of (seed, cell, row) does not
    exceed the cell's cut, so `dev` and `drawn` are expressions over one row.
    """

    rows: DataFrame
    steps: int
    repeats: int
    id_col: str
    seed: str
    dev_cuts: dict[int, list[str]]  # by label: of each repeat of size 0, then of each larger size
    drawn_cuts: list[str]  # of each repeat of each larger size

    @property
    def cells(self) -> int:
        return (self.steps + 1) * self.repeats

    def _own_dev(self) -> Column:
        """Per separate balanced set whether the row is in it."""
        cuts = F.array().cast("array<string>")
        for label, own in self.dev_cuts.items():
            cuts = F.when(F.col("label") == label, F.lit(own)).otherwise(cuts)  # none for a null label
        return F.transform(cuts, lambda cut, i: _dev_hash(self.seed, i, self.repeats, self.id_col) <= cut)

    def dev(self) -> Column:
        """Per cell whether the row is in its balanced set; larger sizes share theirs between the repeats."""
        larger = lambda own: F.transform(F.slice(own, self.repeats + 1, max(self.steps, 1)), lambda f: F.array_repeat(f, self.repeats))
        return _once(self._own_dev(), lambda own: F.concat(F.slice(own, 1, self.repeats), F.flatten(larger(own))))

    def drawn(self) -> Column:
        """Per cell whether the row is in its random sample of the rows outside the balanced set."""
        none = F.array_repeat(F.lit(False), self.repeats)
        if not self.steps:
            return none
        outside = lambda own, i: ~F.get(own, self.repeats + _floor(i / self.repeats))
        flag = lambda own, cut, i: outside(own, i) & (_drawn_hash(self.seed, i, self.repeats, self.id_col) <= cut)
        return F.concat(none, _once(self._own_dev(), lambda own: F.transform(F.lit(self.drawn_cuts), lambda cut, i: flag(own, cut, i))))

    def bits(self) -> Column:
        """One bit per cell, in words of WORD_BITS: whether the row is in the training set."""
        flags = F.zip_with(self.dev(), self.drawn(), lambda a, b: a | b)
        words = F.sequence(F.lit(0), F.lit((self.cells - 1) // WORD_BITS))
        low_first = lambda own, w: F.reverse(F.slice(own, w * WORD_BITS + 1, WORD_BITS))
        word = lambda own, w: F.aggregate(low_first(own, w), F.lit(0).cast("long"), lambda a, f: a * 2 + f.cast("long"))
        return _once(flags, lambda own: F.transform(words, lambda w: word(own, w)))

    def long(self, flags: Column, columns: list[str]) -> DataFrame:
        """A row per cell whose flag is set: this is where rows are copied."""
        marked = self.rows.withColumn("_flags", flags)
        cell = F.explode(F.filter(F.sequence(F.lit(0), F.lit(self.cells - 1)), lambda i: F.get("_flags", i)))
        out = marked.select(*self.rows.columns, cell.alias("_cell"))
        return out.withColumns({"size_idx": _floor(F.col("_cell") / self.repeats), "repeat": F.col("_cell") % self.repeats}).select(*columns)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once per row: an expression inside a lambda is computed for every element again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _floor(x: Column) -> Column:
    return F.floor(x).cast("int")


def _cell_hash(id_col: str, *parts) -> Column:
    named = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return hash_order(F.concat_ws(":", *(p.cast("string") for p in named)), F.col(id_col))


def _dev_hash(seed: str, i: Column, repeats: int, id_col: str) -> Column:
    first = i < repeats
    return _cell_hash(id_col, seed, "dev", F.when(first, 0).otherwise(i - repeats + 1), F.when(first, i).otherwise(0))


def _drawn_hash(seed: str, i: Column, repeats: int, id_col: str) -> Column:
    return _cell_hash(id_col, seed, _floor(i / repeats) + 1, i % repeats)


def curve_cells(labels: DataFrame, steps: int = 10, repeats: int = 40, per_class: int = 100, seed: str = "curve") -> CurveCells:
    """Balanced sets of per_class rows of each label, one per repeat at size 0 and one per larger size, and for k = 1..steps
    and every repeat floor(R / steps) * k random rows out of the R rows outside the balanced set. Fewer rows of a class are all taken."""
    sizes = {r.label: r["count"] for r in labels.where("label IS NOT NULL").groupBy("label").count().collect()}
    total = sum(sizes.values())
    cells = CurveCells(labels, steps, repeats, ID, seed, {}, [])
    sets = repeats + steps
    i = F.explode(F.sequence(F.lit(0), F.lit(sets - 1)))
    copies = labels.select(ID, "label", i.alias("i")).withColumn("h", _dev_hash(seed, F.col("i"), repeats, ID))
    cuts = cell_cuts(copies, ["i", "label"], "h", {(i, label): per_class for i in range(sets) for label in sizes}, total)
    cells.dev_cuts = {label: [cuts[i, label] for i in range(sets)] for label in sizes}
    if steps:
        rest = total - sum(min(per_class, n) for n in sizes.values())
        i = F.explode(F.sequence(F.lit(0), F.lit(steps * repeats - 1)))
        copies = labels.withColumn("_dev", cells._own_dev()).select(ID, "_dev", i.alias("i"))
        copies = copies.where(~F.get("_dev", F.lit(repeats) + _floor(F.col("i") / repeats))).withColumn("h", _drawn_hash(seed, F.col("i"), repeats, ID))
        wanted = {(i,): rest // steps * (i // repeats + 1) for i in range(steps * repeats)}
        found = cell_cuts(copies, ["i"], "h", wanted, total)
        cells.drawn_cuts = [found[i,] for i in range(steps * repeats)]
    return cells


def curve_dev_sets(labels: DataFrame, steps: int, repeats: int, per_class: int, seed: str = "curve") -> DataFrame:
    """Balanced sets of a learning curve: one per repeat at size 0, one shared by all repeats of a larger size."""
    cells = curve_cells(labels, steps, repeats, per_class, seed)
    rows = cells.long(cells.dev(), [*labels.columns, "size_idx", "repeat"])
    return rows.where((F.col("size_idx") == 0) | (F.col("repeat") == 0))


def incremental_samples(
    labels: DataFrame, steps: int = 10, repeats: int = 40, per_class: int = 100, seed: str = "curve"
) -> DataFrame:
    """For k = 1..steps and every repeat, floor(R / steps) * k random rows out of the R rows outside the dev set."""
    cells = curve_cells(labels, steps, repeats, per_class, seed)
    return cells.long(cells.drawn(), [*labels.columns, "size_idx", "repeat"])


def union_training(
    labels: DataFrame, steps: int = 10, repeats: int = 40, per_class: int = 100, seed: str = "curve"
) -> DataFrame:
    """Training rows of every learning-curve cell: the dev set of the cell plus its random sample."""
    cells = curve_cells(labels, steps, repeats, per_class, seed)
    flags = F.zip_with(cells.dev(), cells.drawn(), lambda a, b: a | b)
    return cells.long(flags, ["size_idx", "repeat", ID, "label"])
