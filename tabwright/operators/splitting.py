"""Train / validation / test splits as one table with a ``split`` column."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.columns import c, require
from tabwright.operators.classes import ClassTable, class_table
from tabwright.operators.ordering import TASK_ROWS, hash_cuts, mark_cuts, number_rows
from tabwright.operators.sampling import Key
from tabwright.sources.shared import settle, settle_with


def share_out(sizes: DataFrame, label: str, total: int, rows: int, classes: int) -> DataFrame:
    """Share ``total`` picks among the labels by size, adding up to exactly ``total``.

    Each label gets the whole part of its share; the picks that are left go to the
    largest remainders, the smaller label first among equals. ``sizes`` has one row per
    label; ``rows`` is the sum of the sizes and ``classes`` their number.
    """
    exact = f"cast(`count` as decimal(19,0)) * cast({total} as decimal(19,0))"
    shares = sizes.select(
        c(label),
        "count",
        F.expr(f"{exact} div {max(rows, 1)}L").alias("quota"),
        F.expr(f"cast(({exact}) % {max(rows, 1)}L as bigint)").alias("rest"),
    )
    order = [F.desc("rest"), c(label).asc_nulls_last()]
    if classes <= TASK_ROWS:
        # One row per label and few of them: a single task ranks the remainders.
        everything = W.partitionBy(F.lit(0))
        place = F.row_number().over(everything.orderBy(*order)) - 1
        left = F.lit(total) - F.sum("quota").over(everything)
        ranked = shares.withColumn("place", place).withColumn("left", left)
    else:
        shares = settle(shares)
        left = F.lit(total - (shares.agg(F.sum("quota")).first()[0] or 0))
        ranked = number_rows(shares, order, "place", rows=classes).withColumn("left", left)
    extra = (F.col("place") < F.col("left")).cast("bigint")
    return ranked.select(c(label), "count", (F.col("quota") + extra).alias("quota"))


def _both_shares(sizes: ClassTable, outer: int, inner: int) -> tuple[DataFrame, ClassTable]:
    """Rows of each class in the outer part (``quota``) and in the inner part of it (``inner``).

    Also the classes of the outer part. Both are shared out in one go and written.
    """
    label = sizes.label
    shares = share_out(sizes.table, label, outer, sizes.rows, sizes.classes).drop("count")
    held = shares.withColumnRenamed("quota", "count")
    if sizes.classes > TASK_ROWS:
        held = settle(held)
    both = share_out(held, label, inner, outer, sizes.classes)
    some = F.col("quota") > 0
    table, facts = settle_with(
        both.select(c(label), F.col("count").alias("quota"), F.col("quota").alias("inner")),
        classes=F.count_if(some),
        smallest=F.min(F.when(some, F.col("quota"))),
    )
    kept = table.where(some).select(c(label), F.col("quota").alias("count"))
    return table, ClassTable(label, kept, outer, facts["classes"] or 0, facts["smallest"] or 0)


def _quotas(df: DataFrame, shares: DataFrame | None, label: str, cut: str, total: int, quota: str = "quota") -> DataFrame:
    if shares is not None:
        return shares.select(c(label), F.lit(cut).alias("cut"), F.col(quota).alias("quota"))
    return df.sparkSession.range(1).select(
        F.lit(cut).alias("cut"), F.lit(total).cast("bigint").alias("quota")
    )


def _two_cuts(
    df: DataFrame,
    label: str,
    seed: int,
    key: Key,
    sizes: ClassTable,
    outer: int,
    inner: int,
    stratify_outer: bool,
    stratify_inner: Callable[[ClassTable], bool],
    names: tuple[str, str, str],
    task_rows: int,
) -> DataFrame:
    """Take ``outer`` rows of the table and ``inner`` of those, both in hash order.

    ``names`` are the splits for: outside, in the outer part only, in the inner part.
    ``stratify_inner`` decides on the class sizes of the outer part.
    """
    outside, middle, inside = names
    marks = {"outer": "__outer", "inner": "__inner"}
    strata, shares, both_by_class = [], None, False
    if stratify_outer:
        strata = [label]
        shares, held = _both_shares(sizes, outer, inner)
        both_by_class = stratify_inner(held)
    quotas = _quotas(df, shares, label, "outer", outer)
    if both_by_class or (not stratify_outer and not stratify_inner(sizes)):
        # The same groups in the same order twice: one set of passes finds both cuts.
        quotas = quotas.unionByName(_quotas(df, shares, label, "inner", inner, "inner"))
        ends = hash_cuts(df, quotas, strata, key, seed, list(marks), task_rows, sizes.rows)
        marked = mark_cuts(df, ends, strata, key, seed, marks)
    else:
        ends = hash_cuts(df, quotas, strata, key, seed, ["outer"], task_rows, sizes.rows)
        marked = mark_cuts(df, ends, strata, key, seed, {"outer": "__outer"})
        # Only the rows of the outer part count; copies of one row may lie on both sides.
        rest = marked.where("__outer")
        inner_strata, inner_shares = ["__outer"], None
        if not stratify_outer:
            held = class_table(rest, label)
            if stratify_inner(held):
                inner_strata = [label, "__outer"]
                inner_shares = share_out(held.table, label, inner, outer, held.classes)
        quotas = _quotas(df, inner_shares, label, "inner", inner).withColumn("__outer", F.lit(True))
        key = key or df.columns
        ends = hash_cuts(rest, quotas, inner_strata, key, seed, ["inner"], task_rows, outer)
        marked = mark_cuts(marked, ends, inner_strata, key, seed, {"inner": "__inner"})
    split = (
        F.when(F.col("__outer") & F.col("__inner"), F.lit(inside))
        .when(F.col("__outer"), F.lit(middle))
        .otherwise(F.lit(outside))
    )
    return marked.select(*[c(n) for n in df.columns], split.alias("split"))


def split_two_step(
    df: DataFrame,
    label: str,
    test_size: float,
    val_size: float,
    seed: int = 42,
    key: Key = None,
    stratify: bool = True,
    task_rows: int = TASK_ROWS,
    classes: ClassTable | None = None,
) -> DataFrame:
    """Hold out ``test_size`` of the rows, then cut the hold-out again.

    ``test`` gets ``val_size / test_size`` of the hold-out and ``valid`` the rest of it,
    so with sizes 0.05 and 0.03 they get 3 % and 2 % of the table. Both cuts keep the
    class shares where every class has two rows or more and both parts have room for
    every class; otherwise that cut is plainly random. ``classes`` are those of ``df``,
    if they are counted already.
    """
    require(df, label)
    if not 0 < test_size < 1:
        raise ValueError("test_size must be between 0 and 1")
    if not 0 < val_size < 1:
        raise ValueError("val_size must be between 0 and 1")
    if val_size >= test_size:
        raise ValueError("val_size must be smaller than test_size")
    sizes = classes or class_table(df, label)
    outer = math.ceil(test_size * sizes.rows)
    inner = math.ceil(val_size / test_size * outer)

    def fits(part: int, of: ClassTable) -> bool:
        return stratify and of.smallest >= 2 and min(part, of.rows - part) >= of.classes

    def fits_inner(held: ClassTable) -> bool:
        return fits(inner, held) and held.classes == sizes.classes

    return _two_cuts(
        df, label, seed, key, sizes, outer, inner, fits(outer, sizes), fits_inner,
        ("train", "valid", "test"), task_rows,
    )


def split_ratios(
    df: DataFrame,
    label: str,
    train_ratio: float = 0.7,
    val_ratio: float = 0.15,
    test_ratio: float = 0.15,
    seed: int = 42,
    key: Key = None,
    min_samples_per_class: int = 2,
    task_rows: int = TASK_ROWS,
    classes: ClassTable | None = None,
) -> DataFrame:
    """Train / val / test by ratio.

    A cut keeps the class shares when the smallest class it sees has at least
    ``min_samples_per_class`` rows and is plainly random otherwise. ``classes`` are those
    of ``df``, if they are counted already.
    """
    require(df, label)
    if not 0 < test_ratio < 1 or not 0 < val_ratio or not 0 < train_ratio:
        raise ValueError("ratios must be positive and test_ratio below 1")
    sizes = classes or class_table(df, label)
    test = math.ceil(test_ratio * sizes.rows)
    val = math.ceil(val_ratio / (train_ratio + val_ratio) * (sizes.rows - test))

    def enough(of: ClassTable) -> bool:
        return of.smallest >= min_samples_per_class

    # The first cut takes everything but the test rows, the second the val rows of those.
    return _two_cuts(
        df, label, seed, key, sizes, sizes.rows - test, val, enough(sizes), enough,
        ("test", "train", "val"), task_rows,
    )
