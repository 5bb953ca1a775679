"""Profiles of a table as report tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.columns import NUMBERS, TIMES, c, missing, present, type_of
from tabwright.operators.classes import ClassTable, class_table
from tabwright.operators.ordering import TASK_ROWS, join_null_safe
from tabwright.operators.quantiles import (
    enclosed,
    exact_quantiles,
    quantile_names,
    read_off,
    sketch_of,
    stretch_ends,
    stretches_from,
)
from tabwright.operators.rows import class_counts
from tabwright.sources.shared import settle, settle_with


def _per_column(totals: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """One row of totals to one row per column."""
    return totals.select(F.inline(F.array(*entries)))


def missing_stats(df: DataFrame) -> DataFrame:
    """One row per column: total rows, total columns, NULL count and NULL ratio."""
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(missing(df, n)).alias(f"m{i}") for i, n in enumerate(df.columns)],
    )
    return _per_column(
        totals,
        [
            F.struct(
                F.lit(n).alias("column"),
                F.col("rows").alias("total_rows"),
                F.lit(len(df.columns)).alias("total_columns"),
                F.col(f"m{i}").alias("null_count"),
                F.coalesce(
                    F.col(f"m{i}") / F.nullif(F.col("rows"), F.lit(0)), F.lit(0.0)
                ).alias("null_ratio"),
            )
            for i, n in enumerate(df.columns)
        ],
    )


def _comparable(df: DataFrame, name: str) -> Column:
    """The value as text such that equal values, and only those, print equally."""
    if isinstance(type_of(df, name), (T.FloatType, T.DoubleType)):
        # 0.0 and -0.0 are one value; NaN is missing.
        return F.when(~F.isnan(c(name)), c(name) + F.lit(0.0)).cast("string")
    if isinstance(type_of(df, name), (T.ArrayType, T.StructType)):
        return F.to_json(F.struct(c(name)))
    return c(name).cast("string")


def distinct_counts(
    df: DataFrame, columns: Iterable[str] | None = None, exact: bool = True
) -> DataFrame:
    """Distinct non-NULL values per column, as ``(column, distinct_count)``.

    Several ``count(distinct)`` in one aggregate would repeat every row per column all
    the way through the shuffle; here values meet as ``(column, value)`` pairs, which
    each task reduces to its distinct ones first. Columns in which nearly every value is
    different still send all of them through the shuffle; ``exact=False`` estimates
    instead, in one pass with a sketch of fixed size per column.
    """
    names = df.columns if columns is None else present(df, columns)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, distinct_count bigint")
    if not exact:
        totals = df.agg(
            *[F.approx_count_distinct(_comparable(df, n)).alias(f"d{i}") for i, n in enumerate(names)]
        )
        return _per_column(
            totals,
            [
                F.struct(F.lit(n).alias("column"), F.col(f"d{i}").alias("distinct_count"))
                for i, n in enumerate(names)
            ],
        )
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("column"), _comparable(df, n).alias("value"))
                    for n in names
                ]
            )
        )
    )
    # NULL is kept as a pair so that a column of only NULL still gets its row.
    return (
        pairs.groupBy("column", "value")
        .agg(F.lit(1).alias("one"))
        .groupBy("column")
        .agg(F.count("value").alias("distinct_count"))
    )


def table_metadata(
    df: DataFrame,
    distinct_of: Sequence[str] = ("account", "category"),
    amount: str = "amount",
) -> DataFrame:
    """Facts about the table as ``(scope, name, value)`` rows.

    Scope ``table`` has the counts and the column lists, ``dtype`` and ``nulls`` one row
    per column. Columns named in ``distinct_of`` and ``amount`` add their distinct
    counts, sum and mean when they exist.
    """
    names = df.columns
    by_kind = {
        "numeric_columns": NUMBERS,
        "text_columns": (T.StringType,),
        "datetime_columns": TIMES,
    }
    totals = [F.count(F.lit(1)).alias("rows")]
    totals += [F.count_if(missing(df, n)).alias(f"m{i}") for i, n in enumerate(names)]
    if amount in names:
        known = F.when(~missing(df, amount), c(amount).cast("double"))
        totals += [F.sum(known).alias("amount_sum"), F.avg(known).alias("amount_mean")]

    def fact(scope: str, name: str, value: Column) -> Column:
        return F.struct(
            F.lit(scope).alias("scope"),
            F.lit(name).alias("name"),
            value.cast("string").alias("value"),
        )

    facts = [
        fact("table", "total_records", F.col("rows")),
        fact("table", "total_columns", F.lit(len(names))),
        fact("table", "columns", F.lit(",".join(names))),
    ]
    for kind, types in by_kind.items():
        listed = ",".join(f.name for f in df.schema if isinstance(f.dataType, types))
        facts.append(fact("table", kind, F.lit(listed)))
    facts += [fact("dtype", f.name, F.lit(f.dataType.simpleString())) for f in df.schema]
    facts += [fact("nulls", n, F.col(f"m{i}")) for i, n in enumerate(names)]
    if amount in names:
        facts.append(fact("amount", "total_amount", F.col("amount_sum")))
        facts.append(fact("amount", "avg_amount", F.col("amount_mean")))
    report = _per_column(df.agg(*totals), facts)
    counted = present(df, distinct_of)
    if counted:
        report = report.unionByName(
            distinct_counts(df, counted).select(
                F.lit("distinct").alias("scope"),
                F.col("column").alias("name"),
                F.col("distinct_count").cast("string").alias("value"),
            )
        )
    return report


def column_statistics(
    df: DataFrame, exact_distinct: bool = True, task_rows: int = TASK_ROWS
) -> DataFrame:
    """One row per column: type, counts, distinct values and, for numbers, the spread.

    Numbers add mean, sample standard deviation, min, max, median and quartiles.

    Two passes over the table, whatever its width. The first takes counts, moments and a
    sketch of every column, which encloses the quartiles. The second counts equal values
    of a column, combined before the shuffle; distinct values are counted there, and the
    quartiles read off the few counted values inside their enclosures. With
    ``exact_distinct=False`` distinct values are sketched as well, and only the enclosed
    values go through the shuffle.
    """
    names = df.columns
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NUMBERS)]
    probs = [0.25, 0.5, 0.75]
    accuracy = 10_000
    ends = stretch_ends(probs, accuracy)
    spots = [F.count(F.lit(1)).alias("rows")]
    for i, n in enumerate(names):
        spots.append(F.count_if(missing(df, n)).alias(f"m{i}"))
        if n in numeric:
            known = F.when(~missing(df, n), c(n).cast("double"))
            spots += [
                F.avg(known).alias(f"avg{i}"),
                F.stddev_samp(known).alias(f"std{i}"),
                F.min(known).alias(f"min{i}"),
                F.max(known).alias(f"max{i}"),
                sketch_of(known, ends, accuracy).alias(f"e{i}"),
            ]
        if not exact_distinct:
            spots.append(F.approx_count_distinct(_comparable(df, n)).alias(f"d{i}"))
    empty, none = F.lit(None).cast("double"), F.lit(None).cast("array<double>")
    entries = []
    for i, f in enumerate(df.schema):
        is_number = f.name in numeric
        entries.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                (F.col("rows") - F.col(f"m{i}")).alias("count"),
                F.col(f"m{i}").alias("null_count"),
                (F.col(f"m{i}") / F.nullif(F.col("rows"), F.lit(0))).alias("null_ratio"),
                *[
                    (F.col(f"{part}{i}") if is_number else empty).alias(part)
                    for part in ("avg", "std", "min", "max")
                ],
                (F.col(f"e{i}") if is_number else none).alias("__e"),
                (F.lit(None).cast("bigint") if exact_distinct else F.col(f"d{i}")).alias("about"),
            )
        )
    report = settle(_per_column(df.agg(*spots), entries))
    whole = F.col("n") <= F.lit(max(accuracy, task_rows // 10))
    stretches = stretches_from(
        report.where("__e is not null").select(
            "column", F.col("count").alias("n"), F.col("min").alias("__min"), F.col("max").alias("__max"), "__e"
        ),
        [c("column")], probs, ends, whole,
    )

    def pair(n: str):
        number = c(n).cast("double") if n in numeric else empty
        value = _comparable(df, n) if exact_distinct else F.lit(None).cast("string")
        return F.struct(F.lit(n).alias("column"), value.alias("value"), number.alias("__x"))

    pairs = df.select(F.inline(F.array(*[pair(n) for n in (names if exact_distinct else numeric)]))) if names else None
    quartiles = report.select("column").where(F.lit(False)).select("column", *[empty.alias(q) for q in quantile_names(probs)])
    distinct = report.select("column", F.col("about").alias("unique_count"))
    number = F.col("__x").isNotNull() & ~F.isnan("__x")
    if exact_distinct:
        counted = settle(pairs.groupBy("column", "value").agg(F.first("__x").alias("__x"), F.count(F.lit(1)).alias("times")))
        distinct = counted.groupBy("column").agg(F.count("value").alias("unique_count"))
    elif numeric:
        counted = pairs.withColumn("times", F.lit(1).cast("bigint"))
    if numeric:
        met = join_null_safe(counted.where(number), stretches, ["column"])
        few = enclosed(met, [c("column")], probs, F.col("times"))
        found, facts = settle_with(read_off(few, ["column"], probs), missed=F.max("__missed"))
        quartiles = found.drop("n", "__missed")
        if facts["missed"]:
            values = counted.where(number).select("column", F.explode(F.array_repeat("__x", F.col("times").cast("int"))).alias("x"))
            quartiles = exact_quantiles(values, ["column"], F.col("x"), probs, task_rows).drop("n")
    return (
        report.join(distinct, "column", "left")
        .join(quartiles, "column", "left")
        .select(
            "column",
            "dtype",
            "count",
            "null_count",
            "null_ratio",
            F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
            F.col("avg").alias("mean"),
            "std",
            "min",
            "max",
            F.col("q1").alias("median"),
            F.col("q0").alias("q1"),
            F.col("q2").alias("q3"),
        )
    )


# --- classes ----------------------------------------------------------------------------


def class_distribution(
    df: DataFrame,
    target: str,
    top: int = 10,
    rare_ratio: float = 0.01,
    classes: ClassTable | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Two reports: classes ``(label, count, ratio, is_top, is_rare)``, and a summary row.

    Ratios are over all rows, those without a label included. Among equal counts the
    smaller label comes first. With ``classes`` of the same rows nothing is counted again.
    """
    classes = classes or class_table(df, target)
    total = classes.rows
    counts = classes.table.where(c(target).isNotNull()).select(c(target).alias("label"), "count")
    best = counts.orderBy(F.desc("count"), "label").limit(top).select("label", F.lit(True).alias("t"))
    rare = F.col("count") < F.lit(total * rare_ratio)
    report = counts.join(best, "label", "left").select(
        "label",
        "count",
        (F.col("count") / F.lit(total)).alias("ratio"),
        F.coalesce("t", F.lit(False)).alias("is_top"),
        rare.alias("is_rare"),
    )
    rare_rows = F.coalesce(F.sum(F.when(rare, F.col("count"))), F.lit(0))
    summary = counts.agg(
        F.count(F.lit(1)).alias("num_classes"),
        F.lit(total).alias("total_samples"),
        F.min("count").alias("min_class_samples"),
        F.max("count").alias("max_class_samples"),
        (F.max("count") / F.min("count")).alias("imbalance_ratio"),
        F.count_if(rare).alias("rare_classes"),
        rare_rows.alias("rare_samples"),
        (rare_rows / F.lit(max(total, 1))).alias("rare_ratio"),
    )
    return report, summary


def label_top_k(df: DataFrame, label: str, k: int = 10) -> DataFrame:
    """The k most frequent labels; among equal counts the smaller label first."""
    return (
        class_counts(df, label)
        .select(c(label).alias("label"), "count")
        .orderBy(F.desc("count"), "label")
        .limit(k)
    )


def infer_num_labels(df: DataFrame, label: str = "labels") -> DataFrame:
    """The number of classes as one row ``(num_labels)``.

    An id column that carries its label names has as many classes as names.
    """
    names = df.schema[label].metadata.get("labels")
    if names:
        return df.sparkSession.range(1).select(F.lit(len(names)).cast("bigint").alias("num_labels"))
    return df.select(c(label).alias("l")).distinct().agg(F.count(F.lit(1)).alias("num_labels"))


# --- stages and splits ------------------------------------------------------------------


def stage_row_counts(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows in, out and removed per stage, exactly.

    Each stage is counted by an aggregate of its own. Pass written stages
    (``checkpoint_stage``), so that counting reads file footers and repeats no work.
    """
    counted = None
    for i, (name, df) in enumerate(stages):
        one = df.agg(F.count(F.lit(1)).alias("rows_out")).select(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), "rows_out"
        )
        counted = one if counted is None else counted.unionByName(one)
    if counted is None:
        raise ValueError("no stages")
    counted = settle(counted)
    before = counted.select(
        (F.col("step") + 1).alias("step"), F.col("rows_out").alias("rows_in")
    )
    rows_in = F.coalesce("rows_in", "rows_out")
    return counted.join(before, "step", "left").select(
        "step",
        "stage",
        rows_in.alias("rows_in"),
        "rows_out",
        (rows_in - F.col("rows_out")).alias("rows_removed"),
    )


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass here while the job runs, for monitoring.

    A stage that is run again after an executor was lost is counted again; use
    ``stage_row_counts`` where the number has to be right.
    """
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def split_stats(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows and share of each split."""
    counts = df.groupBy(c(split).alias("split")).agg(F.count(F.lit(1)).alias("rows"))
    counts, facts = settle_with(counts, total=F.sum("rows"))
    return counts.select("split", "rows", (F.col("rows") / F.lit(facts["total"] or 1)).alias("ratio"))


def profile_diff(
    current: DataFrame, previous: DataFrame | None = None, include_removed: bool = False
) -> DataFrame:
    """What a profile ``(column, metric, value)`` has that the previous one has not.

    Gives ``added`` and ``changed`` entries, on request ``removed`` ones too.
    """
    now = current.select("column", "metric", F.col("value").alias("current"))
    if previous is None:
        empty = F.lit(None).cast(type_of(current, "value"))
        return now.select(
            "column", "metric", empty.alias("previous"), "current", F.lit("added").alias("change")
        )
    now = now.withColumn("is_now", F.lit(True))
    then = previous.select("column", "metric", F.col("value").alias("previous")).withColumn(
        "is_then", F.lit(True)
    )
    change = (
        F.when(F.col("is_then").isNull(), "added")
        .when(F.col("is_now").isNull(), "removed")
        .when(~F.col("current").eqNullSafe(F.col("previous")), "changed")
    )
    both = now.join(then, ["column", "metric"], "full_outer").withColumn("change", change)
    wanted = ["added", "changed"] + (["removed"] if include_removed else [])
    return both.where(F.col("change").isin(wanted)).select(
        "column", "metric", "previous", "current", "change"
    )


def long_profile(report: DataFrame, key: str = "column") -> DataFrame:
    """A wide report as ``(column, metric, value)`` text rows, for ``profile_diff``."""
    metrics: list[Any] = [
        F.struct(F.lit(n).alias("metric"), c(n).cast("string").alias("value"))
        for n in report.columns
        if n != key
    ]
    return report.select(c(key).alias("column"), F.inline(F.array(*metrics)))
