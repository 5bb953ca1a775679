"""Row filters and duplicate removal."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tabwright.functions.columns import c, is_float, missing, order_struct, present, require, type_of
from tabwright.operators.classes import ClassTable, class_tables, keep_classes

Rule = Mapping[str, Any]


# --- filters ----------------------------------------------------------------------------


def drop_nulls(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop rows that miss a value in any listed existing column (NaN counts as missing).

    One condition per column rather than ``dropna``, because only those reach the file.
    """
    for name in present(df, columns):
        df = df.where(c(name).isNotNull())
        if is_float(df, name):
            df = df.where(~F.isnan(c(name)))
    return df


def _one_of(name: str, values: Sequence[Any]) -> Column:
    known = [v for v in values if v is not None]
    hit = c(name).isin(known) if known else F.lit(False)
    return hit | c(name).isNull() if len(known) < len(values) else hit


def _usable(df: DataFrame, rules: Iterable[Rule]) -> list[tuple[str, list[Any]]]:
    return [
        (rule["column"], list(rule["values"]))
        for rule in rules
        if rule.get("column") in df.columns and rule.get("values")
    ]


def keep_rows(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Keep rows whose column is among the values, for every rule; NULL goes.

    A rule is ``{"column": ..., "values": [...]}``; a rule without values or on a column
    that does not exist does nothing.
    """
    for name, values in _usable(df, rules):
        df = df.where(_one_of(name, values))
    return df


def drop_rows(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Drop rows whose column is among the values; NULL stays unless it is listed."""
    for name, values in _usable(df, rules):
        known = [v for v in values if v is not None]
        if known:
            df = df.where(c(name).isNull() | ~c(name).isin(known))
        if len(known) < len(values):
            df = df.where(c(name).isNotNull())
    return df


def range_filter(
    df: DataFrame, column: str, low: Any | None = None, high: Any | None = None
) -> DataFrame:
    """Keep rows with ``low <= column <= high``; NULL goes as soon as a bound is given."""
    if column not in df.columns:
        return df
    for bound, test in ((low, c(column) >= F.lit(low)), (high, c(column) <= F.lit(high))):
        if bound is not None:
            df = df.where(test)
            if is_float(df, column):
                df = df.where(~F.isnan(c(column)))
    return df


def _condition(df: DataFrame, rule: Rule) -> Column | None:
    """The rows a rule keeps; None when the operator is not known. NaN is missing."""
    name, operator, value = rule["column"], rule.get("operator", "=="), rule.get("value")
    col = c(name)
    if operator == "isin":
        return _one_of(name, list(value))
    if operator == "not_null":
        return ~missing(df, name)
    if operator == "is_null":
        return missing(df, name)
    if operator == "!=":
        return missing(df, name) | (col != F.lit(value)) if value is not None else F.lit(True)
    test = {
        "==": col == F.lit(value),
        ">": col > F.lit(value),
        "<": col < F.lit(value),
        ">=": col >= F.lit(value),
        "<=": col <= F.lit(value),
    }.get(operator)
    # Two conditions, so that the comparison itself can be pushed into the scan.
    return test & ~F.isnan(col) if test is not None and is_float(df, name) else test


def _conditions(df: DataFrame, rules: Iterable[Rule]) -> list[tuple[Rule, Column]]:
    found = []
    for rule in rules:
        if rule.get("column") in df.columns:
            test = _condition(df, rule)
            found.append((rule, F.lit(True) if test is None else test))
    return found


def row_filters(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Apply ``column operator value`` rules in order.

    Operators: ``== != > < >= <= isin not_null is_null``. ``!=`` keeps NULL, the other
    comparisons drop it, and NaN counts as NULL. Rules on columns that do not exist do
    nothing.
    """
    for _, test in _conditions(df, rules):
        df = df.where(test)
    return df


def _running(tests: Sequence[Column]) -> list[Column]:
    """Rows left after the first, second, ... test, as true/false without NULL."""
    solid = [F.coalesce(test, F.lit(False)) for test in tests]
    return [reduce(lambda a, b: a & b, solid[: i + 1]) for i in range(len(solid))]


def _left_over(tests: Sequence[Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("left0")] + [
        F.count_if(left).alias(f"left{i + 1}") for i, left in enumerate(_running(tests))
    ]


_REPORT = (
    "step int, column string, operator string, value string, "
    "rows_before bigint, rows_after bigint, rows_removed bigint"
)


def row_filter_report(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One row per rule: rows before, rows after, rows removed - in one pass over ``df``."""
    found = _conditions(df, rules)
    counts = df.agg(*_left_over([test for _, test in found]))
    steps = [
        F.struct(
            F.lit(i + 1).alias("step"),
            F.lit(rule["column"]).alias("column"),
            F.lit(rule.get("operator", "==")).alias("operator"),
            F.lit(None if rule.get("value") is None else str(rule["value"])).cast("string").alias("value"),
            F.col(f"left{i}").alias("rows_before"),
            F.col(f"left{i + 1}").alias("rows_after"),
            (F.col(f"left{i}") - F.col(f"left{i + 1}")).alias("rows_removed"),
        )
        for i, (rule, _) in enumerate(found)
    ]
    if not steps:
        return df.sparkSession.createDataFrame([], _REPORT)
    return counts.select(F.inline(F.array(*steps)))


def observed_row_filters(
    df: DataFrame, rules: Iterable[Rule], name: str = "row_filters"
) -> tuple[DataFrame, Observation]:
    """``row_filters`` that also counts the rows left after each rule while it runs.

    The counts ``left0, left1, ...`` are there after the first action. They are for
    monitoring: a stage that is run again after an executor was lost is counted again.
    ``row_filter_report`` is exact.
    """
    found = _conditions(df, rules)
    watch = Observation(name)
    seen = df.observe(watch, *_left_over([test for _, test in found]))
    return row_filters(seen, [rule for rule, _ in found]), watch


def stage_rules(filters: Mapping[str, Rule]) -> list[dict[str, Any]]:
    """``between`` / ``in`` / ``equals`` filters keyed by column, as ordinary rules.

    ``equals`` without values filters nothing, and so does ``between`` without two.
    """
    rules: list[dict[str, Any]] = []
    for column, spec in filters.items():
        operator, values = spec.get("operator", "equals"), list(spec.get("values") or [])
        if operator == "between" and len(values) == 2:
            rules.append({"column": column, "operator": ">=", "value": values[0]})
            rules.append({"column": column, "operator": "<=", "value": values[1]})
        elif operator == "in":
            rules.append({"column": column, "operator": "isin", "value": values})
        elif operator == "equals" and values:
            rules.append({"column": column, "operator": "==", "value": values[0]})
    return rules


def stage_filters(df: DataFrame, filters: Mapping[str, Rule]) -> DataFrame:
    return row_filters(df, stage_rules(filters))


# --- class size filters -----------------------------------------------------------------


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per label; NULL is no label."""
    return df.where(c(label).isNotNull()).groupBy(c(label)).agg(F.count(F.lit(1)).alias("count"))


def filter_minority_classes(df: DataFrame, label: str, min_count: int) -> DataFrame:
    """Keep labels with more than ``min_count`` rows; at least two must remain."""
    require(df, label)
    if min_count <= 0:
        return df
    return keep_larger_classes(df, class_tables(df, label, min_count + 1)[1])


def keep_larger_classes(df: DataFrame, kept: ClassTable) -> DataFrame:
    """The rows of the classes that are left; at least two must be."""
    if kept.classes < 2:
        raise ValueError(f"{kept.classes} label class(es) left; lower min_count to keep two or more")
    return keep_classes(df, kept)


def class_filter(df: DataFrame, label: str, min_samples: int = 2) -> DataFrame:
    """Keep labels with at least ``min_samples`` rows."""
    if label not in df.columns:
        return df
    return keep_classes(df, class_tables(df, label, min_samples)[1])


def class_filter_report(df: DataFrame, label: str, min_samples: int = 2) -> DataFrame:
    """Classes and rows that ``class_filter`` removes (rows without a label among them)."""
    small = F.col("count") < min_samples
    unlabelled = df.agg(F.count_if(c(label).isNull()).alias("unlabelled"))
    counts = class_counts(df, label).agg(
        F.count_if(small).alias("removed_classes"),
        F.coalesce(F.sum(F.when(small, F.col("count"))), F.lit(0)).alias("small_rows"),
    )
    one = [F.lit(1).alias("one")]
    return (
        counts.select("*", *one)
        .join(unlabelled.select("*", *one), "one")
        .select(
            "removed_classes",
            (F.col("small_rows") + F.col("unlabelled")).alias("removed_rows"),
            F.lit(min_samples).alias("min_samples"),
        )
    )


# --- duplicates -------------------------------------------------------------------------


def dedup_rows(df: DataFrame) -> DataFrame:
    """One of each full row; NULL equals NULL. Copies meet before the shuffle."""
    return df.dropDuplicates()


def dedup_by_key(
    df: DataFrame,
    key: Sequence[str] | None = None,
    keep: str = "first",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """The first or last row of each key, in the given order.

    Rows that tie in ``order_by`` are ordered by the other columns, so the choice does not
    depend on how rows are partitioned.

    Written as a minimum over ``(order, row)`` and not as a window, so that each task
    reduces a key to one row before the shuffle: a key that holds a third of all rows
    sends one row per task, not a third of the table to one task.
    """
    if key is None:
        return dedup_rows(df)
    key = present(df, key)
    names = df.columns
    ordered = list(dict.fromkeys([*(order_by or []), *names]))
    pick = {"first": F.min, "last": F.max}[keep]
    # The order holds every column, so the row is read out of it and travels once.
    best = df.groupBy(*[c(k) for k in key]).agg(pick(order_struct(ordered)).alias("row"))
    return best.select(*[F.col("row").getField(f"v{ordered.index(n)}").alias(n) for n in names])


def duplicates_removed(df: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Rows in, rows left and rows removed by duplicate removal."""
    names = present(df, key) if key else df.columns
    return (
        df.groupBy(*[c(n) for n in names])
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
            F.count(F.lit(1)).alias("rows_after"),
        )
        .select(
            "rows_before",
            "rows_after",
            (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        )
    )

