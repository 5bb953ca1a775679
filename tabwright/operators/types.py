"""Type normalisation by column name, and narrowing by observed values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.fixed_values import FLOAT_TOLERANCE
from tabwright.functions.columns import c, present, type_of
from tabwright.functions.dates import first_digits, yyyymmdd
from tabwright.functions.numbers import to_double, whole_text
from tabwright.operators.profile import distinct_counts
from tabwright.sources.shared import settle, settle_with


def _named(df: DataFrame, token: str) -> list[str]:
    return [name for name in df.columns if token in name.lower()]


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[n].alias(n) if n in new else c(n) for n in df.columns])


def normalize_dates(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """YYYYMMDD integers out of the first digit run; any other length gives NULL.

    The default columns are those with ``date`` in the name.
    """
    names = _named(df, "date") if columns is None else present(df, columns)
    return _replace(df, {n: yyyymmdd(c(n), type_of(df, n)) for n in names})


def date_rejects(
    df: DataFrame, columns: Iterable[str] | None = None, samples: int = 5
) -> DataFrame:
    """Per date column: rows whose digit run is not eight long, and a few such runs.

    The samples are the first distinct runs in text order.
    """
    names = _named(df, "date") if columns is None else present(df, columns)
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column string, rejected bigint, samples array<string>"
        )
    runs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("column"), first_digits(c(n), type_of(df, n)).alias("run")
                    )
                    for n in names
                ]
            )
        )
    ).where(F.length("run") != 8)
    # One row per distinct run, so a run that fills the table is one row afterwards. The
    # rank filter is applied by Spark before the shuffle too (window group limit), so only
    # the smallest few runs of each task reach the ranking task.
    counted = runs.groupBy("column", "run").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(W.partitionBy("column").orderBy("run"))
    smallest = counted.withColumn("place", place).where(F.col("place") <= samples)
    shown = smallest.groupBy("column").agg(F.array_sort(F.collect_list("run")).alias("samples"))
    totals = counted.groupBy("column").agg(F.sum("n").alias("rejected"))
    return totals.join(shown, "column", "left")


def normalize_amounts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Doubles; what is no number gives NULL. Default: names with ``amount``."""
    names = _named(df, "amount") if columns is None else present(df, columns)
    return _replace(df, {n: to_double(c(n), type_of(df, n)) for n in names})


def normalize_codes(
    df: DataFrame, columns: Iterable[str] | None = None, fraction: str = "raise"
) -> DataFrame:
    """Codes as text, 13.0 as "13". Default: every column that is no date or amount."""
    if columns is None:
        taken = {*_named(df, "date"), *_named(df, "amount")}
        columns = [n for n in df.columns if n not in taken]
    names = present(df, columns)
    return _replace(df, {n: whole_text(c(n), type_of(df, n), fraction) for n in names})


def transform_dtype(df: DataFrame, fraction: str = "raise") -> DataFrame:
    """Dates to integers, amounts to doubles, the rest to text, chosen by column name."""
    return normalize_codes(normalize_amounts(normalize_dates(df)), fraction=fraction)


_RANGES = [
    (T.ByteType(), -(2**7), 2**7 - 1),
    (T.ShortType(), -(2**15), 2**15 - 1),
    (T.IntegerType(), -(2**31), 2**31 - 1),
]


#: A sketched share of distinct values this far from the limit decides; its error is 2 %.
_CLEAR = 0.2


def narrow_report(
    df: DataFrame, category_ratio: float = 0.5, exclude: Iterable[str] = (), exact: bool = True
) -> DataFrame:
    """What each column could be stored as.

    One row per column: ``column, from_type, to_type, min_value, max_value,
    distinct_count, category_candidate``. Long columns shrink to the smallest integer
    type that holds their range, doubles to float when no value moves by more than the
    tolerance, text columns are category candidates below the distinct ratio.

    With ``exact=False`` distinct values are sketched in the pass that finds the ranges;
    only columns whose sketch is within a fifth of the ratio are counted, so the
    candidates are the same, and ``distinct_count`` is an estimate for all others.
    """
    return _narrow_report(df, category_ratio, exclude, exact).drop("rows")


def _narrow_report(
    df: DataFrame, category_ratio: float, exclude: Iterable[str], exact: bool
) -> DataFrame:
    skip = set(exclude)
    longs = [f.name for f in df.schema if isinstance(f.dataType, T.LongType) and f.name not in skip]
    doubles = [
        f.name for f in df.schema if isinstance(f.dataType, T.DoubleType) and f.name not in skip
    ]
    texts = [
        f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]
    spots: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for i, n in enumerate(longs):
        spots += [F.min(c(n)).alias(f"lo{i}"), F.max(c(n)).alias(f"hi{i}")]
    for i, n in enumerate(doubles):
        moved = F.abs(c(n).cast("float").cast("double") - c(n)) > F.lit(FLOAT_TOLERANCE)
        spots.append(F.max(F.when(~F.isnan(c(n)), moved)).alias(f"mv{i}"))
    if not exact:
        spots += [F.approx_count_distinct(c(n), 0.02).alias(f"d{i}") for i, n in enumerate(texts)]
    base = df.agg(*spots)
    counted = texts
    if not exact:
        base = settle(base)
        known = base.first()
        limit = category_ratio * known["rows"]
        counted = [n for i, n in enumerate(texts) if abs(known[f"d{i}"] - limit) <= _CLEAR * limit]

    entries = []
    for f in df.schema:
        n = f.name
        lo = hi = F.lit(None).cast("bigint")
        to = F.lit(f.dataType.simpleString())
        if n in longs:
            i = longs.index(n)
            lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
            for small, low, high in reversed(_RANGES):
                to = F.when((lo >= low) & (hi <= high), F.lit(small.simpleString())).otherwise(to)
        elif n in doubles:
            moved = F.coalesce(F.col(f"mv{doubles.index(n)}"), F.lit(False))
            to = F.when(~moved, F.lit("float")).otherwise(to)
        entries.append(
            F.struct(
                F.lit(n).alias("column"),
                F.lit(f.dataType.simpleString()).alias("from_type"),
                to.alias("to_type"),
                lo.alias("min_value"),
                hi.alias("max_value"),
                F.col("rows"),
                (F.col(f"d{texts.index(n)}") if n in texts and n not in counted else F.lit(None).cast("bigint")).alias("about"),
            )
        )
    report = base.select(F.inline(F.array(*entries)))
    counts = distinct_counts(df, counted).withColumnRenamed("distinct_count", "found")
    return report.join(counts, "column", "left").withColumn("distinct_count", F.coalesce("found", "about")).select(
        "column",
        "from_type",
        "to_type",
        "min_value",
        "max_value",
        "distinct_count",
        F.coalesce(
            F.col("distinct_count") / F.nullif(F.col("rows"), F.lit(0)) < F.lit(category_ratio), F.lit(False)
        ).alias("category_candidate"),
        "rows",
    )


def narrow_types(
    df: DataFrame, category_ratio: float = 0.5, exclude: Iterable[str] = (), exact: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Cast every column to the type of its report row; returns (table, report).

    Parquet dictionary encoding already stores categories, so those are only reported.
    """
    narrowed, report, _ = narrow_and_count(df, category_ratio, exclude, exact)
    return narrowed, report


def narrow_and_count(
    df: DataFrame, category_ratio: float = 0.5, exclude: Iterable[str] = (), exact: bool = True
) -> tuple[DataFrame, DataFrame, int]:
    """``narrow_types`` and the rows of the table, which the report counts anyway."""
    found = _narrow_report(df, category_ratio, exclude, exact)
    report, facts = settle_with(found, rows=F.max("rows"))
    report = report.drop("rows")
    target = {row["column"]: row["to_type"] for row in report.select("column", "to_type").collect()}
    changed = {f.name: target[f.name] for f in df.schema if target[f.name] != f.dataType.simpleString()}
    return _replace(df, {n: c(n).cast(t) for n, t in changed.items()}), report, facts["rows"] or 0
