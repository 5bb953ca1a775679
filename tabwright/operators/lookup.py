"""Code to text, account categories, periods, day types."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.fixed_values import CODE_TEXT, FIXED_HOLIDAYS, TAX_KEYWORDS
from tabwright.functions.columns import c, present, type_of
from tabwright.functions.dates import calendar_date, is_weekend, period
from tabwright.functions.numbers import whole_text

CodeMap = Mapping[str | None, str]

# A map up to this size is written into the plan, a larger one is joined.
_PLAN_ENTRIES = 200


# --- codes ------------------------------------------------------------------------------


def _looked_up(value: Column, entries: Mapping[str, str]) -> Column:
    if not entries:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for item in entries.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), value)


def _map_table(spark: SparkSession, entries: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame(list(entries.items()), "__code string, __text string")


def _all_maps(maps: Mapping[str, CodeMap] | None) -> dict[str, CodeMap]:
    return {**CODE_TEXT, **(maps or {})}


def normalize_codes_to_text(
    df: DataFrame, maps: Mapping[str, CodeMap] | None = None
) -> DataFrame:
    """Replace codes by their text; a code without an entry stays as it is.

    ``maps`` (column -> code -> text) takes the place of the built-in map of a column.
    The key ``None`` says what NULL becomes; without it NULL stays NULL.
    """
    names = df.columns
    for name, codes in _all_maps(maps).items():
        if name not in names:
            continue
        entries = {k: v for k, v in codes.items() if k is not None}
        value = whole_text(c(name), type_of(df, name), "keep")
        if len(entries) <= _PLAN_ENTRIES:
            text = _looked_up(value, entries)
        else:
            table = _map_table(df.sparkSession, entries)
            df = df.join(table, value == F.col("__code"), "left")
            text = F.col("__text")
        changed = F.coalesce(text, value, F.lit(codes.get(None)))
        df = df.select(*[changed.alias(n) if n == name else c(n) for n in names])
    return df


def code_mapping_report(
    df: DataFrame, maps: Mapping[str, CodeMap] | None = None
) -> DataFrame:
    """Per mapped column: values that the map changed, and all rows.

    The distinct codes are counted first, so each is looked up once per task.
    """
    found = {n: m for n, m in _all_maps(maps).items() if n in df.columns}
    if not found:
        return df.sparkSession.createDataFrame(
            [], "column string, mapped bigint, total bigint, ratio double"
        )
    values = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("column"),
                        whole_text(c(n), type_of(df, n), "keep").alias("code"),
                    )
                    for n in found
                ]
            )
        )
    )
    counted = values.groupBy("column", "code").agg(F.count(F.lit(1)).alias("n"))
    moved = [
        (n, code, text)
        for n, m in found.items()
        for code, text in m.items()
        if code != text
    ]
    table = df.sparkSession.createDataFrame(moved, "column string, code string, text string")
    hit = (counted["column"] == table["column"]) & counted["code"].eqNullSafe(table["code"])
    return (
        counted.join(table, hit, "left")
        .groupBy(counted["column"])
        .agg(
            F.coalesce(F.sum(F.when(table["column"].isNotNull(), F.col("n"))), F.lit(0)).alias(
                "mapped"
            ),
            F.sum("n").alias("total"),
        )
        .withColumn("ratio", F.col("mapped") / F.col("total"))
    )


def categorize_accounts(
    df: DataFrame,
    mapping: Mapping[str, str],
    column: str = "account",
    out: str = "account_category",
    default: str = "Other",
) -> DataFrame:
    """Account to category; an account without one is ``Other``."""
    names = [n for n in df.columns if n != out]
    if len(mapping) <= _PLAN_ENTRIES:
        text = _looked_up(c(column).cast("string"), mapping)
    else:
        table = _map_table(df.sparkSession, mapping)
        df = df.join(table, c(column).cast("string") == F.col("__code"), "left")
        text = F.col("__text")
    return df.select(*[c(n) for n in names], F.coalesce(text, F.lit(default)).alias(out))


def tax_category(
    df: DataFrame,
    column: str = "account",
    rules: Mapping[str, Sequence[str]] | None = None,
    out: str = "tax_category",
) -> DataFrame:
    """The last category one of whose keywords is part of the account; else ``Other``."""
    if column not in df.columns:
        return df
    found = F.lit("Other")
    lower = F.lower(c(column).cast("string"))
    for category, keywords in (rules or TAX_KEYWORDS).items():
        hit = F.lit(False)
        for keyword in keywords:
            hit = hit | lower.contains(keyword)
        found = F.when(hit, F.lit(category)).otherwise(found)
    return df.withColumn(out, found)


# --- calendar ---------------------------------------------------------------------------


def period_bucket(
    df: DataFrame, column: str = "date", level: str = "month", out: str = "period"
) -> DataFrame:
    """Add the month, quarter or year of a date; another level adds nothing."""
    if column not in df.columns:
        return df
    value = period(calendar_date(c(column), type_of(df, column)), level)
    return df if value is None else df.withColumn(out, value)


def period_totals(
    df: DataFrame, column: str = "date", level: str = "month", amounts: Iterable[str] = ()
) -> DataFrame:
    """Rows and sums of the amounts per period."""
    bucketed = period_bucket(df, column, level)
    if "period" not in bucketed.columns:
        raise ValueError(f"no periods of level {level!r} from column {column!r}")
    return bucketed.groupBy("period").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(c(a)).alias(a) for a in present(df, amounts)],
    )


def fixed_holidays(years: Iterable[int]) -> list[dt.date]:
    """The public holidays whose date does not move, for the given years.

    Lunar and substitute days are data: add them to this list, or pass a table.
    """
    return [dt.date(y, m, d) for y in sorted(set(years)) for m, d in FIXED_HOLIDAYS]


# More distinct days than 250 years have are no holiday calendar.
_CALENDAR_DAYS = 366 * 250


def holiday_dates(holidays: DataFrame | Iterable[dt.date]) -> list[dt.date]:
    """Distinct holiday dates; of a table, its ``date`` column.

    A calendar has at most 366 days a year, so the dates go into the plan as a constant
    set and no join is needed.
    """
    if not isinstance(holidays, DataFrame):
        return sorted(set(holidays))
    days = holidays.select(calendar_date(c("date"), type_of(holidays, "date")).alias("d"))
    rows = days.where("d is not null").distinct().limit(_CALENDAR_DAYS + 1).collect()
    if len(rows) > _CALENDAR_DAYS:
        raise ValueError("the holiday table has more days than a calendar")
    return sorted(row.d for row in rows)


def _off(day: Column, holidays: DataFrame | Iterable[dt.date]) -> Column:
    dates = holiday_dates(holidays)
    return day.isin(dates) if dates else F.lit(False)


def day_type2(
    df: DataFrame,
    holidays: DataFrame | Iterable[dt.date],
    column: str = "date",
    out: str = "day_type",
) -> DataFrame:
    """``holiday`` on weekends and public holidays, else ``workday``.

    A date that cannot be read counts as a workday.
    """
    if column not in df.columns:
        return df
    day = calendar_date(c(column), type_of(df, column))
    return df.withColumn(
        out,
        F.when(is_weekend(day) | _off(day, holidays), F.lit("holiday")).otherwise("workday"),
    )


def day_type3(
    df: DataFrame,
    holidays: DataFrame | Iterable[dt.date],
    column: str = "txn_date",
    out: str = "day_type",
) -> DataFrame:
    """``weekend`` before ``holiday`` before ``weekday``; NULL without a readable date."""
    if column not in df.columns:
        return df
    day = calendar_date(c(column), type_of(df, column))
    return df.withColumn(
        out,
        F.when(is_weekend(day), F.lit("weekend"))
        .when(_off(day, holidays), F.lit("holiday"))
        .when(day.isNotNull(), F.lit("weekday")),
    )
