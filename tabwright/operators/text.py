"""Rows to text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.fixed_values import MISSING_PATTERNS, MISSING_TEXT, MISSING_TOKEN
from tabwright.functions.columns import c, is_float, present, require, type_of
from tabwright.functions.dates import calendar_date
from tabwright.functions.numbers import number_text, to_double
from tabwright.functions.text import amount_scientific, fill_missing, join_fields
from tabwright.sources.shared import settle

# Columns that are never part of the text unless they are named.
_NO_TEXT = ("labels", "split")


def text_columns_of(
    df: DataFrame, columns: Sequence[str] | None = None, label: str = "acct_code"
) -> list[str]:
    """The named columns, or all but the label and its id."""
    if columns:
        require(df, *columns)
        return list(columns)
    return [n for n in df.columns if n != label and n not in _NO_TEXT]


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[n].alias(n) if n in new else c(n) for n in df.columns])


def format_dates(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """YYYYMMDD to ``YYYY-MM-DD`` text; what is no date becomes NULL."""
    names = [n for n in df.columns if "date" in n.lower()] if columns is None else present(df, columns)
    return _replace(
        df, {n: calendar_date(c(n), type_of(df, n)).cast("string") for n in names}
    )


def format_amounts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Amounts as ``sign=..| mant=..| exponent=..``; what is no number becomes NULL."""
    names = [n for n in df.columns if "amount" in n.lower()] if columns is None else present(df, columns)
    return _replace(df, {n: amount_scientific(to_double(c(n), type_of(df, n))) for n in names})


def _printed(df: DataFrame, name: str) -> Column:
    return number_text(c(name), type_of(df, name)) if is_float(df, name) else c(name).cast("string")


def fill_missing_text(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    spellings: Sequence[str] = tuple(MISSING_TEXT),
    token: str = MISSING_TOKEN,
) -> DataFrame:
    """Text in every column, with the token for NULL and missing-value spellings."""
    names = df.columns if columns is None else present(df, columns)
    return _replace(df, {n: fill_missing(_printed(df, n), spellings, token) for n in names})


def prepare_text_fields(
    df: DataFrame, columns: Sequence[str] | None = None, label: str = "acct_code"
) -> DataFrame:
    """Dates, amounts and missing values of the text columns as text, by column name."""
    names = text_columns_of(df, columns, label)
    dates = [n for n in names if "date" in n.lower()]
    amounts = [n for n in names if "amount" in n.lower() and n not in dates]
    return fill_missing_text(format_amounts(format_dates(df, dates), amounts), names)


def serialize_rows(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    separator: str = ", ",
    key_value_separator: str = ": ",
    include_column_names: bool = True,
    label: str = "acct_code",
    keep: Sequence[str] = ("split", "labels"),
) -> DataFrame:
    """Join prepared text columns to ``text``; only ``keep`` stays next to it."""
    names = text_columns_of(df, columns, label)
    values = [F.coalesce(c(n).cast("string"), F.lit(MISSING_TOKEN)) for n in names]
    text = join_fields(names, values, separator, key_value_separator, include_column_names)
    return df.select(*[c(n) for n in present(df, keep)], text.alias("text"))


def _feature_names(df: DataFrame, features: Sequence[str] | None, target: str) -> list[str]:
    return present(df, features or []) or [n for n in df.columns if n != target and n not in _NO_TEXT]


def serialize_rows_patterns(
    df: DataFrame,
    target: str,
    features: Sequence[str] | None = None,
    separator: str = "^ ",
    key_value_separator: str = ":",
    include_column_names: bool = True,
    replacement: str = "None",
    patterns: Sequence[str] = tuple(MISSING_PATTERNS),
    keep: Sequence[str] = ("split", "labels"),
) -> DataFrame:
    """Like ``serialize_rows`` on raw columns: whole floats without ".0", any of the
    patterns replaced. Features that do not exist are skipped; if none exists, all
    columns but the target are used. Adds ``original_labels``.
    """
    names = _feature_names(df, features, target)
    values = [fill_missing(_printed(df, n), patterns, replacement) for n in names]
    text = join_fields(names, values, separator, key_value_separator, include_column_names)
    original = (
        c(target).cast("string") if target in df.columns else F.lit("UNKNOWN")
    )
    return df.select(
        *[c(n) for n in present(df, keep)], text.alias("text"), original.alias("original_labels")
    )


def serialize_rows_strict(
    df: DataFrame,
    target: str,
    features: Sequence[str] | None = None,
    separator: str = "^ ",
    key_value_separator: str = ":",
    include_column_names: bool = True,
    replacement: str = "None",
    keep: Sequence[str] = ("split", "labels"),
) -> DataFrame:
    """``serialize_rows_patterns`` for which only NULL and the empty text are missing."""
    return serialize_rows_patterns(
        df, target, features, separator, key_value_separator, include_column_names,
        replacement, [""], keep,
    )


def text_length_stats(df: DataFrame, text: str = "text", split: str = "split") -> DataFrame:
    """Rows, mean and longest text per split, in characters."""
    size = F.length(c(text))
    return df.groupBy(c(split).alias("split")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(size).alias("avg_chars"),
        F.max(size).alias("max_chars"),
    )


def text_length_histogram(df: DataFrame, text: str = "text", bins: int = 50) -> DataFrame:
    """Rows in equal-width bins between the shortest and the longest text.

    A bin holds its lower end, the last one both ends. Empty bins have no row.
    """
    lengths = settle(
        df.where(c(text).isNotNull())
        .groupBy(F.length(c(text)).alias("chars"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    low, high = lengths.agg(F.min("chars"), F.max("chars")).first()
    if low is None:
        low = high = 0
    width = (high - low) / bins or 1.0
    place = F.least(F.floor((F.col("chars") - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    return (
        lengths.groupBy(place.cast("int").alias("bin"))
        .agg(F.sum("n").alias("rows"))
        .select(
            "bin",
            (F.lit(float(low)) + F.col("bin") * F.lit(width)).alias("from_chars"),
            (F.lit(float(low)) + (F.col("bin") + 1) * F.lit(width)).alias("to_chars"),
            "rows",
        )
    )
