"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.columns import FLOATS, NUMBERS, TIMES


def _as_text(value: Column, dtype: T.DataType) -> Column:
    # A double would print as 2.0240101E7.
    if isinstance(dtype, FLOATS):
        return value.try_cast("bigint").cast("string")
    return value.cast("string")


def _eight_digits(value: Column) -> Column:
    """The size of a number if its whole part has eight digits, else NULL."""
    size = F.abs(value)
    return F.when(
        (size >= F.lit(10_000_000)) & (size < F.lit(100_000_000)), size.try_cast("int")
    )


def first_digits(value: Column, dtype: T.DataType) -> Column:
    """The first run of digits in the printed value, or NULL."""
    return F.nullif(F.regexp_extract(_as_text(value, dtype), r"(\d+)", 1), F.lit(""))


def yyyymmdd(value: Column, dtype: T.DataType) -> Column:
    """YYYYMMDD as an integer when the first digit run has exactly eight digits."""
    if isinstance(dtype, NUMBERS):
        return _eight_digits(value)
    # Cast only what is known to be a number: a try_cast that fails costs an exception.
    run = F.regexp_extract(value.cast("string"), r"^\D*(\d{8})(?:\D|$)", 1)
    return F.when(F.length(run) == 8, run).cast("int")


def calendar_date(value: Column, dtype: T.DataType) -> Column:
    """A date out of YYYYMMDD (number or text), text with dashes, slashes or dots between
    year, month and day, date or timestamp; else NULL."""
    if isinstance(dtype, TIMES):
        return value.cast("date")
    number = isinstance(dtype, NUMBERS)
    text = (_eight_digits(value) if number else value).cast("string")
    if not number:
        # 2024/01/06 and 2024.01.06 as 2024-01-06, 20240106.0 as 20240106.
        text = F.regexp_replace(text, r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})$", "$1-$2-$3")
        text = F.regexp_replace(text, r"^(\d{8})\.0+$", "$1")
    dashed = F.concat_ws(
        "-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)
    )
    spelled = F.when(F.length(text) == 8, dashed)
    if not number:
        spelled = F.when(text.contains("-"), text).otherwise(spelled)
    return spelled.try_cast("date")


def is_weekend(day: Column) -> Column:
    """Saturday or Sunday (Spark counts weekdays from Monday = 0)."""
    return F.weekday(day) >= 5


def period(day: Column, level: str) -> Column | None:
    """2024-03, 2024Q1 or 2024; None for a level that is not known."""
    if level == "month":
        return F.date_format(day, "yyyy-MM")
    if level == "quarter":
        return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))
    if level == "year":
        return F.year(day).cast("string")
    return None
