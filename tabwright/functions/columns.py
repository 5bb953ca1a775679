"""Looking up columns by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType)
NUMBERS = INTEGERS + FLOATS + (T.DecimalType,)
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def c(name: str) -> Column:
    """Column by exact name, dots and back-quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that exist, in the given order, each once."""
    have = set(df.columns)
    return [name for name in dict.fromkeys(names) if name in have]


def require(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"required columns not found: {', '.join(missing)}")


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(type_of(df, name), FLOATS)


def spare_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use yet."""
    name = stem
    while name in df.columns:
        name = "_" + name
    return name


def missing(df: DataFrame, name: str) -> Column:
    """True where the value is NULL or, for floats, NaN."""
    if is_float(df, name):
        return c(name).isNull() | F.isnan(c(name))
    return c(name).isNull()


def order_struct(names: Iterable[str]) -> Column:
    """One comparable value for several columns: ascending, nulls last."""
    parts = []
    for i, name in enumerate(names):
        parts += [c(name).isNull().alias(f"n{i}"), c(name).alias(f"v{i}")]
    return F.struct(*parts)
