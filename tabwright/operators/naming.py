"""Column names and column selection. Plans only, no jobs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame

from tabwright.fixed_values import COLUMN_NAMES
from tabwright.functions.columns import c, present, require
from tabwright.operators.rows import drop_nulls


def standardize_columns(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Rename by map; an unknown name goes to lower case with ``_`` for space and hyphen."""
    names = COLUMN_NAMES if names is None else names
    plain = [col.lower().replace(" ", "_").replace("-", "_") for col in df.columns]
    return df.toDF(*[names.get(col, p) for col, p in zip(df.columns, plain, strict=True)])


def rename_from_mapping(
    df: DataFrame, mapping: Mapping[str, str]
) -> tuple[DataFrame, dict[str, str]]:
    """Rename by map and leave unknown names alone; also returns the renames done."""
    done = {col: mapping[col] for col in df.columns if col in mapping}
    return df.toDF(*[done.get(col, col) for col in df.columns]), done


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    gone = set(present(df, columns))
    return df.select(*[c(col) for col in df.columns if col not in gone]) if gone else df


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """The required columns that do not exist, in the given order."""
    return [name for name in required if name not in df.columns]


def select_features(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Existing features in order, then the label; no NULL label, no duplicate row."""
    require(df, label)
    columns = list(dict.fromkeys([*present(df, features), label]))
    narrow = df.select(*[c(col) for col in columns])
    return drop_nulls(narrow, [label]).dropDuplicates()


def select_feature_columns(
    df: DataFrame, target: str, features: Sequence[str] | None = None
) -> DataFrame:
    """The existing features (all but the target by default), then the target."""
    names = present(df, features) if features else [n for n in df.columns if n != target]
    if not names:
        return df
    return df.select(*[c(n) for n in dict.fromkeys([*names, *present(df, [target])])])
