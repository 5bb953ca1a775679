"""The final model input as one folder: splits, metadata and reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tabwright.operators.profile import split_stats
from tabwright.sources.tables import text_rows, write_report, write_splits


#: A package lists its splits in one record.
MOST_SPLITS = 1000


def package_dataset(
    df: DataFrame,
    path: str,
    info: Mapping[str, Any],
    tables: Mapping[str, DataFrame] | None = None,
    split: str = "split",
    version: str = "1.0.0",
) -> DataFrame:
    """Write a package and return rows and share per split.

    ``data/split=...`` has the rows, ``info`` one JSON record (settings, counts per
    split, version, time), ``tables/<name>`` each metadata table - the label mapping and
    the group parameters are tables and stay tables, however many rows they have.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    write_splits(df, f"{path}/data", split)
    stats = split_stats(spark.read.parquet(f"{path}/data"), split)
    rows = stats.limit(MOST_SPLITS + 1).collect()
    if len(rows) > MOST_SPLITS:
        raise ValueError(f"{split} has more than {MOST_SPLITS} values and names no splits")
    sizes = {row["split"]: {"rows": row["rows"], "ratio": row["ratio"]} for row in rows}
    record = {
        **info,
        "package_version": version,
        "created_at": dt.datetime.now(dt.UTC).isoformat(),
        "splits": sizes,
    }
    for name, table in (tables or {}).items():
        write_report(table, f"{path}/tables/{name}")
    text_rows(spark, record).coalesce(1).write.text(f"{path}/info")
    return stats


def read_package(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """The rows of a package, or of one split of it."""
    df = spark.read.parquet(f"{path.rstrip('/')}/data")
    return df if split is None else df.where(df["split"] == split)
