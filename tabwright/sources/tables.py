"""Tables and reports on disk."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import FLOATS, c
from tabwright.functions.hashing import row_fingerprint
from tabwright.sources.shared import listed, remove


def fold_nan(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NaN becomes NULL in the given float columns (all of them by default)."""
    wanted = set(df.columns if columns is None else columns)
    out = []
    for field in df.schema:
        col = c(field.name)
        if field.name in wanted and isinstance(field.dataType, FLOATS):
            col = F.when(~F.isnan(col), col).alias(field.name)
        out.append(col)
    return df.select(*out)


def read_table(
    spark: SparkSession, path: str, nan_is_null: bool | Iterable[str] = True
) -> DataFrame:
    """Read a Parquet table; stop when it has no rows.

    Missing values are NULL from here on. Turning NaN into NULL keeps a filter on that
    float column from being pushed to the file; pass ``False`` or the list of columns
    that can hold NaN when the rest is known to be clean.
    """
    df = spark.read.parquet(path)
    if df.isEmpty():
        raise ValueError(f"table is empty: {path}")
    if nan_is_null is True:
        return fold_nan(df)
    return fold_nan(df, nan_is_null) if nan_is_null else df


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_report(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a report as UTF-8 JSON lines; NULL fields are kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_splits(
    df: DataFrame, path: str, split: str = "split", mode: str = "errorifexists"
) -> None:
    """One folder of Parquet files per split, so a reader of one split skips the rest."""
    df.write.mode(mode).option("compression", "zstd").partitionBy(split).parquet(path)


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and a sum over row hashes: equal for equal rows in any order."""
    return df.select(row_fingerprint(df).alias("h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0))
        .cast("string")
        .alias("fingerprint"),
    )


def _manifest(spark: SparkSession, path: str) -> dict | None:
    try:
        rows = spark.read.text(f"{path}/manifest").orderBy(F.desc("at")).take(1)
    except AnalysisException:
        return None
    return json.loads(rows[0].value) if rows else None


def materialize_once(
    df: DataFrame,
    path: str,
    source: str,
    label: str | None = None,
    rows_per_file: int = 1_000_000,
    make: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, bool]:
    """Write ``df`` to ``path`` unless the same rows from the same source are there.

    With ``make`` what it gives of ``df`` is written, and ``df`` still tells whether that
    is there already, so costly work is not done twice. ``source`` should then name the
    settings of ``make`` as well. Returns the written table and whether it was written now. Rows with other column
    names or types, or another ``label``, are not the same. Data goes to a new folder
    first and then a new manifest next to the old ones, of which the newest counts, so a
    run that dies half-way leaves the earlier copy valid. Once the new copy counts, all
    but it and the one before (which may still be read) are removed. The manifest also
    holds the number of classes of ``label``.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    now = table_fingerprint(df).first()
    before = _manifest(spark, path)
    schema = df.schema.jsonValue()
    same = ("fingerprint", "rows", "source", "schema", "label")
    found = {"fingerprint": now["fingerprint"], "rows": now["rows"], "source": source, "schema": schema, "label": label}
    if before and all(before.get(k) == found[k] for k in same):
        return spark.read.parquet(before["data"]), False
    data = f"{path}/data-{time.time_ns()}"
    (make(df) if make else df).write.option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").parquet(data)
    written = spark.read.parquet(data)
    classes = written.select(label).distinct().count() if label else None
    manifest = {
        **found,
        "data": data,
        "num_classes": classes,
    }
    # A folder of its own: the earlier manifest stays until this one is complete.
    text_rows(spark, manifest).coalesce(1).write.text(f"{path}/manifest/at={time.time_ns()}")
    used = {data, before["data"] if before else data}
    used = {p.rsplit("/", 1)[1] for p in used}
    old = [p for p in listed(spark, path) if p.rsplit("/", 1)[1].startswith("data-") and p.rsplit("/", 1)[1] not in used]
    remove(spark, [*old, *listed(spark, f"{path}/manifest")[:-2]])
    return written, True


def read_manifest(spark: SparkSession, path: str) -> dict:
    manifest = _manifest(spark, path.rstrip("/"))
    if manifest is None:
        raise ValueError(f"nothing materialised at {path}")
    return manifest


def text_rows(spark: SparkSession, record: dict) -> DataFrame:
    """A one-row table holding ``record`` as JSON text."""
    return spark.createDataFrame([(json.dumps(record, ensure_ascii=False),)], "value string")

