"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tabwright.sources.shared import settle

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "[\\x20\\x09-\\x0D]+"
_BLANK_CHARS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANK_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANKS)
    )


def word_count(text: Column) -> Column:
    """How many words a text has, as a bigint."""
    return F.size(words_of(text)).cast("bigint")


def crc32_of_id(column: Column) -> Column:
    """CRC-32 of the id written as text; 0 for NULL."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")), F.lit(0).cast("bigint"))


def numbered(df: DataFrame, parts: Sequence[str], bucket: str, order: Sequence[Column], weight: Column, name: str) -> DataFrame:
    """Add to each row the sum of ``weight`` over the rows of its part before it.

    Rows of a part are ordered by ``bucket``, then ``order``. Sums run inside one
    (part, bucket) at a time and are then moved by the sums of the buckets before it, so
    no task gets more than one bucket of a part. ``df`` should be settled: it is read
    twice.
    """
    keys = [F.col(p) for p in parts]
    inside = W.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, W.currentRow)
    starts = (
        df.groupBy(*parts, bucket)
        .agg(F.sum(weight).alias("__sum"))
        .withColumn("__start", F.sum("__sum").over(before) - F.col("__sum"))
        .select(*[F.col(p).alias(f"__p{i}") for i, p in enumerate(parts)], F.col(bucket).alias("__pb"), "__start")
    )
    same = F.col(bucket).eqNullSafe(F.col("__pb"))
    for i, p in enumerate(parts):
        same &= F.col(p).eqNullSafe(F.col(f"__p{i}"))
    return (
        df.withColumn("__inside", F.sum(weight).over(inside) - weight)
        .join(starts, same)
        .withColumn(name, F.col("__inside") + F.col("__start"))
        .drop("__inside", "__start", "__pb", *[f"__p{i}" for i in range(len(parts))])
    )


def runs_of_bytes(column: pa.Array, most: int, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Ranges (first, one past the last) of a binary column with at most ``most`` bytes and
    ``rows`` rows, or one row. Python values of a whole Arrow batch may not fit a task."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and (total + size > most or i - begin == rows):
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def schema_like(df: DataFrame, *more: T.StructField) -> T.StructType:
    return T.StructType([*df.schema.fields, *more])


__all__ = ["BLANKS", "crc32_of_id", "documents", "numbered", "runs_of_bytes", "schema_like", "settle", "word_count", "words_of"]
