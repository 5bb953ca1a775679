"""Samples of an exact size, the same for a seed whatever the partitioning.

Rows are taken in the order of a seeded hash of their key; without one all columns
together are the key. Where the last rows share a key, as copies of a row do, as many of
them are taken as fit, so that sizes are exact for any table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import c, require
from tabwright.operators.ordering import TASK_ROWS, hash_cuts, mark_cuts
from tabwright.operators.rows import class_counts
from tabwright.sources.shared import settle_with

Key = Sequence[str] | str | None


def take_in_hash_order(
    df: DataFrame,
    quotas: DataFrame,
    strata: Sequence[str],
    key: Key,
    seed: int,
    task_rows: int = TASK_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """The first ``quota`` rows of every stratum; ``quotas`` has strata and ``quota``."""
    named = quotas.withColumn("cut", F.lit("keep"))
    ends = hash_cuts(df, named, strata, key, seed, ["keep"], task_rows, rows)
    marked = mark_cuts(df, ends, strata, key, seed, {"keep": "__keep"})
    return marked.where("__keep").drop("__keep")


def _one_quota(df: DataFrame, rows: int) -> DataFrame:
    return df.sparkSession.range(1).select(F.lit(rows).cast("bigint").alias("quota"))


def _quotas(counts: DataFrame, by: str, quota: Column) -> tuple[DataFrame, int]:
    """Rows to take per stratum, written, and the rows of all strata."""
    quotas, facts = settle_with(counts.select(c(by), "count", quota.alias("quota")), rows=F.sum("count"))
    return quotas.drop("count"), facts["rows"] or 0


def sample_stratified(
    df: DataFrame,
    label: str,
    fraction: float,
    seed: int = 42,
    key: Key = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``round(fraction * n)`` rows of each label, halves to even; no rows without a label."""
    require(df, label)
    if not 0 < fraction < 1:
        return df
    quota = F.rint(F.col("count") * F.lit(float(fraction))).cast("bigint")
    labelled = df.where(c(label).isNotNull())
    quotas, rows = _quotas(class_counts(df, label), label, quota)
    return take_in_hash_order(labelled, quotas, [label], key, seed, task_rows, rows)


def sample_random(
    df: DataFrame, fraction: float, seed: int = 42, key: Key = None, task_rows: int = TASK_ROWS
) -> DataFrame:
    """``int(n * fraction)`` rows."""
    if not 0 < fraction < 1:
        return df
    total = df.count()
    return take_in_hash_order(df, _one_quota(df, int(total * fraction)), [], key, seed, task_rows, total)


def sample_size(
    df: DataFrame, rows: int, seed: int = 42, key: Key = None, task_rows: int = TASK_ROWS
) -> DataFrame:
    """``rows`` rows, or all of a smaller table."""
    total = df.count()
    return take_in_hash_order(df, _one_quota(df, min(rows, total)), [], key, seed, task_rows, total)


def _split_sizes(df: DataFrame, split: str) -> DataFrame:
    return df.groupBy(c(split)).agg(F.count(F.lit(1)).alias("count"))


def sample_rows(
    df: DataFrame,
    rows: int,
    split: str = "split",
    seed: int = 42,
    key: Key = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``rows`` rows of every split for inspection, or all of a smaller split."""
    quotas, total = _quotas(_split_sizes(df, split), split, F.least(F.col("count"), F.lit(rows).cast("bigint")))
    return take_in_hash_order(df, quotas, [split], key, seed, task_rows, total)


def subset_splits(
    df: DataFrame,
    ratio: float,
    split: str = "split",
    seed: int = 42,
    key: Key = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``int(n * ratio)`` rows of every split; a ratio of 1 or more leaves all."""
    if ratio >= 1:
        return df
    quotas, total = _quotas(_split_sizes(df, split), split, F.floor(F.col("count") * F.lit(float(ratio))))
    return take_in_hash_order(df, quotas, [split], key, seed, task_rows, total)
