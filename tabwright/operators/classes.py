"""Rows per class of a table, counted and written once for all that needs them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import c, require
from tabwright.sources.shared import settle_with

#: Texts that look like placeholders of label slots.
PLACEHOLDER = r"^dummy_([1-9]\d{0,8})$"


@dataclass(frozen=True)
class ClassTable:
    """One row per class as a written table, with its totals.

    ``table`` has the label column and ``count``. Filters of small classes, label slots,
    the shares of samples and splits and the checks whether they are possible all read
    this, so that a plan counts its classes once.
    """

    label: str
    table: DataFrame
    rows: int
    classes: int
    smallest: int
    unlabelled: int = 0
    placeholders: int = 0

    @property
    def named(self) -> int:
        """Classes that have a label."""
        return self.classes - (self.unlabelled > 0)


def _facts(label: str, kept, suffix: str = "") -> dict:
    spelled = c(label).cast("string").rlike(PLACEHOLDER)
    return {
        f"rows{suffix}": F.sum(F.when(kept, F.col("count"))),
        f"classes{suffix}": F.count_if(kept),
        f"smallest{suffix}": F.min(F.when(kept, F.col("count"))),
        f"unlabelled{suffix}": F.sum(F.when(kept & c(label).isNull(), F.col("count"))),
        f"placeholders{suffix}": F.count_if(kept & F.coalesce(spelled, F.lit(False))),
    }


def _table(label: str, table: DataFrame, facts: dict, suffix: str = "") -> ClassTable:
    names = ("rows", "classes", "smallest", "unlabelled", "placeholders")
    return ClassTable(label, table, *[facts[n + suffix] or 0 for n in names])


def class_table(df: DataFrame, label: str) -> ClassTable:
    """All classes; rows without a label are a class of their own."""
    return class_tables(df, label, 1)[0]


def class_tables(df: DataFrame, label: str, least: int) -> tuple[ClassTable, ClassTable]:
    """All classes, and those with a label and at least ``least`` rows, from one count."""
    require(df, label)
    counts = df.groupBy(c(label)).agg(F.count(F.lit(1)).alias("count"))
    return counted_classes(counts, label, least)


def counted_classes(counts: DataFrame, label: str, least: int = 1) -> tuple[ClassTable, ClassTable]:
    """The same from a table of ``count`` per label."""
    kept = c(label).isNotNull() & (F.col("count") >= least)
    table, facts = settle_with(counts, **_facts(label, F.lit(True)), **_facts(label, kept, "_kept"))
    return _table(label, table, facts), _table(label, table.where(kept), facts, "_kept")


def keep_classes(df: DataFrame, classes: ClassTable) -> DataFrame:
    """The rows whose class is in the table."""
    label = classes.label
    return df.join(classes.table.select(c(label)), on=label, how="left_semi").select(
        *[c(n) for n in df.columns]
    )
