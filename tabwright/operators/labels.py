"""Labels and their ids, kept as a small table ``(label, id, is_dummy)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import c, order_struct, require
from tabwright.operators.classes import PLACEHOLDER, ClassTable
from tabwright.operators.ordering import number_rows
from tabwright.sources.shared import settle, settle_with


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    """The labels as text, without NULL, in a column ``label``."""
    return df.select(c(label).cast("string").alias("label")).where("label is not null").distinct()


def _dummies(df: DataFrame, first_id: int, end_id: int, pattern: str, start: int) -> DataFrame:
    """Placeholder rows for the ids ``first_id .. end_id - 1``."""
    ids = df.sparkSession.range(first_id, max(first_id, end_id)).withColumnRenamed("id", "n")
    number = (F.col("n") - F.lit(first_id) + F.lit(start)).cast("int")
    return ids.select(
        F.format_string(pattern, number).alias("label"),
        F.col("n").cast("int").alias("id"),
        F.lit(True).alias("is_dummy"),
    )


def label_slots(
    df: DataFrame,
    label: str,
    max_classes: int = 100,
    order_by: Sequence[str] | None = None,
    classes: ClassTable | None = None,
) -> DataFrame:
    """``max_classes`` slots; the labels fill them from id 0, ``dummy_k`` is what is left.

    Labels are numbered in label order, or by their first row in the order of the
    ``order_by`` columns. More labels than slots are an error. With ``classes`` of the
    same rows the labels are not looked for again.
    """
    require(df, label)
    if classes is not None and not order_by and classes.label == label and not classes.placeholders:
        real = classes.named
        _fitting(real, max_classes)
        numbered = number_rows(distinct_labels(classes.table, label), [F.col("label")], rows=real)
        return _filled(numbered, real, max_classes)
    text = c(label).cast("string").alias("label")
    rows = df.where(c(label).isNotNull())
    if order_by:
        found = rows.groupBy(text).agg(F.min(order_struct(order_by)).alias("first"))
        order = [F.col("first"), F.col("label")]
    else:
        found, order = distinct_labels(df, label), [F.col("label")]
    # A label that is spelled like a placeholder already has its slot.
    own = F.regexp_extract("label", PLACEHOLDER, 1)
    placeholder = F.when(own != "", own).cast("int") <= max_classes
    found = settle(found.where(~F.coalesce(placeholder, F.lit(False))))
    real = found.count()
    _fitting(real, max_classes)
    return _filled(number_rows(found, order, rows=real), real, max_classes)


def _fitting(real: int, slots: int) -> None:
    if real > slots:
        raise ValueError(f"{real} labels do not fit into {slots} slots; raise max_classes")


def _filled(numbered: DataFrame, real: int, slots: int) -> DataFrame:
    """The numbered labels, then placeholders up to ``slots``."""
    return numbered.select("label", "id", F.lit(False).alias("is_dummy")).unionByName(
        _dummies(numbered, real, slots, "dummy_%d", real + 1)
    )


def label_dictionary(slots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two directions: ``(label, id)`` and ``(id, label)``."""
    return slots.select("label", "id"), slots.select("id", "label")


def label_mapping_create(
    df: DataFrame, label: str, total: int = 300, prefix: str = "DUMMY_", classes: ClassTable | None = None
) -> DataFrame:
    """Labels in label order, then ``DUMMY_000, DUMMY_001, ...`` up to ``total``.

    With ``classes`` of the same rows the labels are not looked for again.
    """
    require(df, label)
    if classes is not None and classes.label == label:
        found, count = distinct_labels(classes.table, label), classes.named
    else:
        found, facts = settle_with(distinct_labels(df, label), labels=F.count(F.lit(1)))
        count = facts["labels"]
    numbered = number_rows(found, [F.col("label")], rows=count)
    return numbered.select("label", "id", F.lit(False).alias("is_dummy")).unionByName(
        _dummies(df, count, total, prefix + "%03d", 0)
    )


def new_labels(df: DataFrame, label: str, mapping: DataFrame, prefix: str = "DUMMY_") -> DataFrame:
    """The labels that the mapping does not have yet."""
    real = mapping.where(~F.col("label").startswith(prefix)).select("label")
    return distinct_labels(df, label).join(real, "label", "left_anti")


def label_mapping_update(
    df: DataFrame,
    label: str,
    mapping: DataFrame,
    total: int = 300,
    prefix: str = "DUMMY_",
    overflow: str = "grow",
) -> DataFrame:
    """Known labels keep their order, new ones follow in label order, then placeholders.

    ``overflow`` says what happens with more labels than ``total``: the mapping grows, or
    the update is refused (``error``). Adds ``is_new`` to the mapping columns.
    """
    require(df, label)
    known = mapping.where(~F.col("label").startswith(prefix)).select(
        "label", F.col("id").cast("bigint").alias("old"), F.lit(False).alias("is_new")
    )
    fresh = new_labels(df, label, mapping, prefix).select(
        "label", F.lit(None).cast("bigint").alias("old"), F.lit(True).alias("is_new")
    )
    real = settle(known.unionByName(fresh))
    count = real.count()
    if overflow == "error" and count > total:
        raise ValueError(f"{count} labels do not fit into {total} classes")
    order = [F.col("old").asc_nulls_last(), F.col("label")]
    numbered = number_rows(real, order, rows=count)
    return numbered.select("label", "id", F.lit(False).alias("is_dummy"), "is_new").unionByName(
        _dummies(df, count, total, prefix + "%03d", 0).withColumn("is_new", F.lit(False))
    )


def mapping_summary(mapping: DataFrame) -> DataFrame:
    """Classes in all, real ones and placeholders."""
    return mapping.agg(
        F.count(F.lit(1)).alias("num_classes"),
        F.count_if(~F.col("is_dummy")).alias("num_base_classes"),
        F.count_if(F.col("is_dummy")).alias("num_dummy_classes"),
    )


def encode_labels(
    df: DataFrame, slots: DataFrame, label: str, unknown_id: int = 0, out: str = "labels"
) -> DataFrame:
    """Add the id of the label; a label without an id gets ``unknown_id``.

    The default 0 is the first real label, as the ids are filled from there; pass -1 or a
    placeholder's id to keep unknown labels apart.
    """
    require(df, label)
    table = slots.select(
        F.col("label").alias("__label"), F.col("id").cast("int").alias("__id")
    )
    names = [n for n in df.columns if n != out]
    return df.join(table, c(label).cast("string") == F.col("__label"), "left").select(
        *[c(n) for n in names], F.coalesce(F.col("__id"), F.lit(unknown_id)).alias(out)
    )


def label_names(df: DataFrame, column: str = "labels") -> DataFrame:
    """``(id, label)`` of an id column that carries its label names, as written tables keep them."""
    names = df.schema[column].metadata.get("labels")
    if names is None:
        raise ValueError(f"{column} carries no label names")
    return df.sparkSession.createDataFrame(list(enumerate(names)), "id int, label string")


def with_label_names(
    df: DataFrame, slots: DataFrame, column: str = "labels", limit: int = 100_000
) -> DataFrame:
    """Put the slot names, in id order, into the metadata of the id column."""
    rows = slots.select("id", "label").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} label names do not belong into a schema")
    names = [row["label"] for row in sorted(rows, key=lambda row: row["id"])]
    return df.withMetadata(column, {"labels": names})
