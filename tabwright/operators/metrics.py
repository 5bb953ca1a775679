"""Class weights and evaluation metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.columns import c


def class_weights(
    df: DataFrame,
    label: str,
    num_labels: int,
    alpha: float,
    weight_min: float,
    weight_max: float,
    enabled: bool = True,
) -> DataFrame:
    """``(id, count, weight)`` for the ids ``0 .. num_labels - 1``; weights average 1.

    The weight of a class is ``(1 / count) ** alpha`` within the limits, an empty class
    counting as one row.
    """
    if num_labels <= 0:
        raise ValueError("num_labels must be positive")
    if weight_min > weight_max:
        raise ValueError("weight_min must be <= weight_max")
    slots = df.sparkSession.range(num_labels)
    counts = df.where(c(label).isNotNull()).groupBy(c(label).cast("bigint").alias("id")).agg(F.count(F.lit(1)).alias("count"))
    # A full join: an id beyond num_labels must not be lost.
    table = slots.join(counts, "id", "full_outer").select(
        F.col("id").cast("int").alias("id"), F.coalesce("count", F.lit(0)).alias("count")
    )
    if not enabled:
        return table.withColumn("weight", F.lit(1.0).cast("float"))
    raw = F.pow(F.lit(1.0) / F.greatest(F.col("count"), F.lit(1)), F.lit(float(alpha)))
    limited = F.greatest(F.lit(float(weight_min)), F.least(F.lit(float(weight_max)), raw))
    # The window spans the slots, one row per class of the model.
    mean = F.avg("raw").over(W.partitionBy(F.lit(0)))
    return table.withColumn("raw", limited).select(
        "id", "count", (F.col("raw") / mean).cast("float").alias("weight")
    )


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Rows per pair of true and predicted class, without the empty cells."""
    return df.groupBy(c(label).alias("label"), c(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("count")
    )


def class_metrics(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Precision, recall and F1 per class that was true or predicted; 0 where undefined."""
    cell = confusion_matrix(df, label, pred)
    hit = F.when(F.col("label") == F.col("pred"), F.col("count")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = cell.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    hit.cast("bigint").alias("tp"),
                    F.col("count").alias("support"),
                    zero.alias("predicted"),
                ),
                F.struct(
                    F.col("pred").alias("class"),
                    zero.alias("tp"),
                    zero.alias("support"),
                    F.col("count").alias("predicted"),
                ),
            )
        )
    )
    per_class = sides.groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted")
    )

    def ratio(part, whole):
        return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))

    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return per_class.select(
        "class",
        "tp",
        "support",
        "predicted",
        ratio(tp, predicted).alias("precision"),
        ratio(tp, support).alias("recall"),
        ratio(2 * tp, support + predicted).alias("f1"),
    )


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """One row: accuracy, weighted and macro F1, weighted precision and recall."""
    support = F.col("support")
    total = F.sum(support)

    def weighted(name: str):
        return (F.sum(F.col(name) * support) / total).alias(name if name != "f1" else "f1_weighted")

    return class_metrics(df, label, pred).agg(
        (F.sum("tp") / total).alias("accuracy"),
        weighted("f1"),
        F.avg("f1").alias("f1_macro"),
        weighted("precision"),
        weighted("recall"),
        total.alias("rows"),
    )


def metric_history(
    history: DataFrame, metric: str = "metric", value: str = "value"
) -> DataFrame:
    """Mean, population standard deviation and maximum of each metric over all runs."""
    return history.groupBy(c(metric).alias("metric")).agg(
        F.avg(c(value)).alias("mean"),
        F.stddev_pop(c(value)).alias("std"),
        F.max(c(value)).alias("max"),
    )


def misclassified_amount(
    df: DataFrame,
    amount: str,
    label: str = "label",
    pred: str = "pred",
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Total amount, amount on wrong predictions, its share; in all or per category.

    The category is the true label unless other columns are named; ``by=[]`` gives the
    single overall row.
    """
    wrong = ~c(label).eqNullSafe(c(pred))
    keys = [label] if by is None else list(by)
    total = F.coalesce(F.sum(c(amount)), F.lit(0.0))
    lost = F.coalesce(F.sum(F.when(wrong, c(amount))), F.lit(0.0))
    return df.groupBy(*[c(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(wrong).alias("misclassified_rows"),
        total.alias("total_amount"),
        lost.alias("misclassified_amount"),
        F.coalesce(lost / F.nullif(total, F.lit(0.0)), F.lit(0.0)).alias("misclassified_share"),
    )
