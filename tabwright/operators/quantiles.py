"""Exact interpolated quantiles per group, also when a group is most of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.columns import c
from tabwright.operators.ordering import TASK_ROWS, join_null_safe
from tabwright.sources.shared import settle, settle_with


def quantile_names(probs: Sequence[float]) -> list[str]:
    return [f"q{i}" for i in range(len(probs))]


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: Column,
    probs: Sequence[float],
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Per group: the non-NULL count ``n`` and the quantiles ``q0, q1, ...``.

    Linear interpolation, like pandas and Spark's ``percentile``. ``percentile`` itself
    keeps every distinct value of a group in one aggregation buffer, so it is only used
    while no group has more than ``task_rows`` values. Otherwise:

    1. a sketch of fixed size per group gives, for each quantile, two values that
       certainly enclose it,
    2. values outside the enclosed stretches are moved to the stretch end below them
       (which changes no rank inside a stretch) and equal values are counted,
    3. only those few counted values are ranked, and the two order statistics around
       each quantile are read off. Should a stretch not hold them, which a sketch within
       its error bound rules out, all stretches are widened and read again.
    """
    keys = [c(g) for g in group]
    rows = df.select(*keys, value.cast("double").alias("__x")).where(
        F.col("__x").isNotNull() & ~F.isnan("__x")
    )
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    biggest = settle_with(sizes, biggest=F.max("n"))[1]["biggest"] or 0
    if biggest <= task_rows:
        found = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile("__x", F.array(*[F.lit(float(p)) for p in probs])).alias("__q"),
        )
        return found.select(
            *keys,
            "n",
            *[F.col("__q")[i].alias(name) for i, name in enumerate(quantile_names(probs))],
        )
    return _bracketed(rows, group, probs, biggest, task_rows)


#: Sketch errors from a quantile to each end of its stretch.
MARGIN = 3.0


def stretch_ends(probs: Sequence[float], accuracy: int, margin: float = MARGIN) -> list[float]:
    """Ranks (0 to 1, or beyond) of the two ends of each quantile's stretch."""
    return [p + side * margin / accuracy for p in probs for side in (-1, 1)]


def sketch_of(value: Column, ends: Sequence[float], accuracy: int) -> Column:
    """The sketched values at the ranks ``ends``."""
    return F.percentile_approx(value, F.array(*[F.lit(min(1.0, max(0.0, e))) for e in ends]), F.lit(accuracy))


def stretches_from(
    sketch: DataFrame, keys: Sequence[Column], probs: Sequence[float], ends: Sequence[float], whole: Column
) -> DataFrame:
    """Enclosing values ``__a0, __b0, ...`` of each quantile, out of ``__e``, ``__min`` and ``__max``.

    ``whole``: groups that are enclosed from end to end.
    """
    return sketch.select(
        *keys,
        "n",
        *[
            F.when(whole | F.lit(ends[2 * i] <= 0), F.col("__min")).otherwise(F.col("__e")[2 * i]).alias(f"__a{i}")
            for i in range(len(probs))
        ],
        *[
            F.when(whole | F.lit(ends[2 * i + 1] >= 1), F.col("__max")).otherwise(F.col("__e")[2 * i + 1]).alias(f"__b{i}")
            for i in range(len(probs))
        ],
        F.col("__min").alias("__floor"),
    )


def enclosed(met: DataFrame, keys: Sequence[Column], probs: Sequence[float], weight: Column) -> DataFrame:
    """Values ``__x`` moved to the stretch end below them and counted by ``weight``.

    ``met`` has each value with the stretches of its group; ``__own`` marks the values
    that are in a stretch and not moved.
    """
    inside = F.lit(False)
    below: list[Column] = [F.col("__floor")]
    for i in range(len(probs)):
        inside = inside | F.col("__x").between(F.col(f"__a{i}"), F.col(f"__b{i}"))
        below.append(F.when(F.col(f"__b{i}") < F.col("__x"), F.col(f"__b{i}")))
    moved = F.when(inside, F.col("__x")).otherwise(F.greatest(*below))
    return met.groupBy(*keys, "n", moved.alias("__x"), inside.alias("__own")).agg(F.sum(weight).alias("__m"))


def read_off(counted: DataFrame, group: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``n``, the quantiles, and ``__missed``: is one outside its stretch?"""
    keys = [c(g) for g in group]
    order = W.partitionBy(*keys, "n").orderBy("__x", F.desc("__own"))
    ranked = counted.withColumn("__upto", F.sum("__m").over(order))

    def order_statistic(rank: Column) -> Column:
        hit = (F.col("__upto") > rank) & (F.col("__upto") - F.col("__m") <= rank)
        return F.max(F.when(hit & F.col("__own"), F.col("__x")))

    spots = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("n") - 1)
        spots += [
            order_statistic(F.floor(position)).alias(f"__lo{i}"),
            order_statistic(F.ceil(position)).alias(f"__hi{i}"),
        ]
    found = ranked.groupBy(*keys, "n").agg(*spots)
    out, missed = [], F.lit(False)
    for i, (p, name) in enumerate(zip(probs, quantile_names(probs), strict=True)):
        position = F.lit(float(p)) * (F.col("n") - 1)
        low, high, part = F.col(f"__lo{i}"), F.col(f"__hi{i}"), position - F.floor(position)
        missed = missed | low.isNull() | high.isNull()
        out.append(
            # Equal neighbours are the quantile itself; weighting them could miss it by a bit.
            F.when((part == 0) | (low == high), low)
            .otherwise((1 - part) * low + part * high)
            .alias(name)
        )
    return found.select(*keys, "n", *out, missed.alias("__missed"))


def _bracketed(
    rows: DataFrame,
    group: Sequence[str],
    probs: Sequence[float],
    biggest: int,
    task_rows: int,
    margin: float = MARGIN,
) -> DataFrame:
    keys = [c(g) for g in group]
    # Sketch error is 1/accuracy of a group; a stretch is six errors wide. The accuracy
    # is set so that the stretches of the biggest group fit a task.
    accuracy = int(min(2_000_000, max(10_000, 12 * len(probs) * biggest / task_rows)))
    ends = stretch_ends(probs, accuracy, margin)
    sketch = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("__x").alias("__min"),
        F.max("__x").alias("__max"),
        sketch_of(F.col("__x"), ends, accuracy).alias("__e"),
    )
    # A group with no more rows than the accuracy is enclosed whole: in a larger one the
    # margin, less the sketch error, is two rows or more.
    whole = F.col("n") <= F.lit(max(accuracy, task_rows // 10)) if margin >= MARGIN else F.lit(False)
    stretches = settle(stretches_from(sketch, keys, probs, ends, whole))
    if group:
        met = join_null_safe(rows, stretches, group)
    else:
        one = stretches.first()
        met = rows.select(
            "*", *[F.lit(one[n]).alias(n) for n in stretches.columns]
        )
    found = read_off(enclosed(met, keys, probs, F.lit(1)), group, probs)
    table, facts = settle_with(found, missed=F.max("__missed"))
    if facts["missed"] and margin < 2 * accuracy:
        return _bracketed(rows, group, probs, biggest, task_rows, max(4 * margin, MARGIN))
    return table.drop("__missed")
