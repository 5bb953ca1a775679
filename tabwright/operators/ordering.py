"""Numbering rows and finding the n-th row of a group, without one-task sorts of data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.columns import c
from tabwright.functions.hashing import row_fingerprint, row_key, seeded_hash
from tabwright.sources.shared import settle, settle_with

# A task may rank this many narrow rows; more are split up first.
TASK_ROWS = 1_000_000


def number_rows(
    df: DataFrame,
    order_by: Sequence[Column],
    name: str = "id",
    rows: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given order (which must have no ties).

    Meant for derived tables such as the distinct labels. Up to ``task_rows`` rows one
    task numbers them; above that the rows are range-partitioned, each range is numbered
    for itself and shifted by the rows of the ranges before it. Pass ``rows`` when the
    table is written already and its size is known.
    """
    if rows is None:
        df = settle(df)
        rows = df.count()
    if rows <= task_rows:
        place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order_by))
        return df.withColumn(name, (place - 1).cast("int"))
    ranged = settle(df.repartitionByRange(*order_by).withColumn("__r", F.spark_partition_id()))
    sizes = ranged.groupBy("__r").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.partitionBy(F.lit(0)).orderBy("__r")) - F.col("__n")
    shift = settle(sizes.select("__r", before.alias("__before")))
    place = F.row_number().over(W.partitionBy("__r").orderBy(*order_by)) - 1
    return (
        ranged.withColumn(name, place)
        .join(shift, "__r")
        .withColumn(name, (F.col(name) + F.col("__before")).cast("int"))
        .select(*[c(n) for n in df.columns], name)
    )


# --- cutting groups in hash order -------------------------------------------------------


def _locate(counts: DataFrame, group: Sequence[str], bucket: str, quota: Column) -> DataFrame:
    """The bucket that holds the quota-th row, and how far into the bucket it lies."""
    upto = W.partitionBy(*group).orderBy(bucket)
    kept = [n for n in ("__n", "__alike") if n in counts.columns]
    return (
        counts.withColumn("__upto", F.sum("__n").over(upto))
        .withColumn("__want", quota)
        .where(
            (F.col("__upto") >= F.col("__want")) & (F.col("__upto") - F.col("__n") < F.col("__want"))
        )
        .select(
            *group,
            F.col(bucket).alias("__bucket"),
            *kept,
            (F.col("__want") - F.col("__upto") + F.col("__n")).alias("__want"),
        )
    )


@dataclass(frozen=True)
class Ends:
    """Where cuts end per stratum, as a written table; ``shared``: some run through copies."""

    table: DataFrame
    shared: bool


def hash_cuts(
    df: DataFrame,
    quotas: DataFrame,
    strata: Sequence[str],
    key: Sequence[str] | str | None,
    seed: int,
    cuts: Sequence[str],
    task_rows: int = TASK_ROWS,
    rows: int | None = None,
) -> Ends:
    """Where the first ``quota`` rows of each stratum end in hash order.

    ``quotas`` has the strata columns, ``cut`` (a name) and ``quota`` (a row count).
    Returns the strata columns and, named like each cut, the hash ``h`` and key ``k`` of
    the last row inside it, with how many rows have that key (``copies``) and how many of
    them are inside (``take``).

    Rows are never ranked stratum by stratum. They are counted by the first hex digits
    of their hash (a count that each task does before the shuffle); the running sum over
    those few counters names the one bucket that holds the cut. Buckets that are still
    too large for a task are counted by three more digits, unless all their rows have one
    hash. In the last bucket the different keys are counted, so that a task never meets
    the copies of a row one by one. A table known to have no more than ``task_rows``
    ``rows`` is ranked at once.
    """
    spark_key = row_key(df, key)
    group = [f"__s{i}" for i in range(len(strata))]
    named = [c(s).alias(g) for s, g in zip(strata, group, strict=True)]
    base = df.select(
        *named, seeded_hash(seed, spark_key).alias("__h"), spark_key.alias("__k")
    )
    wanted = quotas.where(F.col("quota") > 0).select(
        *named, F.col("cut").alias("__cut"), F.col("quota").cast("bigint").alias("__quota")
    )
    if rows is not None and rows <= task_rows:
        return _ends(_rank(base, wanted, group), group, strata, cuts)
    digits = 3
    count = F.count(F.lit(1)).alias("__n")
    counts = base.groupBy(*group, F.substring("__h", 1, digits).alias("__b")).agg(count)
    spread = attach(counts, wanted, group)
    targets = settle(_locate(spread, [*group, "__cut"], "__b", F.col("__quota")))
    large = F.col("__n") > task_rows
    while digits < 30 and targets.where(large).limit(1).count():
        digits += 3
        finer = (
            _inside(base, targets, group)
            .groupBy(*group, "__cut", "__want", F.substring("__h", 1, digits).alias("__b"))
            .agg(count, (F.min("__h") == F.max("__h")).alias("__alike"))
        )
        targets = settle(_locate(finer, [*group, "__cut"], "__b", F.col("__want")))
        large = (F.col("__n") > task_rows) & ~F.col("__alike")
    keys = (
        _inside(base, targets, group)
        .groupBy(*group, "__cut", "__want", F.struct("__h", "__k").alias("__key"))
        .agg(count)
    )
    return _ends(_locate(keys, [*group, "__cut"], "__key", F.col("__want")), group, strata, cuts)


def _rank(base: DataFrame, wanted: DataFrame, group: Sequence[str]) -> DataFrame:
    """The last keys of all cuts like ``_locate``, by the places of the rows."""
    part = group or [F.lit(0)]
    order = W.partitionBy(*part).orderBy("__h", "__k")
    placed = base.select(
        "*",
        F.row_number().over(order).alias("__place"),
        F.rank().over(order).alias("__first"),
        F.count(F.lit(1)).over(W.partitionBy(*part, "__h", "__k")).alias("__n"),
    )
    return attach(placed, wanted, group).where(F.col("__place") == F.col("__quota")).select(
        *group,
        "__cut",
        F.struct("__h", "__k").alias("__bucket"),
        "__n",
        (F.col("__place") - F.col("__first") + 1).cast("bigint").alias("__want"),
    )


def _ends(found: DataFrame, group: Sequence[str], strata: Sequence[str], cuts: Sequence[str]) -> Ends:
    last = F.struct(
        F.col("__bucket.__h").alias("h"),
        F.col("__bucket.__k").alias("k"),
        F.col("__want").alias("take"),
        F.col("__n").alias("copies"),
    )
    table, facts = settle_with(
        found.groupBy(*[F.col(g).alias(s) for g, s in zip(group, strata, strict=True)])
        .agg(*[F.max(F.when(F.col("__cut") == cut, last)).alias(cut) for cut in cuts]),
        shared=F.max(reduce(or_, [F.coalesce(F.col(cut)["take"] < F.col(cut)["copies"], F.lit(False)) for cut in cuts])),
    )
    return Ends(table, bool(facts["shared"]))


def _inside(base: DataFrame, targets: DataFrame, group: Sequence[str]) -> DataFrame:
    bucket = targets.select(*group, "__cut", "__want", "__bucket")
    return attach(base, bucket, group).where(F.col("__h").startswith(F.col("__bucket")))


def attach(left: DataFrame, right: DataFrame, group: Sequence[str]) -> DataFrame:
    """Give every left row the right rows of its group.

    Without group columns the right side is a handful of rows (one per cut), which are
    written into the plan as constants.
    """
    if group:
        return join_null_safe(left, right, group)
    rows = [
        F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in right.schema])
        for row in right.collect()
    ]
    if not rows:
        return left.where(F.lit(False)).select(
            "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema]
        )
    return left.select("*", F.inline(F.array(*rows)))


def join_null_safe(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which NULL matches NULL; the right side's key columns are left out."""
    renamed = right.select(
        *[c(n).alias(f"__j{i}") for i, n in enumerate(on)],
        *[c(n) for n in right.columns if n not in on],
    )
    tests = [c(n).eqNullSafe(F.col(f"__j{i}")) for i, n in enumerate(on)]
    return left.join(renamed, tests, how).drop(*[f"__j{i}" for i in range(len(on))])


def mark_cuts(
    df: DataFrame,
    ends: Ends,
    strata: Sequence[str],
    key: Sequence[str] | str | None,
    seed: int,
    names: Mapping[str, str],
) -> DataFrame:
    """Add one true/false column per cut (cut name -> column name): is the row inside?

    ``ends`` comes from ``hash_cuts``. A single pass: every row meets the ends of its
    stratum, a table with one row per stratum; without strata the ends are constants.
    Where a cut goes through rows that share one key, exactly ``take`` of them are inside:
    the first in the hash order of all columns, and any of those that are the same in all
    columns.
    """
    spark_key = row_key(df, key)
    pair = F.struct(seeded_hash(seed, spark_key).alias("h"), spark_key.alias("k"))
    shared_ends, ends = ends.shared, ends.table
    if strata:
        renamed = ends.select(
            *[c(s) for s in strata],
            *[F.col(cut).alias(f"__end_{cut}") for cut in names],
        )
        met = join_null_safe(df, renamed, strata, "left")
        last = {cut: F.col(f"__end_{cut}") for cut in names}
    else:
        row = ends.first()
        met = df
        last = {
            cut: F.struct(*[F.lit(v).alias(n) for n, v in row[cut].asDict().items()])
            if row and row[cut]
            else F.lit(None).cast(ends.schema[cut].dataType)
            for cut in names
        }
    inside = {
        cut: F.coalesce(pair <= F.struct(end["h"].alias("h"), end["k"].alias("k")), F.lit(False))
        for cut, end in last.items()
    }
    columns = [c(n) for n in df.columns]
    if not shared_ends:
        return met.select(*columns, *[inside[cut].alias(name) for cut, name in names.items()])

    def at(end: Column) -> Column:
        same = (pair["h"] == end["h"]) & (pair["k"] == end["k"])
        return F.coalesce(same & (end["take"] < end["copies"]), F.lit(False))

    edge = reduce(or_, [at(end) for end in last.values()])
    clear = met.where(~edge).select(*columns, *[inside[cut].alias(name) for cut, name in names.items()])
    shared = met.where(edge).select(
        *columns,
        pair["h"].alias("__edge"),
        *[
            F.struct(inside[cut].alias("inside"), at(end).alias("at"), end["take"].alias("take")).alias(f"__at_{cut}")
            for cut, end in last.items()
        ],
    )
    by = [*strata, "__edge"]
    covered = {*strata, *([key] if isinstance(key, str) else key or df.columns)}
    if covered.issuperset(df.columns):
        counted = _copies_in_order(shared, by)
        decided = {cut: F.col("__place") < F.col(f"__at_{cut}")["take"] for cut in names}
    else:
        # The key does not tell these rows apart; all columns do, as far as they differ.
        quotas = reduce(
            DataFrame.unionByName,
            [
                ends.where(F.col(cut)["take"] < F.col(cut)["copies"]).select(
                    *[c(s) for s in strata],
                    F.col(cut)["h"].alias("__edge"),
                    F.lit(cut).alias("cut"),
                    F.col(cut)["take"].alias("quota"),
                )
                for cut in names
            ],
        )
        rest = [n for n in shared.columns if n not in by]
        finer = hash_cuts(shared, quotas, by, rest, seed, list(names))
        marks = {cut: f"__mark_{cut}" for cut in names}
        counted = mark_cuts(shared, finer, by, rest, seed, marks)
        decided = {cut: F.col(mark) for cut, mark in marks.items()}
    return clear.unionByName(
        counted.select(
            *columns,
            *[
                F.when(F.col(f"__at_{cut}")["at"], decided[cut]).otherwise(F.col(f"__at_{cut}")["inside"]).alias(name)
                for cut, name in names.items()
            ],
        )
    )


def _copies_in_order(df: DataFrame, by: Sequence[str], step: int = 10_000) -> DataFrame:
    """Rows numbered within ``by`` from 0, in ``__place``; copies of a row follow each other.

    Copies travel as one row and their number. They become rows again in steps that are
    dealt over the tasks.
    """
    counted = df.groupBy(*[c(n) for n in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    order = W.partitionBy(*[c(n) for n in by]).orderBy(row_fingerprint(df))
    numbered = counted.withColumn("__first", F.sum("__n").over(order) - F.col("__n"))
    end = F.col("__first") + F.col("__n") - 1
    steps = numbered.withColumn("__from", F.explode(F.sequence("__first", end, F.lit(step).cast("bigint"))))
    dealt = steps.repartition("__from", *[c(n) for n in by])
    upto = F.least(F.col("__from") + (step - 1), end)
    return dealt.withColumn("__place", F.explode(F.sequence("__from", upto))).drop("__n", "__first", "__from")
