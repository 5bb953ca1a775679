"""Numeric features from group-wise parameters.

Every operator here first reduces the rows to one parameter row per group and then
evaluates one expression per row. The parameter tables are results of their own: they
are needed again when new rows are prepared.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import c, require, type_of
from tabwright.functions.numbers import to_double
from tabwright.operators.ordering import TASK_ROWS
from tabwright.operators.quantiles import exact_quantiles
from tabwright.sources.shared import settle


def _meet(df: DataFrame, table: DataFrame, group: Sequence[str], how: str = "left") -> DataFrame:
    """Join group parameters to rows. A NULL group has no parameters.

    Without a group the table has one row, which is written into the plan.
    """
    extra = [n for n in table.columns if n not in group]
    if group:
        met = df.join(table, on=list(group), how=how)
        return met.select(*[c(n) for n in df.columns], *[c(n) for n in extra])
    row = table.first()
    return df.select(
        "*",
        *[
            F.lit(None if row is None else row[n]).cast(type_of(table, n)).alias(n) for n in extra
        ],
    )


#: Share of the summed values by which a bound's own roundings can move it.
_ROUNDING = 2.0**-50


@dataclass(frozen=True)
class OutlierRule:
    """Keep values in ``[Qlo - k_lo*IQR, Qhi + k_hi*IQR]``, each side optional.

    A value that is a bound counts as inside. Often it is one: of two values, the smaller
    is ``Q25 - 0.5*IQR``. Summed in doubles such a bound can come out a last bit beyond the
    value, so each bound is moved outwards by what its roundings can amount to.
    """

    lower_quantile: float = 0.25
    upper_quantile: float = 0.75
    lower_coefficient: float = 1.5
    upper_coefficient: float = 1.5
    remove_lower: bool = True
    remove_upper: bool = True

    def bounds(
        self, df: DataFrame, group: Sequence[str], value: Column, task_rows: int
    ) -> DataFrame:
        """Per group: ``n``, ``lower`` and ``upper`` (NULL on a side that is left alone)."""
        found = exact_quantiles(
            df, group, value, [self.lower_quantile, self.upper_quantile], task_rows
        )
        q0, q1 = F.col("q0"), F.col("q1")
        spread = q1 - q0
        nothing = F.lit(None).cast("double")

        def slack(k: float) -> Column:
            # Values that are all equal are their own bounds, without rounding.
            return F.when(spread == 0, 0.0).otherwise((1 + abs(k)) * _ROUNDING * (F.abs(q0) + F.abs(q1)))

        lower, upper = self.lower_coefficient, self.upper_coefficient
        return found.select(
            *[c(g) for g in group],
            "n",
            (q0 - lower * spread - slack(lower) if self.remove_lower else nothing).alias("lower"),
            (q1 + upper * spread + slack(upper) if self.remove_upper else nothing).alias("upper"),
        )

    def normal(self, value: Column) -> Column:
        """Inside the bounds that were joined to the row."""
        test = value.isNotNull()
        if self.remove_lower:
            test = test & (value >= F.col("lower"))
        if self.remove_upper:
            test = test & (value <= F.col("upper"))
        return F.coalesce(test, F.lit(False))


def iqr_outliers(
    df: DataFrame,
    column: str,
    group_by: str | None = None,
    rule: OutlierRule = OutlierRule(),
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """The rows whose value lies inside the bounds of its group (NULL values go)."""
    require(df, column)
    group = [group_by] if group_by else []
    value = to_double(c(column), type_of(df, column))
    table = settle(rule.bounds(df, group, value, task_rows).drop("n"))
    return (
        _meet(df, table, group).where(rule.normal(value)).select(*[c(n) for n in df.columns])
    )


# --- robust standardisation -------------------------------------------------------------


def robust_parameters(
    df: DataFrame,
    group_by: str,
    column: str,
    method: str = "iqr",
    iqr_multiplier: float = 1.5,
    z_score_threshold: float = 3.0,
    percentile_range: Sequence[float] = (5, 95),
    min_group_size: int = 3,
    min_normal_size: int = 2,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Per group: ``rows, sample_count, outlier_removed, mean, std, state``.

    ``state`` is ``scaled``, ``degenerate`` (no spread) or ``skipped`` (too few rows);
    mean and std describe the absolute values that are no outliers.
    """
    require(df, group_by, column)
    group = [group_by]
    value = F.abs(to_double(c(column), type_of(df, column)))
    rows = df.where(c(group_by).isNotNull())
    size = F.count(F.lit(1)).alias("rows")
    test = F.lit(True)
    if method == "z_score":
        bounds = rows.groupBy(c(group_by)).agg(
            size, F.avg(value).alias("m0"), F.stddev_samp(value).alias("s0")
        )
        flat = F.col("s0") == 0
        test = F.abs((value - F.col("m0")) / F.nullif(F.col("s0"), F.lit(0.0))) <= z_score_threshold
    elif method in ("iqr", "percentile"):
        low, high = (0.25, 0.75) if method == "iqr" else [p / 100 for p in percentile_range]
        bounds = (
            rows.groupBy(c(group_by))
            .agg(size)
            .join(exact_quantiles(rows, group, value, [low, high], task_rows), group_by, "left")
            .drop("n")
        )
        if method == "iqr":
            flat = F.col("q1") - F.col("q0") == 0
            reach = iqr_multiplier * (F.col("q1") - F.col("q0"))
        else:
            flat, reach = F.lit(False), F.lit(0.0)
        test = value.between(F.col("q0") - reach, F.col("q1") + reach)
    else:
        raise ValueError(f"unknown outlier method: {method}")
    bounds = settle(bounds.withColumn("flat", F.coalesce(flat, F.lit(False))))
    normal = F.when(test, value)
    learned = (
        _meet(rows, bounds, group)
        .groupBy(c(group_by), "rows", "flat")
        .agg(
            F.count(normal).alias("sample_count"),
            F.avg(normal).alias("mean"),
            F.stddev_samp(normal).alias("std"),
        )
    )
    state = (
        F.when(F.col("rows") < min_group_size, "skipped")
        .when(F.col("flat"), "degenerate")
        .when(F.col("sample_count") < min_normal_size, "skipped")
        .when(F.col("std") == 0, "degenerate")
        .otherwise("scaled")
    )
    return learned.select(
        c(group_by),
        "rows",
        "sample_count",
        (F.col("rows") - F.col("sample_count")).alias("outlier_removed"),
        "mean",
        "std",
        F.lit(method).alias("outlier_method"),
        state.alias("state"),
    )


def apply_robust(
    df: DataFrame,
    parameters: DataFrame,
    group_by: str,
    column: str,
    scaling_range: Sequence[float] = (1, 100),
    source_range: Sequence[float] = (-1, 5),
    target_range: Sequence[float] = (1, 100),
    degenerate: str = "midpoint",
    suffix: str = "_scaled",
) -> DataFrame:
    """Add ``column + suffix``: z in ``source_range`` mapped to ``target_range``.

    The result is clipped to ``scaling_range`` and rounded. Groups without spread get
    the middle of ``scaling_range``; with ``degenerate="as_reference"`` that middle is
    mapped, clipped and rounded like a z value.
    """
    value = F.abs(to_double(c(column), type_of(df, column)))
    low, high = (float(v) for v in scaling_range)
    s0, s1 = (float(v) for v in source_range)
    t0, t1 = (float(v) for v in target_range)

    def mapped(z: Column) -> Column:
        line = F.lit(t0) + (z - F.lit(s0)) * F.lit(t1 - t0) / F.lit(s1 - s0)
        return F.rint(F.greatest(F.lit(low), F.least(F.lit(high), line)))

    middle = F.lit((low + high) / 2)
    flat = middle if degenerate == "midpoint" else mapped(middle)
    z = (value - F.col("__mean")) / F.col("__std")
    table = parameters.select(
        c(group_by),
        F.col("mean").alias("__mean"),
        F.when(F.col("state") == "scaled", F.col("std")).alias("__std"),
        F.col("state").alias("__state"),
    )
    met = _meet(df, table, [group_by])
    scaled = F.when(F.col("__state") == "degenerate", flat).when(
        (F.col("__state") == "scaled") & z.isNotNull(), mapped(z)
    )
    return met.select(*[c(n) for n in df.columns], scaled.alias(column + suffix))


def robust_standardize(
    df: DataFrame, group_by: str, column: str, **options: Any
) -> tuple[DataFrame, DataFrame]:
    """Learn the group parameters and apply them; returns (table, parameters)."""
    of_apply = {"scaling_range", "source_range", "target_range", "degenerate", "suffix"}
    learn = {k: v for k, v in options.items() if k not in of_apply}
    apply = {k: v for k, v in options.items() if k in of_apply}
    parameters = settle(robust_parameters(df, group_by, column, **learn))
    return apply_robust(df, parameters, group_by, column, **apply), parameters


def outlier_summary(parameters: DataFrame) -> DataFrame:
    """Outliers removed, values used, their ratio and the groups, over scaled groups."""
    used = parameters.where(F.col("state") == "scaled")
    total = F.coalesce(F.sum("outlier_removed"), F.lit(0))
    samples = F.coalesce(F.sum("sample_count"), F.lit(0))
    return used.agg(
        total.alias("total_outliers_removed"),
        samples.alias("total_samples_processed"),
        F.coalesce(total / F.nullif(samples, F.lit(0)), F.lit(0.0)).alias("outlier_ratio"),
        F.count(F.lit(1)).alias("groups_processed"),
    )


# --- z-score of the logarithm -----------------------------------------------------------


@dataclass(frozen=True)
class ZScoreConfig:
    """Settings of the z-score feature; ``log_base`` is ``e``, ``10`` or ``2``."""

    column: str
    group_by: str | None = None
    outliers: OutlierRule = OutlierRule()
    clip_min: float | None = None
    clip_max: float | None = None
    linear: bool = False
    target_min: float = 1
    target_max: float = 100
    round: bool = True
    log_base: str = "e"
    log_epsilon: float = 0.001
    suffix: str = "_zscore"
    keep_original: bool = True

    def __post_init__(self) -> None:
        if self.linear and (self.clip_min is None or self.clip_max is None):
            raise ValueError("the linear map needs finite clip_min and clip_max")

    def log(self, value: Column) -> Column:
        shifted = value + F.lit(float(self.log_epsilon))
        return {"10": F.log10, "2": F.log2}.get(str(self.log_base), F.ln)(shifted)

    def record(self) -> Mapping[str, Any]:
        return {
            "clip_min": self.clip_min,
            "clip_max": self.clip_max,
            "target_min": self.target_min,
            "target_max": self.target_max,
            "round": self.round,
        }


def zscore_parameters(
    df: DataFrame, config: ZScoreConfig, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Per group (or once): counts before and after outlier removal, mean and std of the log.

    The outlier bounds apply to the absolute values, the logarithm to what is left.
    """
    require(df, config.column)
    group = [config.group_by] if config.group_by in df.columns else []
    value = F.abs(to_double(c(config.column), type_of(df, config.column)))
    rows = df.where(c(group[0]).isNotNull()) if group else df
    bounds = settle(config.outliers.bounds(rows, group, value, task_rows))
    clean = F.when(config.outliers.normal(value), config.log(value))
    met = _meet(rows, bounds, group)
    learned = met.groupBy(*[c(g) for g in group]).agg(
        F.count(value).alias("original_count"),
        F.count(clean).alias("cleaned_count"),
        F.avg(clean).alias("mean"),
        F.stddev_samp(clean).alias("std"),
    )
    return learned.where(F.col("cleaned_count") > 0).select(
        *[c(g) for g in group],
        "original_count",
        "cleaned_count",
        (F.col("original_count") - F.col("cleaned_count")).alias("outliers_removed"),
        "mean",
        "std",
        F.lit(str(config.log_base)).alias("log_base"),
        F.lit(float(config.log_epsilon)).alias("log_epsilon"),
    )


def apply_zscore(df: DataFrame, parameters: DataFrame, config: ZScoreConfig) -> DataFrame:
    """Add the feature with known parameters. Unknown groups and NULL values give NULL."""
    group = [config.group_by] if config.group_by in df.columns else []
    value = F.abs(to_double(c(config.column), type_of(df, config.column)))
    table = parameters.select(
        *[c(g) for g in group],
        F.col("mean").alias("__mean"),
        F.when(F.col("std") > 0, F.col("std")).alias("__std"),
    )
    out = (config.log(value) - F.col("__mean")) / F.col("__std")
    some = out.isNotNull()
    if config.clip_min is not None:
        out = F.greatest(out, F.lit(float(config.clip_min)))
    if config.clip_max is not None:
        out = F.least(out, F.lit(float(config.clip_max)))
    if config.linear:
        t0, t1 = float(config.target_min), float(config.target_max)
        c0, c1 = float(config.clip_min), float(config.clip_max)
        out = F.lit(t0) + (out - F.lit(c0)) * F.lit(t1 - t0) / F.lit(c1 - c0)
        if config.round:
            out = F.greatest(F.lit(t0), F.least(F.lit(t1), F.rint(out)))
    kept = [n for n in df.columns if config.keep_original or n != config.column]
    return _meet(df, table, group).select(
        *[c(n) for n in kept], F.when(some, out).alias(config.column + config.suffix)
    )


def zscore_log(
    df: DataFrame, config: ZScoreConfig, task_rows: int = TASK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Learn and apply; returns (table, parameters)."""
    parameters = settle(zscore_parameters(df, config, task_rows))
    return apply_zscore(df, parameters, config), parameters
