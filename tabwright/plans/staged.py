"""The ten-step preparation with a report per step.

Steps: rename and narrow, profile and filter, clean, label mapping, group features,
column selection, split, (scaling is a no-op), text, package. The table is written
where several passes follow: as it comes in, unless it is a stored table already, after
the cleaning, after the split and as text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from tabwright.functions.columns import c, require
from tabwright.operators.classes import class_tables, keep_classes
from tabwright.operators.group_features import (
    ZScoreConfig,
    outlier_summary,
    robust_standardize,
    zscore_log,
)
from tabwright.operators.labels import (
    encode_labels,
    label_mapping_create,
    label_mapping_update,
    mapping_summary,
    with_label_names,
)
from tabwright.operators.lookup import day_type3
from tabwright.operators.naming import (
    drop_columns,
    missing_columns,
    rename_from_mapping,
    select_feature_columns,
)
from tabwright.operators.profile import class_distribution, column_statistics, split_stats
from tabwright.operators.rows import (
    dedup_by_key,
    drop_nulls,
    row_filter_report,
    row_filters,
    stage_filters,
)
from tabwright.operators.splitting import split_ratios
from tabwright.operators.text import serialize_rows_patterns
from tabwright.operators.tokens import token_analysis
from tabwright.operators.trace import RowTrace, traced
from tabwright.operators.types import narrow_and_count
from tabwright.sources.packaging import package_dataset
from tabwright.sources.shared import checkpoint_stage, is_stored


@dataclass(frozen=True)
class StagedConfig:
    target: str
    names: Mapping[str, str] = field(default_factory=dict)
    required: Sequence[str] = ()
    rules: Sequence[Mapping[str, Any]] = ()
    exclude_columns: Sequence[str] = ()
    stage_filters: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    drop_null_columns: Sequence[str] = ()
    dedup_key: Sequence[str] | None = None
    dedup_order: Sequence[str] | None = None
    dedup_keep: str = "first"
    min_samples: int = 2
    total_classes: int = 300
    dummy_prefix: str = "DUMMY_"
    robust: Mapping[str, Any] | None = None
    zscores: Sequence[ZScoreConfig] = ()
    date_column: str | None = None
    holidays: DataFrame | Iterable[dt.date] = ()
    features: Sequence[str] = ()
    key: Sequence[str] | str | None = None
    train_ratio: float = 0.8
    val_ratio: float = 0.1
    test_ratio: float = 0.1
    seed: int = 42
    min_samples_per_class: int = 3
    separator: str = "^ "
    key_value_separator: str = ":"
    replacement: str = "None"
    token_sample: int = 0
    narrow: bool = True
    profile: bool = True
    count_rows: bool = True
    named_labels: int = 1000


def staged_text(
    raw: DataFrame,
    config: StagedConfig,
    mapping: DataFrame | None = None,
    package_to: str | None = None,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Returns ``(split, labels, text, original_labels)`` rows and the reports by name.

    ``row_counts`` among the reports has the rows in, out and removed per step.
    ``mapping`` is the label mapping of an earlier run, whose ids stay. With
    ``package_to`` the result is also written as a package.
    """
    target = config.target
    reports: dict[str, DataFrame] = {}

    df, renamed = rename_from_mapping(raw, config.names)
    require(df, target)
    if not is_stored(raw):
        # Four passes follow, which would each repeat the joins that made the rows.
        df = checkpoint_stage(df, "input")
    trace = RowTrace() if config.count_rows else None
    if config.narrow:
        df, reports["types"], rows = narrow_and_count(df, 0.3, [target], exact=False)
        if trace:
            trace.known("input", rows)

    missing = missing_columns(df, config.required)
    if config.profile:
        reports["columns"] = column_statistics(df)
    if config.rules:
        reports["row_filters"] = row_filter_report(df, config.rules)
    if not config.narrow:
        df = traced(trace, "input", df)
    df = traced(trace, "row filters", row_filters(df, config.rules))
    df = stage_filters(drop_columns(df, config.exclude_columns), config.stage_filters)
    df = traced(trace, "stage filters", df)
    df = traced(trace, "incomplete rows", drop_nulls(df, config.drop_null_columns))
    if config.dedup_key:
        df = dedup_by_key(df, config.dedup_key, config.dedup_keep, config.dedup_order)
        df = traced(trace, "duplicates", df)
    df = checkpoint_stage(df, "cleaned")
    classes = class_tables(df, target, config.min_samples)[1]
    df = keep_classes(df, classes)
    if trace:
        trace.known("small classes", classes.rows)
        reports["row_counts"] = trace.report(df.sparkSession)
    reports["classes"], reports["class_summary"] = class_distribution(df, target, classes=classes)

    if mapping is None:
        mapping = label_mapping_create(
            df, target, config.total_classes, config.dummy_prefix, classes
        )
    else:
        mapping = label_mapping_update(
            df, target, mapping, config.total_classes, config.dummy_prefix
        )
    mapping = checkpoint_stage(mapping, "label_mapping")
    reports["label_mapping"], reports["label_summary"] = mapping, mapping_summary(mapping)

    if config.robust:
        df, parameters = robust_standardize(df, **config.robust)
        reports["robust_parameters"] = parameters
        reports["outliers"] = outlier_summary(parameters)
    for zscore in config.zscores:
        df, reports[f"zscore_{zscore.column}"] = zscore_log(df, zscore)
    if config.date_column:
        df = day_type3(df, config.holidays, config.date_column)

    features = [n for n in config.features if n in df.columns]
    helpers = [config.key] if isinstance(config.key, str) else list(config.key or [])
    extra = [n for n in helpers if n not in features and n != target]
    df = select_feature_columns(df, target, [*features, *extra] if features else None)

    df = split_ratios(
        df, target, config.train_ratio, config.val_ratio, config.test_ratio,
        config.seed, config.key, config.min_samples_per_class, classes=classes,
    )
    df = checkpoint_stage(df, "split")
    reports["splits"] = split_stats(df)

    features = features or [n for n in df.columns if n not in (target, "split")]
    text = serialize_rows_patterns(
        encode_labels(df, mapping, target), target, features,
        config.separator, config.key_value_separator, True, config.replacement,
    )
    # The tokens are counted, a package written and the result read from one copy.
    text = checkpoint_stage(text, "text")
    if config.total_classes <= config.named_labels:
        text = with_label_names(text, mapping)
    reports["token_stats"], reports["token_bands"] = token_analysis(
        text, sample=config.token_sample, seed=config.seed
    )
    if package_to:
        package_dataset(
            text.select("split", "text", "labels", c("original_labels")),
            package_to,
            info={
                "target_column": target,
                "feature_columns": features,
                "columns_mapping": renamed,
                "missing_required_columns": missing,
                "separator": config.separator,
                "key_value_separator": config.key_value_separator,
                "missing_value": config.replacement,
                "zscore_settings": {z.column: dict(z.record()) for z in config.zscores},
                "split_ratios": [config.train_ratio, config.val_ratio, config.test_ratio],
            },
            tables={k: v for k, v in reports.items() if k not in ("columns", "types")},
        )
    return text, reports
