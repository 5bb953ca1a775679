"""Raw voucher table to base table, and base table to labelled text.

One lazy chain of operators. Rows are written where more than one later pass needs
them: once as the base table, after its duplicates are gone.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from tabwright.functions.columns import FLOATS, INTEGERS, c, present, type_of
from tabwright.operators.classes import ClassTable, class_table, class_tables
from tabwright.operators.labels import encode_labels, label_slots, with_label_names
from tabwright.operators.lookup import day_type2, normalize_codes_to_text
from tabwright.operators.naming import drop_columns, select_features, standardize_columns
from tabwright.operators.profile import missing_stats, table_metadata
from tabwright.operators.rows import (
    dedup_rows,
    drop_nulls,
    drop_rows,
    keep_larger_classes,
    keep_rows,
    range_filter,
)
from tabwright.operators.sampling import sample_random, sample_stratified
from tabwright.operators.splitting import split_two_step
from tabwright.operators.text import prepare_text_fields, serialize_rows, text_length_stats
from tabwright.operators.tokens import Encoder, token_length_report, tokenize_text
from tabwright.operators.trace import RowTrace, traced
from tabwright.operators.types import transform_dtype
from tabwright.sources.shared import checkpoint_stage


@dataclass(frozen=True)
class BaseTableConfig:
    label: str = "acct_code"
    features: Sequence[str] = ()
    remove_duplicates: bool = True
    dropna_columns: Sequence[str] = ()
    keep: Sequence[Mapping[str, Any]] = ()
    drop: Sequence[Mapping[str, Any]] = ()
    exclude_columns: Sequence[str] = ()
    code_maps: Mapping[str, Mapping[str | None, str]] | None = None
    column_names: Mapping[str, str] | None = None
    amount_column: str | None = None
    min_amount: float | None = None
    max_amount: float | None = None
    date_column: str = "date"
    holidays: DataFrame | Iterable[dt.date] = ()
    min_label_count: int = 0


def possible_rows(named: DataFrame, config: BaseTableConfig) -> DataFrame:
    """The rows that the rules may keep, by the columns as they are stored.

    Rules look at codes as text, behind casts that no scan can see through. What they
    imply for stored numbers is a plain condition on the stored column, which reaches the
    scan; the rules themselves stay above it. Codes in rows that go here are not checked.
    """
    for name in present(named, config.dropna_columns):
        named = named.where(c(name).isNotNull())
    for rule in config.keep:
        name, values = rule.get("column"), list(rule.get("values") or [])
        if name not in named.columns or not values or None in values:
            continue
        if any(token in name.lower() for token in ("date", "amount")):
            continue
        kind = type_of(named, name)
        if isinstance(kind, INTEGERS):
            numbers = [int(v) for v in map(str, values) if re.fullmatch(r"-?\d{1,18}", v)]
        elif isinstance(kind, FLOATS):
            numbers = [float(v) for v in map(str, values) if re.fullmatch(r"-?\d+(\.\d+)?", v)]
        else:
            continue
        if numbers and len(numbers) == len(values):
            named = named.where(c(name).isin(numbers))
    return named


def standardized(raw: DataFrame, config: BaseTableConfig) -> DataFrame:
    """Standard names and types."""
    return transform_dtype(standardize_columns(raw, config.column_names))


def cleaned(df: DataFrame, config: BaseTableConfig, trace: RowTrace | None = None) -> DataFrame:
    """Duplicates, incomplete rows, unwanted rows and columns out; codes to text.

    The row filters stand before the duplicate removal. They look at one row at a time
    and treat copies alike, so the result is the same, and the shuffle over all columns
    only sees rows that stay.
    """
    df = traced(trace, "incomplete rows", drop_nulls(df, config.dropna_columns))
    df = traced(trace, "kept values", keep_rows(df, config.keep))
    df = traced(trace, "dropped values", drop_rows(df, config.drop))
    if config.remove_duplicates:
        df = traced(trace, "duplicates", dedup_rows(df))
    df = normalize_codes_to_text(drop_columns(df, config.exclude_columns), config.code_maps)
    if config.amount_column:
        df = range_filter(df, config.amount_column, config.min_amount, config.max_amount)
        df = traced(trace, "amounts", df)
    return df


def base_table(raw: DataFrame, config: BaseTableConfig, trace: RowTrace | None = None) -> DataFrame:
    """Raw table to features and label, written once; small classes removed.

    A ``trace`` gets the rows of each step.
    """
    return base_and_classes(raw, config, trace)[0]


def base_and_classes(
    raw: DataFrame, config: BaseTableConfig, trace: RowTrace | None = None
) -> tuple[DataFrame, ClassTable]:
    """``base_table``, and its classes for the steps after it."""
    if trace is None:
        df = transform_dtype(possible_rows(standardize_columns(raw, config.column_names), config))
    else:
        df = trace.step("raw", standardized(raw, config))
    df = day_type2(cleaned(df, config, trace), config.holidays, config.date_column)
    df = checkpoint_stage(select_features(df, config.features, config.label), "base_table")
    every, kept = class_tables(df, config.label, config.min_label_count + 1)
    if config.min_label_count > 0:
        df, every = keep_larger_classes(df, kept), kept
    if trace is not None:
        trace.known("small classes", every.rows)
    return df, every


def ingestion_reports(raw: DataFrame, config: BaseTableConfig) -> tuple[DataFrame, DataFrame]:
    """Missing values of the raw table and facts about the standardised one."""
    return missing_stats(raw), table_metadata(standardized(raw, config))


@dataclass(frozen=True)
class TextConfig:
    label: str = "acct_code"
    key: Sequence[str] | str | None = None
    max_classes: int = 260
    seed: int = 42
    test_size: float = 0.05
    val_size: float = 0.025
    extract_ratio: float | None = None
    extract_seed: int = 42
    stratify_extract: bool = True
    text_columns: Sequence[str] = field(default_factory=list)
    separator: str = ", "
    key_value_separator: str = ": "
    include_column_names: bool = True
    unknown_id: int = 0
    slot_order: Sequence[str] | None = None
    named_labels: int = 1000


def labelled_text(
    base: DataFrame, config: TextConfig, classes: ClassTable | None = None
) -> tuple[DataFrame, DataFrame]:
    """Sample, split, encode the label and write each row as text.

    Returns ``(split, labels, text)`` rows and the label slots. The classes are counted
    once, for slots and shares alike, unless ``classes`` of ``base`` are given. The ids
    carry their label names where there are no more than ``named_labels`` slots.
    """
    if config.extract_ratio and 0 < config.extract_ratio < 1:
        if config.stratify_extract:
            base = sample_stratified(
                base, config.label, config.extract_ratio, config.extract_seed, config.key
            )
        else:
            base = sample_random(base, config.extract_ratio, config.extract_seed, config.key)
        classes = None
    classes = classes or class_table(base, config.label)
    slots = label_slots(base, config.label, config.max_classes, config.slot_order, classes)
    split = split_two_step(
        base, config.label, config.test_size, config.val_size, config.seed, config.key, classes=classes
    )
    coded = encode_labels(split, slots, config.label, config.unknown_id)
    ready = prepare_text_fields(coded, config.text_columns, config.label)
    text = serialize_rows(
        ready,
        config.text_columns,
        config.separator,
        config.key_value_separator,
        config.include_column_names,
        config.label,
    )
    if config.max_classes <= config.named_labels:
        text = with_label_names(text, slots)
    return text, slots


def token_table(
    text: DataFrame,
    max_length: int,
    make_encoder: Callable[[], Encoder] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tokens (written once), their length report and the text length report."""
    tokens = checkpoint_stage(
        tokenize_text(text, "text", max_length, make_encoder), "tokens"
    )
    return tokens, token_length_report(tokens), text_length_stats(text)
