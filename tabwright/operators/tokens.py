"""Tokens and reports on token lengths."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.fixed_values import TOKEN_BANDS
from tabwright.functions.columns import c, require
from tabwright.functions.text import word_count, words
from tabwright.operators.sampling import Key, sample_size
from tabwright.sources.shared import settle
from tabwright.sources.tables import materialize_once

Encoder = Callable[[list[str]], Iterable[list[int]]]

#: Texts that are Python values at one time have so many bytes and rows, or are one text.
RUN_BYTES = 1 << 20
RUN_ROWS = 1024


def _runs(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges (first, one past the last) of texts that are encoded together."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and (total + size > RUN_BYTES or i - begin == RUN_ROWS):
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    """Lists of ids from one array per row."""
    ends = np.cumsum([0, *[r.size for r in rows]], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))


def tokenize_text(
    df: DataFrame,
    text: str = "text",
    max_length: int | None = None,
    make_encoder: Callable[[], Encoder] | None = None,
    pad_to_max: bool = False,
    pad_id: int = 0,
) -> DataFrame:
    """Replace the text by its tokens.

    ``make_encoder`` is called once per task and gives a function from a list of texts
    to lists of token ids, one per text; the result then has ``input_ids``. Without it words are the
    tokens and the result has ``tokens``. Both have ``attention_mask``, ``length`` (after
    truncation to ``max_length`` and padding) and ``raw_length`` (before).

    The text is tokenised once; truncation is a slice of that. A NULL text is an empty
    one.
    """
    require(df, text)
    if make_encoder is None:
        filled = words(F.coalesce(c(text), F.lit("")))
        split = df.select(*[c(n) for n in df.columns if n != text], filled.alias("__all"))
        whole = F.size("__all")
        tokens = F.slice("__all", 1, max_length) if max_length else F.col("__all")
        length = F.least(whole, F.lit(max_length)) if max_length else whole
        return split.select(
            *[c(n) for n in df.columns if n != text],
            tokens.alias("tokens"),
            F.array_repeat(F.lit(1), length).alias("attention_mask"),
            length.alias("length"),
            whole.alias("raw_length"),
        )
    kept = [f for f in df.schema if f.name != text]
    ids = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [
            *kept,
            T.StructField("input_ids", ids),
            T.StructField("attention_mask", ids),
            T.StructField("length", T.IntegerType()),
            T.StructField("raw_length", T.IntegerType()),
        ]
    )
    names = [f.name for f in kept]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only the text becomes Python values; the other columns stay what they are.
        # An Arrow batch has 10,000 rows, whose ids as Python values do not fit a task.
        encoder = make_encoder()
        for batch in batches:
            column = batch.column(text)
            for begin, end in _runs(column):
                texts = [value or "" for value in column.slice(begin, end - begin).to_pylist()]
                found, short, mask = [], [], []
                for row in encoder(texts):
                    found.append(len(row))
                    ids = np.array(row[:max_length] if max_length else row, np.int32)
                    gap = max(0, max_length - ids.size) if pad_to_max and max_length else 0
                    short.append(np.pad(ids, (0, gap), constant_values=pad_id))
                    mask.append(np.pad(np.ones(ids.size, np.int32), (0, gap)))
                new = {
                    "input_ids": _lists(short),
                    "attention_mask": _lists(mask),
                    "length": pa.array([ids.size for ids in short], pa.int32()),
                    "raw_length": pa.array(found, pa.int32()),
                }
                rest = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [*[rest.column(n) for n in names], *new.values()], [*names, *new]
                )

    return df.mapInArrow(encode, schema)


def file_encoder(path: str) -> Callable[[], Encoder]:
    """An encoder from a vocabulary file, for ``tokenize_text``; each task loads it once.

    The file must be where tasks run. Strings of special tokens in a text are ordinary
    text, and none are added.
    """

    def load() -> Encoder:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        # One text at a time: what the tokenizer keeps of a text besides its ids is large.
        return lambda texts: (
            tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids for t in texts
        )

    return load


def tokenize_once(
    df: DataFrame, path: str, vocabulary: str, text: str = "text", max_length: int | None = None
) -> tuple[DataFrame, bool]:
    """``tokenize_text`` by a vocabulary file, written to ``path`` unless it is there already.

    The rows, the vocabulary's path and ``max_length`` must be the same for that; returns
    the written table and whether it was written now.
    """
    make = partial(tokenize_text, text=text, max_length=max_length, make_encoder=file_encoder(vocabulary))
    return materialize_once(df, path, f"tokens of {text} by {vocabulary}, at most {max_length}", make=make)


def _lengths(df: DataFrame, names: Sequence[str], by: str | None = None) -> DataFrame:
    """Rows per combination of lengths: as many rows as there are different lengths."""
    keys = ([c(by).alias("split")] if by else []) + [c(n) for n in names]
    return settle(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))


def _spread(column: str, probs: Sequence[int], prefix: str = ""):
    size = c(column)
    total = F.sum("n")
    spots = [
        (F.sum(size * F.col("n")) / total).alias(prefix + "mean"),
        F.max(size).alias(prefix + "max"),
        F.min(size).alias(prefix + "min"),
    ]
    return spots + [
        F.percentile(size, F.lit(p / 100), F.col("n")).alias(f"{prefix}p{p}") for p in probs
    ]


def token_length_report(
    df: DataFrame, length: str = "length", raw_length: str = "raw_length", split: str = "split"
) -> DataFrame:
    """One row per split and one for ``overall``: count, mean, max, min and percentiles,
    for the final and (``raw_``) the untruncated lengths.

    Works on the counted lengths, so the aggregate holds one entry per different length.
    """
    probs = (50, 75, 90, 95, 99)
    counted = _lengths(df, [length, raw_length], split)
    spots = [
        F.sum("n").alias("count"),
        *_spread(length, probs),
        *_spread(raw_length, probs, "raw_"),
    ]
    return counted.rollup("split").agg(F.grouping("split").alias("all"), *spots).select(
        F.when(F.col("all") == 1, F.lit("overall")).otherwise(F.col("split")).alias("split"),
        "count",
        *[
            pre + part
            for pre in ("", "raw_")
            for part in ("mean", "max", "min", *[f"p{p}" for p in probs])
        ],
    )


def token_analysis(
    df: DataFrame,
    text: str = "text",
    sample: int = 0,
    percentiles: Sequence[int] = (25, 50, 75, 90, 95, 99),
    seed: int = 42,
    key: Key = None,
    length: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Statistics and length bands of the tokens, of all rows or of a sample.

    Returns one row of statistics (percentiles cut to whole numbers) and one row per
    band. Words are the tokens unless ``length`` names a column of token counts.
    """
    if sample > 0:
        df = sample_size(df, sample, seed, key)
    size = c(length) if length else word_count(c(text))
    counted = _lengths(df.select(size.alias("length")), ["length"])
    n, x = F.col("n"), F.col("length").cast("double")
    total = F.sum("n")
    mean = F.sum(x * n) / total
    spread = F.sqrt(F.greatest(F.sum(x * x * n) / total - mean * mean, F.lit(0.0)))
    stats = counted.agg(
        total.alias("sample_size"),
        mean.alias("mean"),
        spread.alias("std"),
        F.min("length").alias("min"),
        F.max("length").alias("max"),
        *[
            F.percentile("length", F.lit(p / 100), n).cast("bigint").alias(f"p{p}")
            for p in percentiles
        ],
    )
    rest = F.lit(0).cast("bigint")
    bands, low = [], None
    for i, (name, high) in enumerate(TOKEN_BANDS):
        inside = F.lit(True) if low is None else F.col("length") > low
        if high is not None:
            inside = inside & (F.col("length") <= high)
        bands.append(F.coalesce(F.sum(F.when(inside, n)), rest).alias(f"b{i}"))
        low = high
    entries = [
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("band"), F.col(f"b{i}").alias("rows"))
        for i, (name, _) in enumerate(TOKEN_BANDS)
    ]
    return stats, counted.agg(*bands).select(F.inline(F.array(*entries)))


def recommend_max_length(
    df: DataFrame, length: str = "length", covers: Sequence[int] = (128, 256, 512), step: int = 32
) -> DataFrame:
    """The 95th percentile, that rounded up to a multiple of ``step``, and which share of
    the rows each limit in ``covers`` takes in whole."""
    counted = _lengths(df, [length])
    total = F.sum("n")
    p95 = F.percentile(c(length), F.lit(0.95), F.col("n")).cast("bigint")
    shares = [
        (F.coalesce(F.sum(F.when(c(length) <= limit, F.col("n"))), F.lit(0)) / total).alias(
            f"coverage_{limit}"
        )
        for limit in covers
    ]
    found = counted.agg(p95.alias("p95"), *shares)
    up = (F.floor((F.col("p95") + (step - 1)) / step) * step).alias("recommended_max_length")
    return found.select("p95", up, *[f"coverage_{limit}" for limit in covers])
