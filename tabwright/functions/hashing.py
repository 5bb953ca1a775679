"""A repeatable random order that does not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import c


def row_key(df: DataFrame, key: Sequence[str] | str | None) -> Column:
    """Text that identifies a row: one column as it is, several (or all) as JSON."""
    names = [key] if isinstance(key, str) else list(key or df.columns)
    if len(names) == 1:
        return F.coalesce(c(names[0]).cast("string"), F.lit(""))
    return F.to_json(F.struct(*[c(n) for n in names]))


def seeded_hash(seed: int, key: Column) -> Column:
    """md5 of ``seed:key`` - equal in any engine that has md5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def row_fingerprint(df: DataFrame) -> Column:
    """64-bit hash of a row in which NULL in one column differs from NULL in another."""
    parts: list[Column] = []
    for name in df.columns:
        parts += [c(name).isNull(), c(name)]
    return F.xxhash64(*parts)
