"""Mappings kept as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of strings as a table ``(key, value)``."""
    whole = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "map<string,string>")
    return whole.select(F.explode(parsed).alias("key", "value"))


def read_label_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The ``text2id`` object of a label mapping file as a table ``(label, id)``."""
    whole = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "struct<text2id:map<string,int>>")
    return whole.select(F.explode(parsed.getField("text2id")).alias("label", "id"))


def mapping_dict(mapping: DataFrame, limit: int = 10_000) -> dict[str, str]:
    """A name mapping as a dict for renaming; column names, so at most ``limit``."""
    rows = mapping.select("key", "value").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a name mapping of more than {limit} entries is not a column list")
    return {row.key: row.value for row in rows}
