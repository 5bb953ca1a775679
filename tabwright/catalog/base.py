"""Registry of queries and the small helpers their definitions share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import FLOATS, c
from tabwright.functions.numbers import half_even
from tabwright.session import tune
from tabwright.sources.shared import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with SQL for the same result."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/queries/{name}/{uuid.uuid4().hex}"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, because engines sum them in different orders."""
    return df.select(
        *[
            half_even(c(f.name).cast("double"), digits).alias(f.name)
            if isinstance(f.dataType, FLOATS)
            else c(f.name)
            for f in df.schema
        ]
    )


def r(expression: str, digits: int = 6) -> str:
    """The SQL side of ``rounded``."""
    scale = 10**digits
    return f"(round_even(({expression})::DOUBLE * {scale}, 0) / {scale})"


def compact_date(name: str) -> Column:
    """A timestamp column as YYYYMMDD text."""
    return F.date_format(c(name), "yyyyMMdd")


ORDER_DAY = "strftime(o_orderdate, '%Y%m%d')"
