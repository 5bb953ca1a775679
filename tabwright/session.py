"""A Spark session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_DEFAULT_LIMIT = "65535"
_COMPILED_LIMIT = "8000"


def tune(spark: SparkSession) -> None:
    """Lower the method size up to which whole-stage code is used, if it is the default.

    The JVM does not compile methods of more than 8,000 bytes of bytecode. One projection
    over dozens of columns becomes such a method and then runs interpreted, which costs
    three to four times as much on a table of 54 columns. With the lower limit Spark
    generates the same projection as many small methods instead.
    """
    if spark.conf.get(_METHOD_LIMIT, _DEFAULT_LIMIT) == _DEFAULT_LIMIT:
        spark.conf.set(_METHOD_LIMIT, _COMPILED_LIMIT)


def build_session(
    app: str = "tabwright",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """Create or get a session: UTC, ANSI, adaptive execution with skew splitting.

    ``master`` and ``shuffle_partitions`` are meant for local runs; on a cluster leave
    both out and let ``spark-submit`` and adaptive execution choose.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1")
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    tune(spark)
    return spark
