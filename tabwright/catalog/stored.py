"""Sinks: write, read back, and compare with the rows that went in."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.base import fresh_path, query, r, rounded, table
from tabwright.operators.profile import missing_stats
from tabwright.operators.splitting import split_two_step
from tabwright.sources.mappings import read_label_mapping, read_mapping
from tabwright.sources.packaging import package_dataset, read_package
from tabwright.sources.shared import checkpoint_stage
from tabwright.sources.tables import (
    materialize_once,
    read_manifest,
    table_fingerprint,
    write_report,
    write_splits,
    write_table,
)

_ORDERS = "select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders"


def _orders(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )


@query("write_table", _ORDERS)
def _(spark, folder):
    path = fresh_path(spark, "write_table")
    write_table(_orders(spark, folder), path)
    return spark.read.parquet(path)


@query(
    "write_report",
    """select 'c_custkey' as "column", count(*) - count(c_custkey) as null_count, count(*) as total_rows from customer
       union all select 'c_name', count(*) - count(c_name), count(*) from customer""",
)
def _(spark, folder):
    path = fresh_path(spark, "write_report")
    report = missing_stats(table(spark, folder, "customer").select("c_custkey", "c_name"))
    write_report(report, path)
    return spark.read.schema(report.schema).json(path).select("column", "null_count", "total_rows")


@query("write_splits", "select o_orderkey, o_custkey, o_totalprice, o_orderpriority as split from orders")
def _(spark, folder):
    path = fresh_path(spark, "write_splits")
    write_splits(_orders(spark, folder).withColumnRenamed("o_orderpriority", "split"), path)
    return spark.read.parquet(path)


@query("checkpoint_stage", f"{_ORDERS} where o_totalprice > 100000")
def _(spark, folder):
    return checkpoint_stage(_orders(spark, folder).where("o_totalprice > 100000"), "orders")


def _dealt(df, key):
    """The same rows in another order and partitioning, whose parts do not grow with the table."""
    return df.hint("rebalance", key)


@query(
    "materialize_once",
    """select count(*) as "rows", count(distinct o_orderpriority) as num_classes, true as first_written,
              false as second_written, sum(o_custkey)::BIGINT as custkey_sum from orders""",
)
def _(spark, folder):
    path = fresh_path(spark, "materialize_once")
    df = _orders(spark, folder)
    _, first = materialize_once(df, path, folder, "o_orderpriority", 5000)
    # The same rows in another order and partitioning.
    again, second = materialize_once(_dealt(df, "o_custkey"), path, folder, "o_orderpriority", 5000)
    manifest = read_manifest(spark, path)
    return again.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(manifest["num_classes"]).cast("bigint").alias("num_classes"),
        F.lit(first).alias("first_written"),
        F.lit(second).alias("second_written"),
        F.sum("o_custkey").alias("custkey_sum"),
    )


@query("table_fingerprint", 'select count(*) as "rows", true as same from lineitem')
def _(spark, folder):
    df = table(spark, folder, "lineitem")
    one = table_fingerprint(df)
    other = table_fingerprint(_dealt(df, "l_partkey")).withColumnRenamed("fingerprint", "again")
    return one.join(other, "rows").select("rows", (F.col("fingerprint") == F.col("again")).alias("same"))


@query(
    "package_dataset",
    f"""with s as (select 'train' as split, ceil(0.1::DOUBLE * count(*)) as held, count(*) as n from orders)
        select 'train' as split, (n - held)::BIGINT as "rows", {r('(n - held)::DOUBLE / n')} as ratio from s
        union all select 'valid', (held - ceil(0.05::DOUBLE / 0.1::DOUBLE * held))::BIGINT,
                         {r('(held - ceil(0.05::DOUBLE / 0.1::DOUBLE * held))::DOUBLE / n')} from s
        union all select 'test', ceil(0.05::DOUBLE / 0.1::DOUBLE * held)::BIGINT,
                         {r('ceil(0.05::DOUBLE / 0.1::DOUBLE * held)::DOUBLE / n')} from s""",
)
def _(spark, folder):
    path = fresh_path(spark, "package_dataset")
    df = split_two_step(_orders(spark, folder), "o_orderpriority", 0.1, 0.05, 42, "o_orderkey")
    labels = df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("rows"))
    stats = package_dataset(df, path, {"target_column": "o_orderpriority"}, {"labels": labels})
    sizes = read_package(spark, path).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
    return rounded(stats.join(sizes, ["split", "rows"]))


def _object(spark, folder, name, key, value):
    """A table as the one JSON object that a mapping file is."""
    path = fresh_path(spark, name)
    pairs = F.map_from_entries(F.collect_list(F.struct(key, value)))
    return path, table(spark, folder, "nation").agg(pairs.alias("m"))


@query("read_mapping", "select n_name as key, n_regionkey::VARCHAR as value from nation")
def _(spark, folder):
    path, made = _object(
        spark, folder, "read_mapping", F.col("n_name"), F.col("n_regionkey").cast("string")
    )
    made.select(F.to_json("m")).write.text(path)
    return read_mapping(spark, path)


@query("read_label_mapping", "select n_name as label, n_nationkey as id from nation")
def _(spark, folder):
    path, made = _object(spark, folder, "read_label_mapping", F.col("n_name"), F.col("n_nationkey"))
    made.select(F.to_json(F.struct(F.col("m").alias("text2id")))).write.text(path)
    return read_label_mapping(spark, path)
