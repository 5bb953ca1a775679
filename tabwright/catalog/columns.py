"""Scans, names, types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tabwright.catalog.base import ORDER_DAY, TABLES, compact_date, query, table
from tabwright.operators import naming, types
from tabwright.sources.tables import read_table

_COLUMN_COUNTS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
    "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3,
    "benchmark": 2, "labels": 3, "conversations": 4,
}


@query(
    "read_table",
    " union all ".join(
        f"select '{n}' as table_name, {_COLUMN_COUNTS[n]} as columns, count(*) as row_count from {n}"
        for n in TABLES
    ),
)
def _(spark, folder):
    def one(name):
        df = read_table(spark, f"{folder}/{name}.parquet")
        return df.agg(
            F.lit(name).alias("table_name"),
            F.lit(len(df.columns)).alias("columns"),
            F.count(F.lit(1)).alias("row_count"),
        )

    return reduce(lambda a, b: a.unionByName(b), [one(n) for n in TABLES])


_REQUIRED = {
    "orders": (["o_orderkey", "o_comment", "o_totalprice"], "o_comment"),
    "customer": (["c_custkey", "c_phone", "c_acctbal", "c_address"], "c_phone,c_address"),
    "part": (["p_partkey", "p_brand"], ""),
}


@query(
    "require_columns",
    " union all ".join(
        f"select '{n}' as table_name, '{gone}' as missing, count(*) as row_count from {n}"
        for n, (_, gone) in _REQUIRED.items()
    ),
)
def _(spark, folder):
    def one(name):
        df = table(spark, folder, name)
        gone = ",".join(naming.missing_columns(df, _REQUIRED[name][0]))
        return df.agg(
            F.lit(name).alias("table_name"),
            F.lit(gone).alias("missing"),
            F.count(F.lit(1)).alias("row_count"),
        )

    return reduce(lambda a, b: a.unionByName(b), [one(n) for n in _REQUIRED])


@query(
    "standardize_columns",
    """select o_orderkey as journal_key, o_custkey as party_code, o_totalprice as total_amount,
              o_orderstatus as vat_message_code, o_orderpriority as new_col_1 from orders""",
)
def _(spark, folder):
    raw = table(spark, folder, "orders").drop("o_orderdate").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    raw = raw.toDF("전표키", "거래처코드", "매입.합계금액", "과세유형메시지(코드)", "New Col-1")
    return naming.standardize_columns(raw)


@query(
    "rename_from_mapping",
    """select c_custkey as customer_id, c_name, c_nationkey as nation_id, c_acctbal as balance,
              c_mktsegment from customer""",
)
def _(spark, folder):
    names = {"c_custkey": "customer_id", "c_nationkey": "nation_id", "c_acctbal": "balance"}
    return naming.rename_from_mapping(table(spark, folder, "customer"), names)[0]


@query("drop_columns", "select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders")
def _(spark, folder):
    return naming.drop_columns(
        table(spark, folder, "orders"), ["o_orderdate", "o_orderstatus", "o_comment"]
    )


@query(
    "select_features",
    """select distinct o_orderpriority, year(o_orderdate)::INTEGER as order_year,
              nullif(o_orderstatus, 'P') as status
       from orders where nullif(o_orderstatus, 'P') is not null""",
)
def _(spark, folder):
    df = table(spark, folder, "orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.year("o_orderdate").alias("order_year"),
        "o_orderpriority",
        "o_orderkey",
    )
    return naming.select_features(
        df, ["o_orderpriority", "order_year", "o_comment", "o_orderpriority"], "status"
    )


@query("select_feature_columns", "select p_size, p_type, p_retailprice, p_brand from part")
def _(spark, folder):
    return naming.select_feature_columns(
        table(spark, folder, "part"), "p_brand", ["p_size", "p_type", "p_weight", "p_retailprice"]
    )


def _dated(df):
    """Order dates in several spellings, right and wrong ones."""
    day = compact_date("o_orderdate")
    return df.select(
        "o_orderkey",
        F.concat(day, F.lit(".0")).alias("text_date"),
        day.cast("double").alias("double_date"),
        F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "O", day)
        .alias("mixed_date"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("unknown"))
        .otherwise(F.concat(F.lit("on "), day))
        .alias("noted_date"),
    )


_MIXED = f"""case o_orderstatus when 'P' then strftime(o_orderdate, '%Y-%m-%d')
                                when 'O' then {ORDER_DAY} end"""
_NOTED = f"case when o_orderpriority = '5-LOW' then 'unknown' else 'on ' || {ORDER_DAY} end"


def _day_number(text: str) -> str:
    run = f"regexp_extract({text}, '([0-9]+)', 1)"
    return f"try_cast(case when length({run}) = 8 then {run} end as integer)"


@query(
    "normalize_dates",
    f"""select o_orderkey, {_day_number(ORDER_DAY)} as text_date,
               {_day_number(ORDER_DAY)} as double_date, {_day_number(_MIXED)} as mixed_date,
               {_day_number(_NOTED)} as noted_date
        from orders""",
)
def _(spark, folder):
    return types.normalize_dates(_dated(table(spark, folder, "orders")))


@query(
    "date_rejects",
    f"""with runs as (
          select 'mixed_date' as "column", regexp_extract({_MIXED}, '([0-9]+)', 1) as run from orders
          union all
          select 'noted_date', regexp_extract({_NOTED}, '([0-9]+)', 1) from orders),
        bad as (select "column", run, count(*) as n from runs
                where run <> '' and length(run) <> 8 group by 1, 2),
        placed as (select *, row_number() over (partition by "column" order by run) as place from bad)
        select "column", sum(n)::BIGINT as rejected,
               string_agg(run, ',' order by run) filter (where place <= 5) as samples
        from placed group by 1""",
)
def _(spark, folder):
    report = types.date_rejects(_dated(table(spark, folder, "orders")))
    return report.withColumn("samples", F.concat_ws(",", "samples"))


@query(
    "normalize_amounts",
    """select o_orderkey, case o_orderstatus when 'P' then o_totalprice end as text_amount,
              -o_totalprice as int_amount
       from orders""",
)
def _(spark, folder):
    df = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice").cast("string"))
        .when(F.col("o_orderstatus") == "F", F.lit("abc"))
        .otherwise(F.concat(F.col("o_totalprice").cast("string"), F.lit("d")))
        .alias("text_amount"),
        (-F.col("o_totalprice")).alias("int_amount"),
    )
    return types.normalize_amounts(df)


@query(
    "normalize_codes",
    """select p_partkey::VARCHAR as p_partkey, nullif(p_size, 13)::VARCHAR as size_code,
              p_brand, case when p_size > 25 then 'True' else 'False' end as large
       from part""",
)
def _(spark, folder):
    df = table(spark, folder, "part").select(
        "p_partkey",
        F.nullif(F.col("p_size"), F.lit(13)).cast("double").alias("size_code"),
        "p_brand",
        (F.col("p_size") > 25).alias("large"),
    )
    return types.normalize_codes(df)


@query(
    "transform_dtype",
    f"""select o_orderkey::VARCHAR as o_orderkey, {_day_number(_MIXED)} as order_date,
               o_totalprice as total_amount, o_custkey::VARCHAR as customer_code,
               nullif(o_orderstatus, 'P') as status
        from orders""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders")
    df = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "O", compact_date("o_orderdate"))
        .alias("order_date"),
        F.col("o_totalprice").cast("string").alias("total_amount"),
        F.col("o_custkey").cast("double").alias("customer_code"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
    )
    return types.transform_dtype(df)


def _int_type(col: str) -> str:
    return f"""case when min({col}) >= -128 and max({col}) <= 127 then 'tinyint'
                    when min({col}) >= -32768 and max({col}) <= 32767 then 'smallint'
                    when min({col}) >= -2147483648 and max({col}) <= 2147483647 then 'int'
                    else 'bigint' end"""


def _narrow(rows: list[tuple[str, str, str]], source: str) -> str:
    """(column, type, kind) to report rows."""
    parts = []
    for col, kind, name in rows:
        if kind == "long":
            to, lo, hi = _int_type(col), f"min({col})::BIGINT", f"max({col})::BIGINT"
        else:
            lo = hi = "null::BIGINT"
            to = f"max('{name}')"
            if kind == "double":
                to = f"case when max(abs({col}::FLOAT::DOUBLE - {col})) <= 0.0005::DOUBLE then 'float' else 'double' end"
        distinct = f"count(distinct {col})" if kind == "text" else "null::BIGINT"
        candidate = f"count(distinct {col})::DOUBLE / count(*) < 0.5" if kind == "text" else "false"
        parts.append(
            f"""select '{source}.{col}' as "column", '{name}' as from_type, {to} as to_type,
                       {lo} as min_value, {hi} as max_value,
                       {distinct} as distinct_count, {candidate} as category_candidate from {source}"""
        )
    return " union all ".join(parts)


@query(
    "narrow_types",
    _narrow(
        [
            ("p_partkey", "long", "bigint"), ("p_name", "text", "string"),
            ("p_brand", "text", "string"), ("p_type", "text", "string"),
            ("p_size", "other", "int"), ("p_retailprice", "double", "double"),
        ],
        "part",
    )
    + " union all "
    + _narrow(
        [
            ("c_custkey", "long", "bigint"), ("c_name", "text", "string"),
            ("c_nationkey", "other", "int"), ("c_acctbal", "double", "double"),
            ("c_mktsegment", "text", "string"),
        ],
        "customer",
    ),
)
def _(spark, folder):
    def one(name):
        report = types.narrow_report(table(spark, folder, name))
        return report.withColumn("column", F.concat(F.lit(name + "."), "column"))

    return one("part").unionByName(one("customer"))


@query(
    "narrow_types_cast",
    """select p_partkey::{int} as p_partkey, p_name, p_brand, p_type, p_size, p_retailprice::{price} as p_retailprice from part""".format(int="INTEGER", price="DOUBLE"),
)
def _(spark, folder):
    part = table(spark, folder, "part")
    narrowed, report = types.narrow_types(part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"))
    # The type of the key depends on the number of parts; its values must not.
    wide = narrowed.withColumn("p_partkey", F.col("p_partkey").cast("int"))
    return wide.withColumn("p_retailprice", F.round(F.col("p_retailprice").cast("double"), 2))


_SKETCHED = _narrow(
    [
        ("o_orderkey", "long", "bigint"), ("o_orderstatus", "text", "string"), ("o_orderpriority", "text", "string"),
        ("o_totalprice", "double", "double"),
    ],
    "orders",
)


@query(
    "narrow_types_sketched",
    f"""select "column", from_type, to_type, min_value, max_value, category_candidate from ({_SKETCHED})""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    report = types.narrow_report(orders, exact=False).drop("distinct_count")
    return report.withColumn("column", F.concat(F.lit("orders."), "column"))
