"""Row filters and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.base import query, table
from tabwright.operators import rows

# Orders with gaps: no status when it is P, no price below 5000.
_GAPS = """(select o_orderkey, o_custkey, nullif(o_orderstatus, 'P') as status,
                   case when o_totalprice >= 5000 then o_totalprice end as price,
                   o_orderpriority as priority from orders)"""


def _gaps(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") >= 5000, F.col("o_totalprice")).alias("price"),
        F.col("o_orderpriority").alias("priority"),
    )


@query("drop_nulls", f"select * from {_GAPS} where status is not null and price is not null")
def _(spark, folder):
    return rows.drop_nulls(_gaps(spark, folder), ["status", "price", "comment"])


@query(
    "keep_rows",
    f"select * from {_GAPS} where status in ('F') and priority in ('1-URGENT', '5-LOW')",
)
def _(spark, folder):
    rules = [
        {"column": "status", "values": ["F"]},
        {"column": "priority", "values": ["1-URGENT", "5-LOW"]},
        {"column": "comment", "values": ["x"]},
        {"column": "priority", "values": []},
    ]
    return rows.keep_rows(_gaps(spark, folder), rules)


@query("drop_rows", f"select * from {_GAPS} where status is null or status not in ('F')")
def _(spark, folder):
    return rows.drop_rows(_gaps(spark, folder), [{"column": "status", "values": ["F"]}])


@query("range_filter", f"select * from {_GAPS} where price between 20000 and 150000")
def _(spark, folder):
    return rows.range_filter(_gaps(spark, folder), "price", 20000.0, 150000.0)


_RULES = [
    {"column": "status", "operator": "!=", "value": "F"},
    {"column": "price", "operator": "not_null"},
    {"column": "price", "operator": ">", "value": 10000.0},
    {"column": "priority", "operator": "isin", "value": ["1-URGENT", "2-HIGH", "3-MEDIUM"]},
    {"column": "comment", "operator": "==", "value": "x"},
    {"column": "price", "operator": "<=", "value": 400000.0},
    {"column": "o_custkey", "operator": ">=", "value": 5},
    {"column": "status", "operator": "is_null"},
]

_TESTS = [
    ("status", "!=", "F", "(status is null or status <> 'F')"),
    ("price", "not_null", None, "price is not null"),
    ("price", ">", "10000.0", "price > 10000"),
    (
        "priority", "isin", "[''1-URGENT'', ''2-HIGH'', ''3-MEDIUM'']",
        "priority in ('1-URGENT', '2-HIGH', '3-MEDIUM')",
    ),
    ("price", "<=", "400000.0", "price <= 400000"),
    ("o_custkey", ">=", "5", "o_custkey >= 5"),
    ("status", "is_null", None, "status is null"),
]


@query("row_filters", f"select * from {_GAPS} where {' and '.join(t[3] for t in _TESTS)}")
def _(spark, folder):
    return rows.row_filters(_gaps(spark, folder), _RULES)


def _report_sql() -> str:
    parts = []
    for i, (column, operator, value, _) in enumerate(_TESTS):
        before = " and ".join(t[3] for t in _TESTS[:i]) or "true"
        after = " and ".join(t[3] for t in _TESTS[: i + 1])
        shown = "null::VARCHAR" if value is None else f"'{value}'"
        parts.append(
            f"""select {i + 1} as step, '{column}' as "column", '{operator}' as operator,
                       {shown} as value, count(*) filter (where {before}) as rows_before,
                       count(*) filter (where {after}) as rows_after,
                       count(*) filter (where {before}) - count(*) filter (where {after}) as rows_removed
                from {_GAPS}"""
        )
    return " union all ".join(parts)


@query("row_filter_report", _report_sql())
def _(spark, folder):
    return rows.row_filter_report(_gaps(spark, folder), _RULES)


@query(
    "stage_filters",
    f"""select * from {_GAPS} where price between 10000 and 300000
        and priority in ('1-URGENT', '2-HIGH') and status = 'O'""",
)
def _(spark, folder):
    filters = {
        "price": {"operator": "between", "values": [10000.0, 300000.0]},
        "priority": {"operator": "in", "values": ["1-URGENT", "2-HIGH"]},
        "status": {"operator": "equals", "values": ["O"]},
        "o_custkey": {"operator": "equals", "values": []},
    }
    return rows.stage_filters(_gaps(spark, folder), filters)


@query(
    "filter_minority_classes",
    """select * from part where p_brand in (
         select p_brand from part group by 1 having count(*) > (select count(*) // 25 from part))""",
)
def _(spark, folder):
    part = table(spark, folder, "part")
    return rows.filter_minority_classes(part, "p_brand", part.count() // 25)


@query(
    "class_filter",
    """select * from part where p_brand in (
         select p_brand from part group by 1 having count(*) >= (select count(*) // 25 from part))""",
)
def _(spark, folder):
    part = table(spark, folder, "part")
    return rows.class_filter(part, "p_brand", part.count() // 25)


@query(
    "class_filter_report",
    f"""with per as (select status, count(*) as n from {_GAPS} group by 1),
             cap as (select count(*) // 3 as least_rows from orders)
        select count(*) filter (where status is not null and n < least_rows) as removed_classes,
               coalesce(sum(n) filter (where status is null or n < least_rows), 0)::BIGINT as removed_rows,
               any_value(least_rows)::BIGINT as min_samples
        from per, cap""",
)
def _(spark, folder):
    df = _gaps(spark, folder)
    return rows.class_filter_report(df, "status", df.count() // 3).withColumn(
        "min_samples", F.col("min_samples").cast("bigint")
    )


# Every line item twice; the tax is missing on returned ones.
_COPIES = """(select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                     case when l_returnflag <> 'R' then l_tax end as l_tax
              from (select * from lineitem union all select * from lineitem))"""


def _copies(spark, folder):
    df = table(spark, folder, "lineitem")
    return df.unionByName(df).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        F.when(F.col("l_returnflag") != "R", F.col("l_tax")).alias("l_tax"),
    )


@query("dedup_rows", f"select distinct * from {_COPIES}")
def _(spark, folder):
    return rows.dedup_rows(_copies(spark, folder))


_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_tax nulls last"
_BACK = "l_linenumber desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_tax desc nulls first"


def _by_key(order: str) -> str:
    return f"""select * exclude (place) from (
                 select *, row_number() over (partition by l_orderkey order by {order}) as place
                 from {_COPIES}) where place = 1"""


_KEYS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax"]


@query("dedup_by_key", _by_key(_ORDER))
def _(spark, folder):
    return rows.dedup_by_key(_copies(spark, folder), ["l_orderkey"], "first", _KEYS)


@query("dedup_by_key_last", _by_key(_BACK))
def _(spark, folder):
    return rows.dedup_by_key(_copies(spark, folder), ["l_orderkey"], "last", _KEYS)


@query(
    "duplicates_removed",
    f"""select count(*) as rows_before, (select count(*) from (select distinct * from {_COPIES})) as rows_after,
               count(*) - (select count(*) from (select distinct * from {_COPIES})) as rows_removed
        from {_COPIES}""",
)
def _(spark, folder):
    return rows.duplicates_removed(_copies(spark, folder))
