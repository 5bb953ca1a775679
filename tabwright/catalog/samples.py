"""Sampling and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.base import query, table
from tabwright.operators import sampling, splitting
from tabwright.operators.classes import counted_classes


def hash_order(key: str, seed: int = 42) -> str:
    return f"md5('{seed}:' || {key}::VARCHAR), {key}::VARCHAR"


def _ranked(by: str | None, source: str = "orders", key: str = "o_orderkey") -> str:
    part = f"partition by {by} " if by else ""
    return f"""(select *, row_number() over ({part}order by {hash_order(key)}) as place,
                       count(*) over ({part}) as n from {source})"""


_COLUMNS = "o_orderkey, o_orderpriority, o_totalprice"


def _orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")


@query(
    "sample_stratified",
    f"select {_COLUMNS} from {_ranked('o_orderpriority')} where place <= round_even(n * 0.05::DOUBLE, 0)",
)
def _(spark, folder):
    return sampling.sample_stratified(_orders(spark, folder), "o_orderpriority", 0.05, 42, "o_orderkey")


@query(
    "sample_random",
    f"select {_COLUMNS} from {_ranked(None)} where place <= floor(n * 0.07::DOUBLE)",
)
def _(spark, folder):
    return sampling.sample_random(_orders(spark, folder), 0.07, 42, "o_orderkey")


@query(
    "sample_rows",
    f"select {_COLUMNS} from {_ranked('o_orderpriority')} where place <= 10",
)
def _(spark, folder):
    return sampling.sample_rows(_orders(spark, folder), 10, "o_orderpriority", 42, "o_orderkey")


@query(
    "subset_splits",
    f"select {_COLUMNS} from {_ranked('o_orderpriority')} where place <= floor(n * 0.13::DOUBLE)",
)
def _(spark, folder):
    return sampling.subset_splits(_orders(spark, folder), 0.13, "o_orderpriority", 42, "o_orderkey")


def split_sql(source: str, label: str, key: str, outer: str, inner: str, names, seed: int = 42) -> str:
    """Stratified split of ``source``; ``outer`` and ``inner`` are sizes in terms of ``total``."""
    outside, middle, inside = names
    return f"""
sizes as (select {label} as lab, count(*)::HUGEINT as n from {source} group by 1),
totals as (select total, ({outer})::BIGINT as outer_rows from (select sum(n)::BIGINT as total from sizes)),
totals2 as (select *, ({inner})::BIGINT as inner_rows from totals),
shares as (select lab, n, total, inner_rows, outer_rows, (n * outer_rows) // total as whole,
                  (n * outer_rows) % total as rest from sizes, totals2),
outers as (select lab, inner_rows, outer_rows, whole + case when row_number() over (order by rest desc, lab)
                  <= outer_rows - sum(whole) over () then 1 else 0 end as o from shares),
shares2 as (select *, (o * inner_rows) // outer_rows as whole, (o * inner_rows) % outer_rows as rest from outers),
inners as (select lab, o, whole + case when row_number() over (order by rest desc, lab)
                  <= inner_rows - sum(whole) over () then 1 else 0 end as i from shares2),
placed as (select *, row_number() over (partition by {label} order by {hash_order(key, seed)}) as place from {source}),
split as (select placed.* exclude (place), case when place <= i then '{inside}' when place <= o then '{middle}'
                 else '{outside}' end as split
          from placed join inners on {label} = lab)"""


@query(
    "split_two_step",
    "with "
    + split_sql(
        "orders", "o_orderpriority", "o_orderkey",
        "ceil(0.05::DOUBLE * total)", "ceil(0.02::DOUBLE / 0.05::DOUBLE * outer_rows)",
        ("train", "valid", "test"),
    )
    + f" select {_COLUMNS}, split from split",
)
def _(spark, folder):
    return splitting.split_two_step(
        _orders(spark, folder), "o_orderpriority", 0.05, 0.02, 42, "o_orderkey"
    )


@query(
    "split_two_step_random",
    f"""with s as (select *, ceil(0.2::DOUBLE * n) as o from {_ranked(None)})
        select {_COLUMNS}, case when place <= ceil(0.1::DOUBLE / 0.2::DOUBLE * o) then 'test'
                                when place <= o then 'valid' else 'train' end as split from s""",
)
def _(spark, folder):
    return splitting.split_two_step(
        _orders(spark, folder), "o_orderpriority", 0.2, 0.1, 42, "o_orderkey", stratify=False
    )


@query(
    "split_ratios",
    "with "
    + split_sql(
        "orders", "o_orderpriority", "o_orderkey",
        "total - ceil(0.1::DOUBLE * total)",
        "ceil(0.1::DOUBLE / (0.8::DOUBLE + 0.1::DOUBLE) * outer_rows)",
        ("test", "train", "val"),
    )
    + f" select {_COLUMNS}, split from split",
)
def _(spark, folder):
    return splitting.split_ratios(
        _orders(spark, folder), "o_orderpriority", 0.8, 0.1, 0.1, 42, "o_orderkey", 3
    )


@query(
    "split_ratios_random",
    f"""with s as (select *, n - ceil(0.1::DOUBLE * n) as o from {_ranked(None, 'customer', 'c_custkey')})
        select c_custkey, c_name, case when place <= ceil(0.1::DOUBLE / (0.8::DOUBLE + 0.1::DOUBLE) * o) then 'val'
                                       when place <= o then 'train' else 'test' end as split from s""",
)
def _(spark, folder):
    # Every name is a class of one row, which is too few to stratify.
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    return splitting.split_ratios(customer, "c_name", 0.8, 0.1, 0.1, 42, "c_custkey", 3)


@query(
    "split_sizes",
    """with s as (select o_orderpriority as o_orderpriority, count(*)::HUGEINT as n from orders group by 1),
            t as (select sum(n)::HUGEINT as total, 1000::HUGEINT as picks from s)
       select o_orderpriority, n::BIGINT as "count",
              ((n * picks) // total + case when row_number() over (order by (n * picks) % total desc, o_orderpriority)
                <= picks - sum((n * picks) // total) over () then 1 else 0 end)::BIGINT as quota from s, t""",
)
def _(spark, folder):
    counts = table(spark, folder, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("count")
    )
    sizes = counted_classes(counts, "o_orderpriority")[0]
    return splitting.share_out(sizes.table, "o_orderpriority", 1000, sizes.rows, sizes.classes)


# --- tables with repeated rows and no key -------------------------------------------------

_REPEATED = """lines as (select l_returnflag, l_linestatus, l_linenumber,
                '{"l_returnflag":"' || l_returnflag || '","l_linestatus":"' || l_linestatus || '","l_linenumber":'
                || l_linenumber || '}' as row_key from lineitem)"""


def _lines(spark, folder):
    return table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")


@query(
    "sample_random_repeats",
    f"""with {_REPEATED}, placed as (select *, row_number() over (order by {hash_order('row_key')}) as place,
            count(*) over () as n from lines)
        select l_returnflag, l_linestatus, l_linenumber from placed where place <= floor(n * 0.07::DOUBLE)""",
)
def _(spark, folder):
    return sampling.sample_random(_lines(spark, folder), 0.07, 42)


@query(
    "sample_stratified_repeats",
    f"""with {_REPEATED}, placed as (select *, count(*) over (partition by l_linenumber) as n,
            row_number() over (partition by l_linenumber order by {hash_order('row_key')}) as place from lines)
        select l_returnflag, l_linestatus, l_linenumber from placed where place <= round_even(n * 0.3::DOUBLE, 0)""",
)
def _(spark, folder):
    return sampling.sample_stratified(_lines(spark, folder), "l_linenumber", 0.3, 42)


@query(
    "split_two_step_repeats",
    f"with {_REPEATED}, "
    + split_sql(
        "lines", "l_returnflag", "row_key",
        "ceil(0.13::DOUBLE * total)", "ceil(0.05::DOUBLE / 0.13::DOUBLE * outer_rows)",
        ("train", "valid", "test"),
    )
    + " select l_returnflag, l_linestatus, l_linenumber, split from split",
)
def _(spark, folder):
    return splitting.split_two_step(_lines(spark, folder), "l_returnflag", 0.13, 0.05, 42)


@query(
    "split_ratios_repeats",
    f"""with {_REPEATED}, s as (select *, count(*) over () as n, row_number() over (order by {hash_order('row_key')}) as place from lines),
        o as (select *, n - ceil(0.1::DOUBLE * n) as outer_rows from s)
        select l_returnflag, l_linestatus, l_linenumber,
          case when place <= ceil(0.15::DOUBLE / (0.75::DOUBLE + 0.15::DOUBLE) * outer_rows) then 'val'
               when place <= outer_rows then 'train' else 'test' end as split from o""",
)
def _(spark, folder):
    # No class has so many rows, so both cuts are plainly random.
    return splitting.split_ratios(
        _lines(spark, folder), "l_returnflag", 0.75, 0.15, 0.1, 42, min_samples_per_class=10**12
    )
