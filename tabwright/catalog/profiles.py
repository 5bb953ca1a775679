"""Profiles, class distributions, weights, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.base import query, r, rounded, table
from tabwright.operators import metrics, profile
from tabwright.sources.shared import settle

_GAPS = """(select o_orderkey, nullif(o_orderstatus, 'P') as status,
                   case when o_totalprice >= 5000 then o_totalprice end as amount,
                   o_orderpriority as category, o_orderdate from orders)"""
_TYPES = {
    "o_orderkey": "bigint", "status": "string", "amount": "double", "category": "string",
    "o_orderdate": "timestamp_ntz",
}


def _gaps(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") >= 5000, F.col("o_totalprice")).alias("amount"),
        F.col("o_orderpriority").alias("category"),
        "o_orderdate",
    )


@query(
    "missing_stats",
    " union all ".join(
        f"""select '{n}' as "column", count(*) as total_rows, 5 as total_columns,
                   count(*) - count({n}) as null_count,
                   {r(f'(count(*) - count({n}))::DOUBLE / count(*)')} as null_ratio from {_GAPS}"""
        for n in _TYPES
    ),
)
def _(spark, folder):
    return rounded(profile.missing_stats(_gaps(spark, folder)))


_FACTS = [
    ("table", "total_records", "count(*)"),
    ("table", "total_columns", "max(5)"),
    ("table", "columns", f"max('{','.join(_TYPES)}')"),
    ("table", "numeric_columns", "max('o_orderkey,amount')"),
    ("table", "text_columns", "max('status,category')"),
    ("table", "datetime_columns", "max('o_orderdate')"),
    *[("dtype", n, f"max('{t}')") for n, t in _TYPES.items()],
    *[("nulls", n, f"count(*) - count({n})") for n in _TYPES],
    ("amount", "total_amount", "round(sum(amount))::BIGINT"),
    ("amount", "avg_amount", "round(avg(amount))::BIGINT"),
    ("distinct", "category", "count(distinct category)"),
]


@query(
    "table_metadata",
    " union all ".join(
        f"select '{scope}' as scope, '{name}' as name, ({value})::VARCHAR as value from {_GAPS}"
        for scope, name, value in _FACTS
    ),
)
def _(spark, folder):
    facts = profile.table_metadata(_gaps(spark, folder))
    whole = F.round(F.col("value").try_cast("double")).cast("bigint").cast("string")
    return facts.withColumn(
        "value", F.when(F.col("scope") == "amount", whole).otherwise(F.col("value"))
    )


def _statistics(n: str, dtype: str) -> str:
    if dtype in ("bigint", "double"):
        x = f"{n}::DOUBLE"
        spread = [
            ("mean", f"avg({x})"), ("std", f"stddev_samp({x})"), ("min", f"min({x})"),
            ("max", f"max({x})"), ("median", f"quantile_cont({x}, 0.5)"),
            ("q1", f"quantile_cont({x}, 0.25)"), ("q3", f"quantile_cont({x}, 0.75)"),
        ]
        shown = ", ".join(f"{r(v, 3)} as {k}" for k, v in spread)
    else:
        shown = ", ".join(
            f"null::DOUBLE as {k}" for k in ("mean", "std", "min", "max", "median", "q1", "q3")
        )
    return f"""select '{n}' as "column", '{dtype}' as dtype, count({n}) as "count",
                      count(*) - count({n}) as null_count,
                      {r(f'(count(*) - count({n}))::DOUBLE / count(*)', 3)} as null_ratio,
                      count(distinct {n}) as unique_count, {shown} from {_GAPS}"""


@query("column_statistics", " union all ".join(_statistics(n, t) for n, t in _TYPES.items()))
def _(spark, folder):
    return rounded(profile.column_statistics(_gaps(spark, folder)), 3)


# --- classes ----------------------------------------------------------------------------

_COUNTS = f"(select status as label, count(*) as n from {_GAPS} where status is not null group by 1)"
_BRANDS = "(select p_brand as label, count(*) as n from part group by 1)"


@query(
    "class_distribution",
    f"""with c as {_BRANDS}, t as (select count(*) as total from part)
        select label, n as "count", {r('n::DOUBLE / total')} as ratio,
               row_number() over (order by n desc, label) <= 10 as is_top,
               n < total * 0.035::DOUBLE as is_rare from c, t""",
)
def _(spark, folder):
    return rounded(
        profile.class_distribution(table(spark, folder, "part"), "p_brand", 10, 0.035)[0]
    )


@query(
    "class_distribution_summary",
    f"""with c as {_COUNTS}, t as (select count(*) as total from orders)
        select count(*) as num_classes, any_value(total) as total_samples,
               min(n) as min_class_samples, max(n) as max_class_samples,
               {r('max(n)::DOUBLE / min(n)')} as imbalance_ratio,
               count(*) filter (where n < total * 0.34::DOUBLE) as rare_classes,
               coalesce(sum(n) filter (where n < total * 0.34::DOUBLE), 0)::BIGINT as rare_samples,
               {r('coalesce(sum(n) filter (where n < total * 0.34::DOUBLE), 0)::DOUBLE / any_value(total)')} as rare_ratio
        from c, t""",
)
def _(spark, folder):
    found = profile.class_distribution(_gaps(spark, folder), "status", 10, 0.34)[1]
    return rounded(found.withColumn("total_samples", F.col("total_samples").cast("bigint")))


@query(
    "label_top_k",
    f'select label, n as "count" from {_BRANDS} order by n desc, label limit 10',
)
def _(spark, folder):
    return profile.label_top_k(table(spark, folder, "part"), "p_brand", 10)


@query("infer_num_labels", "select count(distinct o_orderpriority) as num_labels from orders")
def _(spark, folder):
    return profile.infer_num_labels(table(spark, folder, "orders"), "o_orderpriority")


@query(
    "stage_row_counts",
    f"""with s as (
          select 0 as step, 'raw' as stage, count(*) as rows_out from orders
          union all select 1, 'with status', count(status) from {_GAPS}
          union all select 2, 'with amount', count(*) from {_GAPS} where status is not null and amount is not null)
        select step, stage, coalesce(lag(rows_out) over (order by step), rows_out) as rows_in, rows_out,
               coalesce(lag(rows_out) over (order by step), rows_out) - rows_out as rows_removed from s""",
)
def _(spark, folder):
    raw = _gaps(spark, folder)
    first = raw.where("status is not null")
    second = first.where("amount is not null")
    return profile.stage_row_counts([("raw", raw), ("with status", first), ("with amount", second)])


@query(
    "split_stats",
    f"""select o_orderpriority as split, count(*) as "rows",
               {r('count(*)::DOUBLE / (select count(*) from orders)')} as ratio from orders group by 1""",
)
def _(spark, folder):
    return rounded(profile.split_stats(table(spark, folder, "orders"), "o_orderpriority"))


@query(
    "profile_diff",
    f"""select 'status' as "column", 'null_count' as metric, '0' as previous,
               (count(*) - count(status))::VARCHAR as current, 'changed' as change
        from {_GAPS} having count(*) > count(status)
        union all
        select 'amount', 'null_count', '0', (count(*) - count(amount))::VARCHAR, 'changed'
        from {_GAPS} having count(*) > count(amount)
        union all
        select 'o_orderdate', 'total_rows', null, count(*)::VARCHAR, 'added' from orders
        union all
        select 'o_orderdate', 'null_count', null, (count(*) - count(o_orderdate))::VARCHAR, 'added' from orders""",
)
def _(spark, folder):
    after = _gaps(spark, folder)
    before = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("category"),
    )
    shown = ["column", "total_rows", "null_count"]
    now, then = [
        profile.long_profile(profile.missing_stats(df).select(*shown)) for df in (after, before)
    ]
    return profile.profile_diff(now, then)


# --- weights and metrics ----------------------------------------------------------------

# A class id per brand; ids 25 to 29 have no rows.
_IDS = """(select (row_number() over (order by p_brand) - 1)::INTEGER as id, count(*) as n
           from part group by p_brand)"""


@query(
    "class_weights",
    f"""with raw as (
          select i::INTEGER as id, coalesce(n, 0) as n,
                 greatest(0.05::DOUBLE, least(3.0::DOUBLE, pow(1.0::DOUBLE / greatest(coalesce(n, 0), 1), 0.3::DOUBLE))) as w
          from range(30) t(i) left join {_IDS} on id = i)
        select id, n as "count", {r('w / avg(w) over ()', 5)} as weight from raw""",
)
def _(spark, folder):
    from tabwright.operators.labels import encode_labels, label_slots

    part = table(spark, folder, "part")
    coded = encode_labels(part, settle(label_slots(part, "p_brand", 30)), "p_brand")
    weights = metrics.class_weights(coded, "labels", 30, 0.3, 0.05, 3.0)
    return rounded(weights, 5)


# A prediction that is right for about half of the orders.
_PREDICTED = """(select o_orderkey, o_orderpriority as label, o_totalprice as amount,
                        case when md5(o_orderkey::VARCHAR) < '8' then o_orderpriority
                             when o_orderstatus = 'F' then '3-MEDIUM' else 'none' end as pred from orders)"""


def _predicted(spark, folder):
    wrong = F.when(F.col("o_orderstatus") == "F", F.lit("3-MEDIUM")).otherwise("none")
    right = F.md5(F.col("o_orderkey").cast("string")) < "8"
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("label"),
        F.col("o_totalprice").alias("amount"),
        F.when(right, F.col("o_orderpriority")).otherwise(wrong).alias("pred"),
    )


_PER_CLASS = f"""(with p as (select * from {_PREDICTED}),
    k as (select label as class from p union select pred from p),
    s as (select class, (select count(*) from p where label = class and pred = class) as tp,
                 (select count(*) from p where label = class) as support,
                 (select count(*) from p where pred = class) as predicted from k)
    select *, coalesce(tp::DOUBLE / nullif(predicted, 0), 0) as precision,
           coalesce(tp::DOUBLE / nullif(support, 0), 0) as recall,
           coalesce(2.0::DOUBLE * tp / nullif(support + predicted, 0), 0) as f1 from s)"""


@query(
    "class_metrics",
    f"""select class, tp, support, predicted, {r('precision')} as precision,
               {r('recall')} as recall, {r('f1')} as f1 from {_PER_CLASS}""",
)
def _(spark, folder):
    return rounded(metrics.class_metrics(_predicted(spark, folder)))


@query(
    "classification_metrics",
    f"""select {r('sum(tp)::DOUBLE / sum(support)')} as accuracy,
               {r('sum(f1 * support) / sum(support)')} as f1_weighted, {r('avg(f1)')} as f1_macro,
               {r('sum(precision * support) / sum(support)')} as precision,
               {r('sum(recall * support) / sum(support)')} as recall,
               sum(support)::BIGINT as "rows" from {_PER_CLASS}""",
)
def _(spark, folder):
    return rounded(metrics.classification_metrics(_predicted(spark, folder)))


@query(
    "confusion_matrix",
    f'select label, pred, count(*) as "count" from {_PREDICTED} group by 1, 2',
)
def _(spark, folder):
    return metrics.confusion_matrix(_predicted(spark, folder))


_WRONG = "sum(case when label <> pred then amount else 0 end)"


@query(
    "misclassified_amount",
    f"""select label, count(*) as "rows", count(*) filter (where label <> pred) as misclassified_rows,
               {r('sum(amount)', 2)} as total_amount, {r(_WRONG, 2)} as misclassified_amount,
               {r(f'{_WRONG} / sum(amount)', 2)} as misclassified_share from {_PREDICTED} group by 1
        union all
        select 'all', count(*), count(*) filter (where label <> pred), {r('sum(amount)', 2)}, {r(_WRONG, 2)},
               {r(f'{_WRONG} / sum(amount)', 2)} from {_PREDICTED}""",
)
def _(spark, folder):
    df = _predicted(spark, folder)
    by_label = metrics.misclassified_amount(df, "amount")
    overall = metrics.misclassified_amount(df, "amount", by=[]).withColumn("label", F.lit("all"))
    return rounded(by_label.unionByName(overall), 2)


@query(
    "metric_history",
    f"""with h as (
          select c_nationkey as run, 'mean_balance' as metric, avg(c_acctbal) as value from customer group by 1
          union all select c_nationkey, 'customers', count(*) from customer group by 1)
        select metric, {r('avg(value)', 3)} as mean, {r('stddev_pop(value)', 3)} as std, {r('max(value)', 3)} as max
        from h group by 1""",
)
def _(spark, folder):
    runs = table(spark, folder, "customer").groupBy("c_nationkey").agg(
        F.avg("c_acctbal").alias("mean_balance"),
        F.count(F.lit(1)).cast("double").alias("customers"),
    )
    history = runs.unpivot("c_nationkey", ["mean_balance", "customers"], "metric", "value")
    return rounded(metrics.metric_history(history), 3)
