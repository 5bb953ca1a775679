"""Group-wise numeric features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.base import fresh_path, query, r, rounded, table
from tabwright.operators.group_features import (
    OutlierRule,
    ZScoreConfig,
    apply_robust,
    apply_zscore,
    iqr_outliers,
    outlier_summary,
    robust_parameters,
    robust_standardize,
    zscore_log,
    zscore_parameters,
)
from tabwright.sources.tables import read_table, write_table

_SQL_IQR = """with b as (select o_custkey as g, quantile_cont(o_totalprice, 0.25) as q0,
                                quantile_cont(o_totalprice, 0.75) as q1 from orders group by 1)
select o_orderkey, o_custkey, o_totalprice from orders join b on o_custkey = g
where o_totalprice >= q0 - 0.5::DOUBLE * (q1 - q0) and o_totalprice <= q1 + 0.3::DOUBLE * (q1 - q0)"""


@query("iqr_outliers", _SQL_IQR)
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    rule = OutlierRule(lower_coefficient=0.5, upper_coefficient=0.3)
    return iqr_outliers(orders, "o_totalprice", "o_custkey", rule)


@query(
    "iqr_outliers_global",
    """with b as (select quantile_cont(c_acctbal, 0.1) as q0, quantile_cont(c_acctbal, 0.6) as q1 from customer)
       select c_custkey, c_acctbal from customer, b where c_acctbal <= q1 + 0.4::DOUBLE * (q1 - q0)""",
)
def _(spark, folder):
    rule = OutlierRule(0.1, 0.6, 1.5, 0.4, remove_lower=False)
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return iqr_outliers(customer, "c_acctbal", rule=rule)


# Balances, negative ones included, by nation; small ones are missing.
_BALANCE = """(select c_custkey, c_nationkey as g, case when abs(c_acctbal) >= 200 then c_acctbal end as x
               from customer)"""


def _balance(spark, folder):
    x = F.col("c_acctbal")
    return table(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("g"), F.when(F.abs(x) >= 200, x).alias("x")
    )


def _robust_sql(method: str) -> str:
    if method == "z_score":
        bounds = "avg(abs(x)) as m0, stddev_samp(abs(x)) as s0"
        flat, test = "s0 = 0", "abs((abs(x) - m0) / nullif(s0, 0)) <= 1.2::DOUBLE"
    elif method == "iqr":
        bounds = "quantile_cont(abs(x), 0.25) as q0, quantile_cont(abs(x), 0.75) as q1"
        flat = "q1 - q0 = 0"
        test = "abs(x) between q0 - 0.2::DOUBLE * (q1 - q0) and q1 + 0.2::DOUBLE * (q1 - q0)"
    else:
        bounds = "quantile_cont(abs(x), 0.05) as q0, quantile_cont(abs(x), 0.95) as q1"
        flat, test = "false", "abs(x) between q0 and q1"
    return f"""with s as (select * from {_BALANCE}),
b as (select g, count(*) as n, {bounds} from s group by g),
p as (select s.g, any_value(n) as n, coalesce(any_value({flat}), false) as flat,
             count(x) filter (where {test}) as used, avg(abs(x)) filter (where {test}) as mean,
             stddev_samp(abs(x)) filter (where {test}) as std
      from s join b on s.g = b.g group by s.g),
k as (select *, case when n < 3 then 'skipped' when flat then 'degenerate' when used < 2 then 'skipped'
                     when std = 0 then 'degenerate' else 'scaled' end as state from p)"""


_SCALED = """select c_custkey, s.g, x,
       case when state = 'degenerate' then 50.5::DOUBLE
            when state = 'scaled' then round_even(greatest(1::DOUBLE, least(100::DOUBLE,
                 1::DOUBLE + ((abs(x) - mean) / std + 1::DOUBLE) * 99::DOUBLE / 6::DOUBLE)), 0)
            end as x_scaled
from s left join k on s.g = k.g"""
_FIX_NULL = "case when x is null and state <> 'degenerate' then null else"

_OPTIONS = {
    "iqr": {"iqr_multiplier": 0.2},
    "z_score": {"z_score_threshold": 1.2},
    "percentile": {},
}


def _register_robust(method: str) -> None:
    sql = f"""{_robust_sql(method)}
select c_custkey, g, x, {_FIX_NULL} x_scaled end as x_scaled
from ({_SCALED.replace('from s left', ', state from s left')})"""

    @query(f"robust_standardize_{method}", sql)
    def _(spark, folder):
        return robust_standardize(
            _balance(spark, folder), "g", "x", method=method, **_OPTIONS[method]
        )[0]


for _method in _OPTIONS:
    _register_robust(_method)


@query(
    "robust_parameters",
    f"""{_robust_sql('iqr')}
        select g, n as "rows", used as sample_count, n - used as outlier_removed, {r('mean')} as mean,
               {r('std')} as std, 'iqr' as outlier_method, state from k""",
)
def _(spark, folder):
    return rounded(robust_parameters(_balance(spark, folder), "g", "x", "iqr", 0.2))


@query(
    "outlier_summary",
    f"""{_robust_sql('iqr')}
        select sum(n - used)::BIGINT as total_outliers_removed, sum(used)::BIGINT as total_samples_processed,
               {r('sum(n - used)::DOUBLE / sum(used)')} as outlier_ratio, count(*) as groups_processed
        from k where state = 'scaled'""",
)
def _(spark, folder):
    return rounded(outlier_summary(robust_parameters(_balance(spark, folder), "g", "x", "iqr", 0.2)))


_ZSCORE = ZScoreConfig(
    column="o_totalprice",
    group_by="o_custkey",
    outliers=OutlierRule(0.05, 0.98, 0.5, 1.5),
    clip_min=-3,
    clip_max=5,
    linear=True,
    target_min=1,
    target_max=10,
    log_epsilon=0.1,
)

_ZSCORE_SQL = """with b as (select o_custkey as g, quantile_cont(o_totalprice, 0.05) as q0,
                                   quantile_cont(o_totalprice, 0.98) as q1 from orders group by 1),
l as (select o_orderkey, o_custkey, o_totalprice, ln(o_totalprice + 0.1::DOUBLE) as y,
             o_totalprice between q0 - 0.5::DOUBLE * (q1 - q0) and q1 + 1.5::DOUBLE * (q1 - q0) as ok
      from orders join b on o_custkey = g),
p as (select o_custkey as g, count(*) as n, count(*) filter (where ok) as used, avg(y) filter (where ok) as mean,
             stddev_samp(y) filter (where ok) as std from l group by 1)"""


@query(
    "zscore_log",
    f"""{_ZSCORE_SQL}
        select o_orderkey, o_custkey, o_totalprice,
               case when std > 0 then greatest(1::DOUBLE, least(10::DOUBLE, round_even(1::DOUBLE
                 + (greatest(-3::DOUBLE, least(5::DOUBLE, (y - mean) / std)) + 3::DOUBLE) * 9::DOUBLE / 8::DOUBLE, 0))) end
               as o_totalprice_zscore
        from l join p on o_custkey = g""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return zscore_log(orders, _ZSCORE)[0]


@query(
    "zscore_parameters",
    f"""{_ZSCORE_SQL}
        select g as o_custkey, n as original_count, used as cleaned_count, n - used as outliers_removed,
               {r('mean')} as mean, {r('std')} as std, 'e' as log_base, 0.1::DOUBLE as log_epsilon
        from p where used > 0""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rounded(zscore_log(orders, _ZSCORE)[1])


@query(
    "zscore_log_global",
    f"""with b as (select quantile_cont(abs(x), 0.25) as q0, quantile_cont(abs(x), 0.75) as q1 from {_BALANCE}),
        l as (select c_custkey, g, x, log10(abs(x) + 0.001::DOUBLE) as y,
                     abs(x) between q0 - 0.1::DOUBLE * (q1 - q0) and q1 + 0.1::DOUBLE * (q1 - q0) as ok
              from {_BALANCE}, b),
        p as (select avg(y) filter (where ok) as mean, stddev_samp(y) filter (where ok) as std from l)
        select c_custkey, g, case when y is not null then {r('greatest(-2::DOUBLE, least(2::DOUBLE, (y - mean) / std))', 4)} end as x_z from l, p""",
)
def _(spark, folder):
    config = ZScoreConfig(
        column="x", outliers=OutlierRule(lower_coefficient=0.1, upper_coefficient=0.1),
        clip_min=-2, clip_max=2, log_base="10", suffix="_z", keep_original=False,
    )
    return rounded(zscore_log(_balance(spark, folder), config)[0], 4)


# --- the same with other settings, and parameters that were saved --------------------------


@query(
    "zscore_log_global_linear",
    f"""with b as (select quantile_cont(abs(x), 0.25) as q0, quantile_cont(abs(x), 0.75) as q1 from {_BALANCE}),
        l as (select c_custkey, g, x, log2(abs(x) + 0.001::DOUBLE) as y,
                     abs(x) between q0 - 0.1::DOUBLE * (q1 - q0) and q1 + 0.1::DOUBLE * (q1 - q0) as ok
              from {_BALANCE}, b),
        p as (select avg(y) filter (where ok) as mean, stddev_samp(y) filter (where ok) as std from l)
        select c_custkey, g, x, case when y is not null then greatest(5::DOUBLE, least(25::DOUBLE, round_even(5::DOUBLE
                 + (greatest(-2::DOUBLE, least(3::DOUBLE, (y - mean) / std)) + 2::DOUBLE) * 20::DOUBLE / 5::DOUBLE, 0))) end as x_zscore
        from l, p""",
)
def _(spark, folder):
    config = ZScoreConfig(
        column="x", outliers=OutlierRule(lower_coefficient=0.1, upper_coefficient=0.1),
        clip_min=-2, clip_max=3, linear=True, target_min=5, target_max=25, log_base="2",
    )
    return zscore_log(_balance(spark, folder), config)[0]


# One value a nation stands for groups without spread.
_FLAT = f"""(select c_custkey, g, case when g % 5 = 0 then 700::DOUBLE else x end as x from {_BALANCE})"""


@query(
    "robust_standardize_degenerate",
    f"""{_robust_sql('iqr').replace(_BALANCE, _FLAT)}
        select c_custkey, s.g, x,
          case when state = 'degenerate' then round_even(greatest(1::DOUBLE, least(100::DOUBLE, 1::DOUBLE + (50.5::DOUBLE + 1::DOUBLE) * 99::DOUBLE / 6::DOUBLE)), 0)
               when state = 'scaled' and x is not null then round_even(greatest(1::DOUBLE, least(100::DOUBLE,
                 1::DOUBLE + ((abs(x) - mean) / std + 1::DOUBLE) * 99::DOUBLE / 6::DOUBLE)), 0) end as x_scaled
        from s left join k on s.g = k.g""",
)
def _(spark, folder):
    # Groups without spread get the middle of the scale, which is then mapped like a value.
    flat = _balance(spark, folder).withColumn("x", F.when(F.col("g") % 5 == 0, 700.0).otherwise(F.col("x")))
    return robust_standardize(flat, "g", "x", iqr_multiplier=0.2, degenerate="as_reference")[0]


@query(
    "zscore_saved_parameters",
    f"""with past as (select * from orders where year(o_orderdate) < 1998),
        {_ZSCORE_SQL.removeprefix('with ').replace('from orders', 'from past')}
        select o_orderkey, orders.o_custkey, o_totalprice,
               case when std > 0 then greatest(1::DOUBLE, least(10::DOUBLE, round_even(1::DOUBLE
                 + (greatest(-3::DOUBLE, least(5::DOUBLE, (ln(o_totalprice + 0.1::DOUBLE) - mean) / std)) + 3::DOUBLE) * 9::DOUBLE / 8::DOUBLE, 0))) end
               as o_totalprice_zscore
        from orders left join (select * from p where used > 0) p on orders.o_custkey = g where year(o_orderdate) >= 1998""",
)
def _(spark, folder):
    # Learned from the years before, written, read back, and used on later orders; customers
    # without earlier orders have no parameters.
    orders = table(spark, folder, "orders")
    names = ["o_orderkey", "o_custkey", "o_totalprice"]
    past, later = (orders.where(test).select(*names) for test in ("year(o_orderdate) < 1998", "year(o_orderdate) >= 1998"))
    path = fresh_path(spark, "zscore_parameters")
    write_table(zscore_parameters(past, _ZSCORE), path)
    return apply_zscore(later, read_table(spark, path), _ZSCORE)


@query(
    "robust_saved_parameters",
    f"""{_robust_sql('iqr')},
        o as (select s_suppkey, s_nationkey, s_acctbal from supplier)
        select s_suppkey as c_custkey, s_nationkey as g, s_acctbal as x,
          case when state = 'degenerate' then 50.5::DOUBLE
               when state = 'scaled' then round_even(greatest(1::DOUBLE, least(100::DOUBLE,
                 1::DOUBLE + ((abs(s_acctbal) - mean) / std + 1::DOUBLE) * 99::DOUBLE / 6::DOUBLE)), 0) end as x_scaled
        from o left join k on s_nationkey = k.g""",
)
def _(spark, folder):
    # What the customers of a nation teach, used on its suppliers.
    path = fresh_path(spark, "robust_parameters")
    write_table(robust_parameters(_balance(spark, folder), "g", "x", "iqr", 0.2), path)
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("g"), F.col("s_acctbal").alias("x")
    )
    return apply_robust(suppliers, read_table(spark, path), "g", "x")
