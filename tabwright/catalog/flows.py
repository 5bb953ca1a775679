"""The two whole preparations, from raw table to labelled text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.catalog.base import ORDER_DAY, compact_date, fresh_path, query, r, rounded, table
from tabwright.catalog.lookups import HOLIDAYS, is_holiday
from tabwright.catalog.samples import split_sql
from tabwright.catalog.texts import amount_sql
from tabwright.operators.group_features import OutlierRule, ZScoreConfig
from tabwright.operators.labels import label_names
from tabwright.operators.trace import RowTrace
from tabwright.plans.staged import StagedConfig, staged_text
from tabwright.plans.vouchers import (
    BaseTableConfig,
    TextConfig,
    base_and_classes,
    base_table,
    labelled_text,
    token_table,
)
from tabwright.sources.tables import write_splits

_FEATURES = [
    "date", "party_name", "vat_id_party", "vat_message_code", "document_type",
    "supply_amount", "total_amount", "day_type", "journal_key",
]


def raw_vouchers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as raw vouchers, each of them twice, with codes stored as floats."""
    priority = F.substring("o_orderpriority", 1, 1)
    document = F.when(priority == "1", 10).when(priority == "2", 11).when(priority == "3", 20)
    status = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
    rows = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.year("o_orderdate").cast("double").alias("연도"),
            compact_date("o_orderdate").cast("double").alias("전표일자"),
            (17 + F.col("n_regionkey")).cast("double").alias("부가세유형"),
            F.concat_ws("-", "c_mktsegment", "n_regionkey").alias("계정과목코드"),
            F.col("c_name").alias("거래처명"),
            F.when(F.col("o_totalprice") >= 2000, F.col("c_custkey").cast("string")).alias("사업자등록번호"),
            F.col("o_totalprice").alias("매입.합계금액"),
            F.col("c_acctbal").cast("string").alias("매입.공급가액"),
            status.cast("double").alias("과세유형메시지(코드)"),
            F.coalesce(document, F.lit(99)).cast("double").alias("증빙코드"),
            F.col("o_orderkey").alias("전표키"),
        )
    )
    return rows.unionByName(rows)


BASE = BaseTableConfig(
    features=_FEATURES,
    dropna_columns=["vat_id_party", "date", "total_amount", "acct_code", "year"],
    keep=[{"column": "year", "values": ["1996", "1997", "1998", "1999", "2000"]}],
    drop=[{"column": "vat_type", "values": ["17"]}],
    exclude_columns=["id", "created_at"],
    holidays=HOLIDAYS,
    min_label_count=3,
)
TEXT = TextConfig(
    key="journal_key",
    test_size=0.2,
    val_size=0.1,
    text_columns=_FEATURES,
    separator="^ ",
    key_value_separator=":",
)

_BASE_SQL = f"""raw as (
  select o_orderkey as k, o_orderdate, c_mktsegment || '-' || n_regionkey as acct_code, c_name, c_custkey,
         o_totalprice, c_acctbal, o_orderstatus, o_orderpriority
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  where year(o_orderdate) between 1996 and 2000 and n_regionkey <> 0 and o_totalprice >= 2000),
base as (
  select * from raw where acct_code in (select acct_code from raw group by 1 having count(*) > 3))"""

_BASE_TEXT = f"""'date:' || strftime(o_orderdate, '%Y-%m-%d') || '^ party_name:' || c_name || '^ vat_id_party:' || c_custkey
  || '^ vat_message_code:' || case o_orderstatus when 'F' then 'standard' when 'O' then 'simplified' else 'unregistered' end
  || '^ document_type:' || case left(o_orderpriority, 1) when '1' then 'tax_invoice' when '2' then 'zero_invoice'
                             when '3' then 'credit_card' else '99' end
  || '^ supply_amount:' || {amount_sql('c_acctbal')} || '^ total_amount:' || {amount_sql('o_totalprice')}
  || '^ day_type:' || case when isodow(o_orderdate) >= 6 or {is_holiday('o_orderdate')} then 'holiday' else 'workday' end
  || '^ journal_key:' || k"""

_FLOW_SQL = f"""{_BASE_SQL},
{split_sql('base', 'acct_code', 'k', 'ceil(0.2::DOUBLE * total)', 'ceil(0.1::DOUBLE / 0.2::DOUBLE * outer_rows)',
           ('train', 'valid', 'test'))},
ids as (select acct_code as a, (row_number() over (order by acct_code) - 1)::INTEGER as id
        from (select distinct acct_code from base)),
flow as (select split, id as labels, {_BASE_TEXT} as text from split join ids on acct_code = a)"""


def voucher_text(spark: SparkSession, folder: str) -> DataFrame:
    base, classes = base_and_classes(raw_vouchers(spark, folder), BASE)
    return labelled_text(base, TEXT, classes)[0]


query("voucher_text", f"with {_FLOW_SQL} select split, labels, text from flow")(voucher_text)


@query(
    "voucher_base_table",
    f"""with {_BASE_SQL}
        select {ORDER_DAY}::INTEGER as date, c_name as party_name, c_custkey::VARCHAR as vat_id_party,
               case o_orderstatus when 'F' then 'standard' when 'O' then 'simplified' else 'unregistered' end as vat_message_code,
               c_acctbal as supply_amount, o_totalprice as total_amount, k::VARCHAR as journal_key, acct_code
        from base""",
)
def _(spark, folder):
    base = base_table(raw_vouchers(spark, folder), BASE)
    return base.drop("day_type", "document_type")


@query(
    "voucher_token_report",
    f"""with {_FLOW_SQL},
        t as (select split, len(regexp_extract_all(text, '[^ ]+')) as n from flow),
        u as (select split, n, least(n, 12) as m from t union all select 'overall', n, least(n, 12) from t)
        select split, count(*) as "count", {r('avg(m)')} as mean, max(m)::INTEGER as max,
               {r('avg(n)')} as raw_mean, max(n)::INTEGER as raw_max, {r('quantile_cont(n, 0.95)')} as raw_p95 from u group by 1""",
)
def _(spark, folder):
    report = token_table(voucher_text(spark, folder), 12)[1]
    return rounded(report.select("split", "count", "mean", "max", "raw_mean", "raw_max", "raw_p95"))


# --- the ten-step preparation -----------------------------------------------------------


def raw_purchases(spark: SparkSession, folder: str) -> DataFrame:
    rows = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_orderkey",
            "o_custkey",
            "o_totalprice",
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
            "o_orderpriority",
            "c_mktsegment",
        )
    )
    return rows.unionByName(rows)


STAGED = StagedConfig(
    target="acct",
    names={
        "o_orderkey": "voucher_key",
        "o_custkey": "co_vat_id",
        "o_totalprice": "pur_total",
        "o_orderdate": "txn_date",
        "o_orderpriority": "priority",
        "c_mktsegment": "acct",
    },
    required=["acct", "pur_total", "voucher_key"],
    rules=[{"column": "pur_total", "operator": ">", "value": 5000.0}],
    stage_filters={
        "priority": {"operator": "in", "values": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]}
    },
    drop_null_columns=["acct", "pur_total"],
    dedup_key=["voucher_key"],
    dedup_order=["voucher_key"],
    total_classes=8,
    zscores=[
        ZScoreConfig(
            column="pur_total",
            group_by="co_vat_id",
            outliers=OutlierRule(0.05, 0.98, 0.5, 1.5),
            clip_min=-3,
            clip_max=5,
            linear=True,
            target_min=1,
            target_max=10,
            log_epsilon=0.1,
        )
    ],
    date_column="txn_date",
    holidays=HOLIDAYS,
    features=["co_vat_id", "priority", "day_type", "txn_date", "pur_total", "pur_total_zscore"],
    key="voucher_key",
)

_STAGED_SQL = f"""kept as (
  select o_orderkey as k, o_custkey, o_totalprice, o_orderdate, o_orderpriority, c_mktsegment as acct
  from orders join customer on o_custkey = c_custkey
  where o_totalprice > 5000 and o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')),
b as (select o_custkey as g, quantile_cont(o_totalprice, 0.05) as q0, quantile_cont(o_totalprice, 0.98) as q1 from kept group by 1),
l as (select kept.*, ln(o_totalprice + 0.1::DOUBLE) as y,
             o_totalprice between q0 - 0.5::DOUBLE * (q1 - q0) and q1 + 1.5::DOUBLE * (q1 - q0) as ok
      from kept join b on o_custkey = g),
p as (select o_custkey as g, avg(y) filter (where ok) as mean, stddev_samp(y) filter (where ok) as std from l group by 1),
z as (select l.*, case when std > 0 then greatest(1::DOUBLE, least(10::DOUBLE, round_even(1::DOUBLE
         + (greatest(-3::DOUBLE, least(5::DOUBLE, (y - mean) / std)) + 3::DOUBLE) * 9::DOUBLE / 8::DOUBLE, 0)))::BIGINT end as zs
      from l join p on o_custkey = g),
{split_sql('z', 'acct', 'k', 'total - ceil(0.1::DOUBLE * total)', 'ceil(0.1::DOUBLE / (0.8::DOUBLE + 0.1::DOUBLE) * outer_rows)',
           ('test', 'train', 'val'))},
ids as (select acct as a, (row_number() over (order by acct) - 1)::INTEGER as id from (select distinct acct from z))"""


@query(
    "staged_text",
    f"""with {_STAGED_SQL}
        select split, id as labels, acct as original_labels,
          'co_vat_id:' || o_custkey || '^ priority:' || o_orderpriority || '^ day_type:'
          || case when isodow(o_orderdate) >= 6 then 'weekend' when {is_holiday('o_orderdate')} then 'holiday' else 'weekday' end
          || '^ txn_date:' || strftime(o_orderdate, '%Y-%m-%d') || '^ pur_total:'
          || case when o_totalprice = floor(o_totalprice) then o_totalprice::BIGINT::VARCHAR else o_totalprice::VARCHAR end
          || '^ pur_total_zscore:' || coalesce(zs::VARCHAR, 'None') as text
        from split join ids on acct = a""",
)
def _(spark, folder):
    return staged_text(raw_purchases(spark, folder), STAGED)[0]


@query(
    "staged_class_summary",
    """with kept as (select c_mktsegment as acct from orders join customer on o_custkey = c_custkey
         where o_totalprice > 5000 and o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')),
       c as (select acct, count(*) as n from kept group by 1)
       select count(*) as num_classes, sum(n)::BIGINT as total_samples, min(n) as min_class_samples,
              max(n) as max_class_samples from c""",
)
def _(spark, folder):
    reports = staged_text(raw_purchases(spark, folder), STAGED)[1]
    return reports["class_summary"].select(
        "num_classes", F.col("total_samples").cast("bigint").alias("total_samples"),
        "min_class_samples", "max_class_samples",
    )


# --- rows per step, and label names that travel with the ids --------------------------------


def _steps(steps: list[tuple[str, str]]) -> str:
    """(stage, query of its row count) to the report of a trace."""
    counts = " union all ".join(f"select {i}::INTEGER as step, '{name}' as stage, ({sql}) as n" for i, (name, sql) in enumerate(steps))
    before = "coalesce(lag(n) over (order by step), n)"
    return f"select step, stage, {before}::BIGINT as rows_in, n::BIGINT as rows_out, ({before} - n)::BIGINT as rows_removed from ({counts})"


@query(
    "voucher_row_counts",
    "with v as (select orders.*, c_mktsegment, n_regionkey from orders join customer on o_custkey = c_custkey"
    " join nation on c_nationkey = n_nationkey), "
    + f"{_BASE_SQL} "
    + _steps(
        [
            ("raw", "select 2 * count(*) from v"),
            ("incomplete rows", "select 2 * count(*) from v where o_totalprice >= 2000"),
            ("kept values", "select 2 * count(*) from v where o_totalprice >= 2000 and year(o_orderdate) between 1996 and 2000"),
            ("dropped values", "select 2 * count(*) from raw"),
            ("duplicates", "select count(*) from raw"),
            ("small classes", "select count(*) from base"),
        ]
    ),
)
def _(spark, folder):
    trace = RowTrace()
    base_table(raw_vouchers(spark, folder), BASE, trace)
    return trace.report(spark)


_PURCHASES = "select 2 * count(*) from orders join customer on o_custkey = c_custkey"
_LARGE = f"{_PURCHASES} where o_totalprice > 5000"
_PRIORITY = "o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')"


@query(
    "staged_row_counts",
    _steps(
        [
            ("input", _PURCHASES),
            ("row filters", _LARGE),
            ("stage filters", f"{_LARGE} and {_PRIORITY}"),
            ("incomplete rows", f"{_LARGE} and {_PRIORITY}"),
            ("duplicates", f"{_LARGE} and {_PRIORITY}".replace("2 * ", "")),
            ("small classes", f"{_LARGE} and {_PRIORITY}".replace("2 * ", "")),
        ]
    ),
)
def _(spark, folder):
    return staged_text(raw_purchases(spark, folder), STAGED)[1]["row_counts"]


@query(
    "label_names_read_back",
    f"""with {_BASE_SQL},
        l as (select distinct acct_code as label from base),
        r as (select label, (row_number() over (order by label) - 1)::INTEGER as id from l)
        select id, label from r
        union all
        select k::INTEGER, 'dummy_' || (k + 1) from range(0, 260) t(k) where k >= (select count(*) from l)""",
)
def _(spark, folder):
    # Written as split folders and read again: the id column still names its classes.
    path = fresh_path(spark, "labelled_splits")
    base, classes = base_and_classes(raw_vouchers(spark, folder), BASE)
    write_splits(labelled_text(base, TEXT, classes)[0], path)
    return label_names(spark.read.parquet(path))
