"""Codes, labels, categories, calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tabwright.catalog.base import ORDER_DAY, compact_date, query, r, rounded, table
from tabwright.fixed_values import CODE_TEXT, FIXED_HOLIDAYS
from tabwright.operators import labels, lookup
from tabwright.sources.shared import settle

_STATUS = {"A": "accepted", "N": "none", None: "unregistered"}

_CODED = """(select l_orderkey, l_linenumber, nullif(l_returnflag, 'R') as status,
                    l_quantity::INTEGER as document_type from lineitem)"""


def _coded(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_returnflag", F.lit("R")).alias("status"),
        F.col("l_quantity").alias("document_type"),
    )


def _case(column: str, codes: dict) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in codes.items() if k is not None)
    default = f"coalesce({column}::VARCHAR, '{codes[None]}')" if None in codes else f"{column}::VARCHAR"
    return f"case {column}::VARCHAR {whens} else {default} end"


@query(
    "normalize_codes_to_text",
    f"""select l_orderkey, l_linenumber, {_case('status', _STATUS)} as status,
               {_case('document_type', CODE_TEXT['document_type'])} as document_type from {_CODED}""",
)
def _(spark, folder):
    return lookup.normalize_codes_to_text(_coded(spark, folder), {"status": _STATUS})


def _mapped(column: str, codes: dict) -> str:
    known = ", ".join(f"'{k}'" for k in codes if k is not None)
    hit = f"{column}::VARCHAR in ({known})" + (f" or {column} is null" if None in codes else "")
    count = f"count(*) filter (where {hit})"
    return f"""select '{column}' as "column", {count} as mapped, count(*) as total,
                      {r(f'{count}::DOUBLE / count(*)')} as ratio from {_CODED}"""


@query(
    "code_mapping_report",
    f"{_mapped('status', _STATUS)} union all {_mapped('document_type', CODE_TEXT['document_type'])}",
)
def _(spark, folder):
    return rounded(lookup.code_mapping_report(_coded(spark, folder), {"status": _STATUS}))


# --- labels -----------------------------------------------------------------------------

_BRANDS = """select p_brand as label, (row_number() over (order by p_brand) - 1)::INTEGER as id
             from (select distinct p_brand from part)"""

_SLOTS = f"""with own as ({_BRANDS})
select label, id, false as is_dummy from own
union all
select 'dummy_' || (n + 1), n::INTEGER, true from range(40) t(n) where n >= (select count(*) from own)"""


@query("label_slots", _SLOTS)
def _(spark, folder):
    return labels.label_slots(table(spark, folder, "part"), "p_brand", 40)


@query(
    "label_slots_by_first_row",
    """with own as (select p_brand as label, (row_number() over (order by min(p_partkey)) - 1)::INTEGER as id
                    from part group by 1)
       select label, id, false as is_dummy from own
       union all
       select 'dummy_' || (n + 1), n::INTEGER, true from range(30) t(n) where n >= (select count(*) from own)""",
)
def _(spark, folder):
    return labels.label_slots(table(spark, folder, "part"), "p_brand", 30, ["p_partkey"])


@query("label_dictionary", f"select label, id from ({_SLOTS})")
def _(spark, folder):
    slots = settle(labels.label_slots(table(spark, folder, "part"), "p_brand", 40))
    to_id, to_label = labels.label_dictionary(slots)
    return to_id.join(to_label.withColumnRenamed("label", "again"), "id").where(
        F.col("label") == F.col("again")
    ).select("label", "id")


@query(
    "label_mapping_create",
    f"""with own as ({_BRANDS}), n as (select count(*) as k from own)
        select label, id, false as is_dummy from own
        union all
        select 'DUMMY_' || printf('%03d', i), (k + i)::INTEGER, true from n, range(35) t(i) where i < 35 - k""",
)
def _(spark, folder):
    return labels.label_mapping_create(table(spark, folder, "part"), "p_brand", 35)


# The mapping of an earlier run that only knew the brands 1 and 10 to 19.
_KNOWN = """select p_brand as label, (row_number() over (order by p_brand) - 1)::INTEGER as id
            from (select distinct p_brand from part where p_brand like 'Brand#1%')"""


def _known(part):
    return settle(labels.label_mapping_create(part.where("p_brand like 'Brand#1%'"), "p_brand", 15))


@query(
    "label_mapping_update",
    f"""with known as ({_KNOWN}), k as (select count(*) as k from known),
        new as (select p_brand as label from (select distinct p_brand from part)
                where p_brand not in (select label from known)),
        own as (select label, id, false as is_new from known
                union all
                select label, (k + row_number() over (order by label) - 1)::INTEGER, true from new, k),
        n as (select count(*) as n from own)
        select label, id, false as is_dummy, is_new from own
        union all
        select 'DUMMY_' || printf('%03d', i), (n + i)::INTEGER, true, false from n, range(28) t(i) where i < 28 - n""",
)
def _(spark, folder):
    part = table(spark, folder, "part")
    return labels.label_mapping_update(part, "p_brand", _known(part), 28)


@query(
    "new_labels",
    """select distinct p_brand as label from part where p_brand not like 'Brand#1%'""",
)
def _(spark, folder):
    part = table(spark, folder, "part")
    return labels.new_labels(part, "p_brand", _known(part))


@query(
    "mapping_summary",
    """select 35::BIGINT as num_classes, count(distinct p_brand) as num_base_classes,
              35 - count(distinct p_brand) as num_dummy_classes from part""",
)
def _(spark, folder):
    part = table(spark, folder, "part")
    return labels.mapping_summary(labels.label_mapping_create(part, "p_brand", 35))


@query(
    "encode_labels",
    f"""with known as ({_KNOWN})
        select p_partkey, p_brand, coalesce(id, 0)::INTEGER as labels
        from part left join known on p_brand = label""",
)
def _(spark, folder):
    part = table(spark, folder, "part")
    return labels.encode_labels(part, _known(part), "p_brand").select("p_partkey", "p_brand", "labels")


# --- categories -------------------------------------------------------------------------

_GROUPS = {"ECONOMY": "Low", "SMALL": "Low", "PROMO": "Promo", "LARGE": "High"}


@query(
    "categorize_accounts",
    f"""select p_partkey, p_type as account,
               case p_type {' '.join(f"when '{k}' then '{v}'" for k, v in _GROUPS.items())}
               else 'Other' end as account_category from part""",
)
def _(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", F.col("p_type").alias("account"))
    return lookup.categorize_accounts(part, _GROUPS)


@query(
    "tax_category",
    """with a as (select p_partkey, 'Sales ' || p_type || case when p_size < 10 then ' CASH'
                    when p_size < 20 then ' payable cost' when p_size < 30 then ' stock loan'
                    else '' end as account from part
                  union all select p_partkey, p_name from part)
       select p_partkey, account,
              case when account ilike '%capital%' or account ilike '%retained%' or account ilike '%stock%' then 'equity'
                   when account ilike '%payable%' or account ilike '%loan%' or account ilike '%debt%' then 'liability'
                   when account ilike '%cash%' or account ilike '%receivable%' or account ilike '%inventory%'
                        or account ilike '%equipment%' then 'asset'
                   when account ilike '%cost%' or account ilike '%expense%' or account ilike '%overhead%' then 'expense'
                   when account ilike '%revenue%' or account ilike '%sales%' or account ilike '%income%' then 'income'
                   else 'Other' end as tax_category
       from a""",
)
def _(spark, folder):
    part = table(spark, folder, "part")
    size = F.col("p_size")
    named = part.select(
        "p_partkey",
        F.concat(
            F.lit("Sales "),
            "p_type",
            F.when(size < 10, " CASH").when(size < 20, " payable cost").when(size < 30, " stock loan").otherwise(""),
        ).alias("account"),
    )
    return lookup.tax_category(
        named.unionByName(part.select("p_partkey", F.col("p_name").alias("account")))
    )


# --- calendar ---------------------------------------------------------------------------


@query(
    "period_bucket",
    """select o_orderkey, strftime(o_orderdate, '%Y-%m') as by_month,
              year(o_orderdate) || 'Q' || quarter(o_orderdate) as by_quarter,
              year(o_orderdate)::VARCHAR as by_year from orders""",
)
def _(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    for level in ("month", "quarter", "year", "week"):
        df = lookup.period_bucket(df, "o_orderdate", level, f"by_{level}")
    return df.drop("o_orderdate")


@query(
    "period_totals",
    f"""select year(o_orderdate) || 'Q' || quarter(o_orderdate) as period, count(*) as "rows",
               {r('sum(o_totalprice)', 2)} as o_totalprice from orders group by 1""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders")
    return rounded(lookup.period_totals(orders, "o_orderdate", "quarter", ["o_totalprice"]), 2)


# Days that move, as data: lunar new year and the autumn festival of some years.
_MOVING = [
    dt.date(1995, 1, 31), dt.date(1996, 2, 19), dt.date(1997, 2, 7), dt.date(1998, 1, 28),
    dt.date(1999, 2, 16), dt.date(2000, 2, 5), dt.date(2001, 1, 24), dt.date(1996, 9, 27),
    dt.date(1997, 9, 16), dt.date(1998, 10, 5), dt.date(1999, 9, 24), dt.date(2000, 9, 12),
    dt.date(2024, 2, 9),
]
HOLIDAYS = lookup.fixed_holidays([*range(1995, 2002), 2024]) + _MOVING

_FIXED = ", ".join(f"'{m:02d}-{d:02d}'" for m, d in FIXED_HOLIDAYS)
_MOVED = ", ".join(f"'{day.isoformat()}'" for day in _MOVING)


def is_holiday(column: str) -> str:
    return f"""(strftime({column}, '%m-%d') in ({_FIXED})
                or strftime({column}, '%Y-%m-%d') in ({_MOVED}))"""


@query(
    "day_type2",
    f"""select o_orderkey,
               case when o_orderstatus = 'P' then null else {ORDER_DAY}::INTEGER end as order_date,
               case when o_orderstatus <> 'P' and (isodow(o_orderdate) >= 6 or {is_holiday('o_orderdate')})
                    then 'holiday' else 'workday' end as day_type from orders""",
)
def _(spark, folder):
    df = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", compact_date("o_orderdate").cast("int")).alias("order_date"),
    )
    return lookup.day_type2(df, HOLIDAYS, "order_date")


@query(
    "day_type3",
    f"""select event_id, case when isodow(ts) >= 6 then 'weekend'
                              when {is_holiday('ts')} then 'holiday' else 'weekday' end as day_type
        from events""",
)
def _(spark, folder):
    days = spark.createDataFrame([(day,) for day in HOLIDAYS], "date date")
    return lookup.day_type3(table(spark, folder, "events"), days, "ts").select("event_id", "day_type")
