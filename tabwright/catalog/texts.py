"""Rows to text, text lengths, tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.base import ORDER_DAY, compact_date, fresh_path, query, r, rounded, table
from tabwright.fixed_values import MISSING_PATTERNS, MISSING_TEXT, WORD_SPACE
from tabwright.operators import text, tokens


def amount_sql(x: str) -> str:
    e = f"floor(log10(abs({x})))"
    mantissa = f"round_even(abs({x}) / pow(10.0::DOUBLE, {e}) * 10000, 0) / 10000"
    return f"""case when {x} is null then null
                    when {x} = 0 then 'sign=0| mant=0.0000| exponent=0'
                    else printf('sign=%d| mant=%.4f| exponent=%d', sign({x})::INTEGER, {mantissa}, {e}::INTEGER) end"""


def filled_sql(x: str, spellings=tuple(MISSING_TEXT), token: str = "NULL") -> str:
    listed = ", ".join(f"'{s}'" for s in spellings)
    return f"case when {x} is null or {x} in ({listed}) then '{token}' else {x} end"


@query(
    "format_dates",
    """select o_orderkey, case when o_orderstatus <> 'P' then strftime(o_orderdate, '%Y-%m-%d') end as order_date,
              null::VARCHAR as bad_date from orders""",
)
def _(spark, folder):
    day = compact_date("o_orderdate").cast("int")
    df = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", day).alias("order_date"),
        # Month 13 and up.
        (day + 1300).alias("bad_date"),
    )
    return text.format_dates(df)


@query(
    "amount_scientific",
    f"""select c_custkey, {amount_sql('c_acctbal')} as balance_amount,
               {amount_sql("case when c_mktsegment = 'BUILDING' then 0.0::DOUBLE when c_mktsegment = 'MACHINERY' then null else c_acctbal * 1000000 end")}
               as large_amount from customer""",
)
def _(spark, folder):
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    df = table(spark, folder, "customer").select(
        "c_custkey",
        balance.alias("balance_amount"),
        F.when(segment == "BUILDING", F.lit(0.0))
        .when(segment != "MACHINERY", balance * 1000000)
        .alias("large_amount"),
    )
    return text.format_amounts(df)


_DIRTY = """(select c_custkey::VARCHAR as c_custkey,
                    case c_mktsegment when 'BUILDING' then '' when 'MACHINERY' then 'nan'
                      when 'FURNITURE' then '<NA>' when 'AUTOMOBILE' then null else c_mktsegment end as segment,
                    c_name from customer)"""


def _dirty(spark, folder):
    segment = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.when(segment == "BUILDING", "")
        .when(segment == "MACHINERY", "nan")
        .when(segment == "FURNITURE", "<NA>")
        .when(segment != "AUTOMOBILE", segment)
        .alias("segment"),
        "c_name",
    )


@query("fill_missing_text", f"select c_custkey, {filled_sql('segment')} as segment, c_name from {_DIRTY}")
def _(spark, folder):
    return text.fill_missing_text(_dirty(spark, folder))


_FIELDS = f"""(select o_orderkey, o_orderpriority as acct_code, {ORDER_DAY} as raw_date,
                      {filled_sql("strftime(o_orderdate, '%Y-%m-%d')")} as order_date,
                      {filled_sql(amount_sql('o_totalprice'))} as total_amount,
                      {filled_sql("nullif(o_orderstatus, 'P')")} as status from orders)"""


def _fields(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("acct_code"),
        compact_date("o_orderdate").cast("int").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
    )


@query(
    "prepare_text_fields",
    f"select o_orderkey, acct_code, order_date, total_amount, status from {_FIELDS}",
)
def _(spark, folder):
    return text.prepare_text_fields(
        _fields(spark, folder), ["order_date", "total_amount", "status"]
    )


@query(
    "serialize_rows",
    f"""select acct_code as labels, 'order_date:' || order_date || '^ total_amount:' || total_amount
               || '^ status:' || status as text from {_FIELDS}""",
)
def _(spark, folder):
    columns = ["order_date", "total_amount", "status"]
    ready = text.prepare_text_fields(_fields(spark, folder), columns)
    return text.serialize_rows(ready.withColumnRenamed("acct_code", "labels"), columns, "^ ", ":")


@query(
    "serialize_rows_values",
    f"select order_date || ', ' || total_amount || ', ' || status as text from {_FIELDS}",
)
def _(spark, folder):
    columns = ["order_date", "total_amount", "status"]
    ready = text.prepare_text_fields(_fields(spark, folder), columns)
    return text.serialize_rows(ready, columns, include_column_names=False)


# Prices as they print in a text: 900.0 without the fraction, 12345678.5 without exponent.
_PRINTED = """(select c_custkey, c_mktsegment as target, c_acctbal * 100000 as big, round_even(c_acctbal, 0) as whole,
                      case c_mktsegment when 'BUILDING' then 'N/A' when 'MACHINERY' then '' when 'AUTOMOBILE' then null
                        else c_name end as name from customer)"""


def _printed(spark, folder):
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    return table(spark, folder, "customer").select(
        "c_custkey",
        segment.alias("target"),
        (balance * 100000).alias("big"),
        F.rint(balance).alias("whole"),
        F.when(segment == "BUILDING", "N/A")
        .when(segment == "MACHINERY", "")
        .when(segment != "AUTOMOBILE", F.col("c_name"))
        .alias("name"),
    )


def _number_sql(x: str) -> str:
    return f"case when {x} = floor({x}) then {x}::BIGINT::VARCHAR else {x}::VARCHAR end"


def _pattern_sql(patterns) -> str:
    return f"""select 'c_custkey^ ' || c_custkey || '^ big^ ' || {_number_sql('big')} || '^ whole^ ' || {_number_sql('whole')}
                      || '^ name^ ' || {filled_sql('name', patterns, 'None')} as text, target as original_labels from {_PRINTED}"""


@query("serialize_rows_patterns", _pattern_sql(MISSING_PATTERNS))
def _(spark, folder):
    return text.serialize_rows_patterns(
        _printed(spark, folder), "target", ["nothing"], key_value_separator="^ "
    )


@query("serialize_rows_strict", _pattern_sql([""]))
def _(spark, folder):
    return text.serialize_rows_strict(
        _printed(spark, folder), "target", ["c_custkey", "big", "whole", "name"], key_value_separator="^ "
    )


# --- lengths ----------------------------------------------------------------------------


@query(
    "text_length_stats",
    f"""select lang as split, count(*) as "rows", {r('avg(length(text))')} as avg_chars,
               max(length(text))::INTEGER as max_chars from documents group by 1""",
)
def _(spark, folder):
    return rounded(text.text_length_stats(table(spark, folder, "documents"), "text", "lang"))


@query(
    "text_length_histogram",
    f"""with l as (select length(text) as n from documents),
             e as (select min(n) as lo, max(n) as hi, (max(n) - min(n))::DOUBLE / 50 as w from l),
             b as (select least(floor((n - lo) / w), 49)::INTEGER as bin, lo, w from l, e)
        select bin, {r('lo + bin * w', 3)} as from_chars, {r('lo + (bin + 1) * w', 3)} as to_chars, count(*) as "rows"
        from b group by bin, lo, w""",
)
def _(spark, folder):
    return rounded(text.text_length_histogram(table(spark, folder, "documents")), 3)


# --- tokens -----------------------------------------------------------------------------

_SPACE = "".join(f"\\x{{{code:x}}}" for code in WORD_SPACE)
_WORDS = f"regexp_extract_all(text, '[^{_SPACE}]+')"


@query(
    "tokenize_text",
    f"""with w as (select doc_id, lang, {_WORDS} as all_words from documents)
        select doc_id, lang, md5(array_to_string(all_words[1:256], '|')) as tokens,
               least(len(all_words), 256)::INTEGER as mask_sum, least(len(all_words), 256)::INTEGER as length,
               len(all_words)::INTEGER as raw_length from w""",
)
def _(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "text")
    found = tokens.tokenize_text(documents, "text", 256)
    return found.select(
        "doc_id",
        "lang",
        F.md5(F.array_join("tokens", "|")).alias("tokens"),
        F.aggregate("attention_mask", F.lit(0), lambda a, b: a + b).alias("mask_sum"),
        "length",
        "raw_length",
    )


def _spread_sql(x: str, prefix: str = "") -> str:
    shown = [f"{r(f'avg({x})')} as {prefix}mean", f"max({x}) as {prefix}max", f"min({x}) as {prefix}min"]
    shown += [f"{r(f'quantile_cont({x}, {p / 100})')} as {prefix}p{p}" for p in (50, 75, 90, 95, 99)]
    return ", ".join(shown)


@query(
    "token_length_report",
    f"""with w as (select lang, len({_WORDS})::INTEGER as raw_length from documents),
             t as (select *, least(raw_length, 256)::INTEGER as length from w),
             u as (select lang as split, length, raw_length from t union all select 'overall', length, raw_length from t)
        select split, count(*) as "count", {_spread_sql('length')}, {_spread_sql('raw_length', 'raw_')}
        from u group by 1""",
)
def _(spark, folder):
    documents = table(spark, folder, "documents").select("lang", "text")
    found = tokens.tokenize_text(documents, "text", 256)
    return rounded(tokens.token_length_report(found, split="lang"))


_COUNTED = f"(select len({_WORDS}) as n from documents)"


@query(
    "token_analysis",
    f"""select count(*) as sample_size, {r('avg(n)', 4)} as mean, {r('stddev_pop(n)', 4)} as std,
               min(n)::INTEGER as min, max(n)::INTEGER as max,
               {', '.join(f'floor(quantile_cont(n, {p / 100}))::BIGINT as p{p}' for p in (25, 50, 75, 90, 95, 99))}
        from {_COUNTED}""",
)
def _(spark, folder):
    return rounded(tokens.token_analysis(table(spark, folder, "documents"))[0], 4)


@query(
    "token_bands",
    " union all ".join(
        f"select {i} as step, '{name}' as band, count(*) filter (where {test}) as \"rows\" from {_COUNTED}"
        for i, (name, test) in enumerate(
            [
                ("0-50", "n <= 50"), ("51-100", "n > 50 and n <= 100"), ("101-200", "n > 100 and n <= 200"),
                ("201-300", "n > 200 and n <= 300"), ("301-400", "n > 300 and n <= 400"),
                ("401-500", "n > 400 and n <= 500"), ("500+", "n > 500"),
            ]
        )
    ),
)
def _(spark, folder):
    return tokens.token_analysis(table(spark, folder, "documents"))[1]


@query(
    "token_analysis_sample",
    f"""with s as (select {_WORDS} as w from documents order by md5('42:' || doc_id), doc_id::VARCHAR limit 200)
        select count(*) as sample_size, {r('avg(len(w))', 4)} as mean, max(len(w))::INTEGER as max,
               floor(quantile_cont(len(w), 0.5))::BIGINT as p50 from s""",
)
def _(spark, folder):
    stats = tokens.token_analysis(table(spark, folder, "documents"), sample=200, key="doc_id")[0]
    return rounded(stats.select("sample_size", "mean", "max", "p50"), 4)


@query(
    "recommend_max_length",
    f"""with p as (select floor(quantile_cont(n, 0.95))::BIGINT as p95 from {_COUNTED})
        select any_value(p95) as p95, ((any_value(p95) + 31) // 32 * 32)::BIGINT as recommended_max_length,
               {', '.join(f"{r(f'count(*) filter (where n <= {k})::DOUBLE / count(*)')} as coverage_{k}" for k in (128, 256, 512))}
        from {_COUNTED}, p""",
)
def _(spark, folder):
    found = tokens.tokenize_text(table(spark, folder, "documents").select("text"))
    return rounded(tokens.recommend_max_length(found))


@query("tokenize_text_ids")
def _(spark, folder):
    # Ids of a public vocabulary; no SQL can say them, tests compare them one by one.
    import public_tokenizers

    documents = table(spark, folder, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return tokens.tokenize_once(documents, fresh_path(spark, "token_ids"), vocabulary, max_length=256)[0]
