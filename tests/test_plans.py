"""One class table per plan, rows per step, and quantiles whose enclosure fails."""

import pytest
from pyspark.sql import functions as F

from tabwright.operators import quantiles
from tabwright.operators.classes import class_table, class_tables
from tabwright.operators.labels import encode_labels, label_mapping_create, label_names, label_slots, with_label_names
from tabwright.operators.profile import class_distribution, column_statistics, infer_num_labels, split_stats
from tabwright.operators.rows import dedup_by_key, row_filters
from tabwright.operators.splitting import split_ratios, split_two_step
from tabwright.operators.trace import RowTrace
from tabwright.operators.types import narrow_report
from tabwright.sources.shared import checkpoint_stage, settle_with
from tests.conftest import rows


@pytest.fixture(scope="module")
def labelled(spark):
    some = F.when(F.col("id") % 50 == 7, None).otherwise(F.concat(F.lit("c"), (F.col("id") % 9).cast("string")))
    return spark.range(900).select("id", some.alias("label"))


def test_facts_of_written_tables(spark):
    table, facts = settle_with(spark.range(10), n=F.count(F.lit(1)), most=F.max("id"))
    assert table.count() == 10 and facts == {"n": 10, "most": 9}
    table, facts = settle_with(spark.range(10).where("id > 20"), n=F.count(F.lit(1)), most=F.max("id"))
    assert table.count() == 0 and facts == {"n": 0, "most": None}
    nothing = spark.createDataFrame([], "x int")
    assert settle_with(nothing, n=F.count(F.lit(1)))[1] == {"n": 0}


def test_class_tables(labelled):
    every, kept = class_tables(labelled, "label", 100)
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    assert (every.rows, every.classes, every.smallest, every.unlabelled) == (900, 10, min(counts.values()), counts[None])
    large = {k: n for k, n in counts.items() if k and n >= 100}
    assert (kept.rows, kept.named, kept.unlabelled) == (sum(large.values()), len(large), 0)
    assert {r["label"]: r["count"] for r in kept.table.collect()} == large


def test_known_classes_change_nothing(labelled):
    known = class_table(labelled, "label")
    assert rows(label_slots(labelled, "label", 12)) == rows(label_slots(labelled, "label", 12, classes=known))
    assert rows(label_mapping_create(labelled, "label", 12)) == rows(label_mapping_create(labelled, "label", 12, classes=known))
    assert rows(split_two_step(labelled, "label", 0.2, 0.1, key="id")) == rows(split_two_step(labelled, "label", 0.2, 0.1, key="id", classes=known))
    assert rows(split_ratios(labelled, "label", key="id")) == rows(split_ratios(labelled, "label", key="id", classes=known))
    for a, b in zip(class_distribution(labelled, "label"), class_distribution(labelled, "label", classes=known), strict=True):
        assert rows(a) == rows(b)
    with pytest.raises(ValueError):
        label_slots(labelled, "label", 5, classes=known)


def test_placeholders_among_the_labels_are_found(spark):
    df = spark.createDataFrame([("a",), ("dummy_2",), ("b",)], "label string")
    assert rows(label_slots(df, "label", 4)) == rows(label_slots(df, "label", 4, classes=class_table(df, "label")))


def test_empty_tables(spark):
    df = spark.createDataFrame([], "label string, id bigint")
    table = class_table(df, "label")
    assert (table.rows, table.classes, table.smallest) == (0, 0, 0)
    assert split_two_step(df, "label", 0.2, 0.1, key="id").count() == 0
    assert split_ratios(df, "label").count() == 0
    assert split_stats(df.withColumn("split", F.lit("x"))).count() == 0
    assert [r["unique_count"] for r in column_statistics(df).collect()] == [0, 0]
    assert narrow_report(df, exact=False).count() == 2


def test_trace_counts_what_passes(spark):
    trace = RowTrace()
    df = trace.step("all", spark.range(100))
    df = trace.step("even", df.where("id % 2 = 0"))
    df = trace.step("none", df.where("id < 0"))
    checkpoint_stage(df, "traced")
    trace.known("later", 0)
    assert [tuple(r)[1:] for r in trace.report(spark).orderBy("step").collect()] == [
        ("all", 100, 100, 0), ("even", 100, 50, 50), ("none", 50, 0, 50), ("later", 0, 0, 0),
    ]


def test_first_filter_still_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    trace = RowTrace()
    df = trace.step("rules", row_filters(orders, [{"column": "o_totalprice", "operator": ">", "value": 5000.0}]))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,5000.0)" in text


def test_quantiles_outside_their_enclosure_are_found_again(spark):
    values = spark.range(20_000).selectExpr("id % 2 as g", "cast((id * 7919) % 20011 as double) as __x")
    want = {
        r["g"]: r["q"]
        for r in values.groupBy("g").agg(F.percentile("__x", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("q")).collect()
    }
    # Enclosures of no width hold one value, which is not both order statistics.
    got = quantiles._bracketed(values, ["g"], [0.1, 0.5, 0.9], 10_000, 100, margin=1e-9)
    assert {r["g"]: [r["q0"], r["q1"], r["q2"]] for r in got.collect()} == want


def test_statistics_by_both_ways(spark):
    df = spark.range(30_000).selectExpr("id", "cast(id % 1000 as double) / 3 as x", "cast(id % 77 as string) as s", "cast(null as int) as e")
    exact = {r["column"]: r for r in column_statistics(df).collect()}
    for task_rows in (1_000_000, 100):
        about = {r["column"]: r for r in column_statistics(df, exact_distinct=False, task_rows=task_rows).collect()}
        for n in df.columns:
            assert (about[n]["q1"], about[n]["median"], about[n]["q3"]) == (exact[n]["q1"], exact[n]["median"], exact[n]["q3"])
            assert abs(about[n]["unique_count"] - exact[n]["unique_count"]) <= 0.2 * exact[n]["unique_count"]
    assert exact["x"]["unique_count"] == 1000 and exact["e"]["median"] is None
    assert exact["id"]["median"] == 14_999.5


def test_sketched_report_counts_only_near_the_ratio(spark):
    df = spark.range(10_000).selectExpr("cast(id as string) as many", "cast(id % 10 as string) as few", "cast(id % 5100 as string) as near")
    exact, about = ({r["column"]: r for r in narrow_report(df, 0.5, exact=e).collect()} for e in (True, False))
    assert {n: r["category_candidate"] for n, r in exact.items()} == {n: r["category_candidate"] for n, r in about.items()}
    assert about["near"]["distinct_count"] == 5100 and about["few"]["distinct_count"] == 10
    assert abs(about["many"]["distinct_count"] - 10_000) < 1500


def test_names_stay_with_written_ids(spark, labelled, tmp_path):
    slots = label_slots(labelled, "label", 12)
    coded = with_label_names(encode_labels(labelled, slots, "label"), slots)
    coded.write.parquet(str(tmp_path / "coded"))
    back = spark.read.parquet(str(tmp_path / "coded"))
    assert sorted(map(tuple, label_names(back).collect())) == sorted((r["id"], r["label"]) for r in slots.collect())
    assert infer_num_labels(back).first()["num_labels"] == 12
    with pytest.raises(ValueError):
        label_names(labelled, "id")


def test_one_row_of_a_key_travels_once(spark):
    df = spark.createDataFrame([(1, None, "z"), (1, 2, "b"), (1, 2, "a"), (2, None, None), (2, 5, None)], "k int, o int, t string")
    assert rows(dedup_by_key(df, ["k"], "first", ["o"])) == [(1, 2, "a"), (2, 5, None)]
    assert rows(dedup_by_key(df, ["k"], "last", ["o"])) == [(1, None, "z"), (2, None, None)]


def test_rules_on_codes_reach_the_scan(spark, tmp_path):
    from tabwright.plans.vouchers import BaseTableConfig, base_table, possible_rows
    from tabwright.operators.naming import standardize_columns

    raw = spark.range(400).selectExpr(
        "cast(1990 + id % 10 as double) as year", "cast(id % 4 as bigint) as kind", "cast(if(id % 7 = 0, null, id) as double) as party",
        "concat('a', id % 3) as acct_code", "concat(1990 + id % 10, '0101') as some_date",
    )
    raw.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    config = BaseTableConfig(
        features=["year", "kind", "party"], dropna_columns=["party", "year"],
        keep=[{"column": "year", "values": ["1993", "1995"]}, {"column": "kind", "values": ["1", "3"]}, {"column": "some_date", "values": ["19930101"]}],
    )
    text = possible_rows(standardize_columns(raw, None), config)._jdf.queryExecution().executedPlan().toString()
    assert "In(year, [1993.0,1995.0])" in text and "In(kind, [1,3])" in text and "IsNotNull(party)" in text
    config = BaseTableConfig(features=["year", "kind", "party"], dropna_columns=["party", "year"], keep=config.keep[:2])
    trace = RowTrace()
    plain = base_table(raw, config, trace)  # a trace sees every row, so nothing is left out before it
    assert rows(base_table(raw, config)) == rows(plain) and plain.count() > 0
    assert trace.report(spark).where("stage = 'raw'").first()["rows_out"] == 400


def test_float_rules_treat_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (float("nan"),), (None,)], "x double")
    got = {op: sorted(map(str, (r["x"] for r in row_filters(df, [{"column": "x", "operator": op, "value": 2.0}]).collect()))) for op in ("==", "!=", ">", "<", ">=", "<=")}
    assert got == {"==": [], "!=": ["1.0", "5.0", "None", "nan"], ">": ["5.0"], "<": ["1.0"], ">=": ["5.0"], "<=": ["1.0"]}
