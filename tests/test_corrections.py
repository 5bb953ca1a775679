"""Results that must not depend on size, partitioning, ties, NaN or odd values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabwright.operators.lookup import code_mapping_report, day_type3, normalize_codes_to_text, period_totals
from tabwright.operators.ordering import number_rows
from tabwright.operators.quantiles import exact_quantiles
from tabwright.operators.rows import dedup_by_key, row_filter_report, row_filters
from tabwright.operators.tokens import tokenize_text
from tabwright.operators.types import date_rejects
from tabwright.sources.tables import materialize_once
from tests.conftest import rows


@pytest.mark.parametrize("parts", [(0.5,), (0.05, 0.98), (0.25, 0.75)])
def test_quantiles_of_ties_do_not_depend_on_size(spark, parts):
    values = [("hot", 500841.56)] * 6798 + [("few", float(i % 7) * 1000) for i in range(500)] + [("zero", 0.0)] * 40
    df = spark.createDataFrame(values, "g string, x double")
    near = exact_quantiles(df, ["g"], F.col("x"), parts)
    far = exact_quantiles(df, ["g"], F.col("x"), parts, task_rows=100)
    assert rows(near) == rows(far) and near.dtypes == far.dtypes


def test_numbers_have_one_type(spark):
    df = spark.range(300).select(F.format_string("%05d", "id").alias("label"))
    near, far = number_rows(df, [F.col("label")]), number_rows(df, [F.col("label")], task_rows=10)
    assert near.schema["id"].dataType == far.schema["id"].dataType and rows(near) == rows(far)


def test_encoder_leaves_other_columns_alone(spark):
    data = [(9007199254740993, dt.date(2024, 1, 6), [1, None], "a bb"), (None, None, None, None), (2**60 + 7, None, [], "ccc")]
    df = spark.createDataFrame(data, "key bigint, day date, list array<bigint>, text string").coalesce(1)
    found = tokenize_text(df, "text", 4, lambda: lambda texts: [[len(w) for w in t.split()] for t in texts])
    assert [(r.key, r.day, r.list, r.input_ids) for r in found.collect()] == [
        (9007199254740993, dt.date(2024, 1, 6), [1, None], [1, 2]), (None, None, None, []), (2**60 + 7, None, [], [3]),
    ]


def test_first_row_of_a_key_does_not_depend_on_partitioning(spark):
    df = spark.range(400).select((F.col("id") % 9).alias("k"), (F.col("id") % 2).alias("o"), F.xxhash64("id").alias("v"))
    found = [rows(dedup_by_key(df.repartition(n), ["k"], keep, ["o"])) for keep in ("first", "last") for n in (1, 3, 7)]
    assert found[0] == found[1] == found[2] and found[3] == found[4] == found[5]


def test_nan_is_missing_in_rules(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 0.9), (3, None), (4, 0.1)], "i int, x double")
    kept = lambda op, value=None: [r.i for r in row_filters(df, [{"column": "x", "operator": op, "value": value}]).collect()]
    assert kept("not_null") == [2, 4] and kept("is_null") == [1, 3]
    assert kept(">", 0.5) == [2] and kept(">=", 0.1) == [2, 4] and kept("!=", 0.9) == [1, 3, 4]
    report = row_filter_report(df, [{"column": "x", "operator": "not_null"}]).first()
    assert (report.rows_before, report.rows_after) == (4, 2)


def test_reports_without_subjects_are_empty(spark):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    for report, other in (
        (row_filter_report(df, [{"column": "none", "operator": "==", "value": 1}]), row_filter_report(df, [{"column": "i", "operator": "==", "value": 1}])),
        (date_rejects(df), date_rejects(df, ["s"])),
    ):
        assert report.collect() == [] and report.dtypes == other.dtypes
    assert code_mapping_report(df, {}).collect() == []
    with pytest.raises(ValueError, match="decade"):
        period_totals(spark.createDataFrame([("20240106",)], "date string"), "date", "decade")


def test_large_codes(spark):
    df = spark.createDataFrame([(1e20,), (float("inf"),), (13.0,), (None,)], "code double")
    found = [r.code for r in normalize_codes_to_text(df, {"code": {"13": "thirteen"}}).collect()]
    assert found[2] == "thirteen" and found[3] is None and found[0].startswith("1")


def test_date_forms(spark):
    forms = ["2024-01-06", "2024/01/06", "2024.01.06", "20240106", "20240106.0", "20240108", "no date", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(forms)], "i int, date string")
    found = {r.i: r[-1] for r in day_type3(df, [], "date").collect()}
    assert len({found[i] for i in range(5)}) == 1 and found[5] != found[0] and found[7] == found[6]


def test_renamed_rows_are_written_again(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert materialize_once(df, str(tmp_path), "s")[1]
    assert not materialize_once(df, str(tmp_path), "s")[1]
    renamed, written = materialize_once(df.toDF("x", "y"), str(tmp_path), "s")
    assert written and renamed.columns == ["x", "y"]
    assert not materialize_once(df.toDF("x", "y"), str(tmp_path), "s")[1]
