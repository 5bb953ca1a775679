"""One value at a time: rounding, reading, printing, dates, missing values."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.functions.numbers import half_even
from tabwright.functions.text import word_count, words
from tabwright.operators import lookup, naming, rows, text, types
from tabwright.sources.tables import fold_nan, read_table
from tests.conftest import rows as collected


def column(df, name):
    return [r[name] for r in df.collect()]


def test_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert column(df.select(half_even(F.col("x")).alias("x")), "x") == [0.0, 2.0, 2.0, -0.0]
    df = spark.createDataFrame([(1.00005,), (2.00015,), (9.99995,)], "x double")
    assert column(df.select(half_even(F.col("x"), 4).alias("x")), "x") == np.round([1.00005, 2.00015, 9.99995], 4).tolist()


def test_amount_reading(spark):
    values = ["12.5", " 7 ", "1e3", "-.5", "abc", "1d", "2f", "0x1p3", "", None, "NaN", "inf", "1,000"]
    df = spark.createDataFrame([(v,) for v in values], "amount string")
    got = column(types.normalize_amounts(df), "amount")
    assert got == [12.5, 7.0, 1000.0, -0.5, None, None, None, None, None, None, None, math.inf, None]


def test_amounts_fold_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "amount double")
    assert column(types.normalize_amounts(df), "amount") == [None, 1.0, None]
    assert column(fold_nan(df), "amount") == [None, 1.0, None]


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("20240101", 20240101), ("20240101.0", 20240101), ("on 20240101 x", 20240101),
        ("2024-01-01", None), ("202401011", None), ("2024", None), ("none", None), ("", None),
        (None, None), ("x1 20240101", None),
    ],
)
def test_text_dates(spark, value, want):
    df = spark.createDataFrame([(value,)], "date string")
    assert column(types.normalize_dates(df), "date") == [want]


def test_number_dates(spark):
    df = spark.createDataFrame(
        [(20240101.0, 20240101), (20240101.5, 2024), (None, None), (123456789.0, -20240101)],
        "date double, int_date bigint",
    )
    got = types.normalize_dates(df)
    assert column(got, "date") == [20240101, 20240101, None, None]
    assert column(got, "int_date") == [20240101, None, None, 20240101]


def test_date_rejects_count_and_sample(spark):
    values = ["2024-01-01"] * 5 + [f"{i}" for i in range(100, 120)] + ["20240101", None, "x"]
    df = spark.createDataFrame([(v,) for v in values], "date string").repartition(7)
    row = types.date_rejects(df).first()
    assert (row["column"], row["rejected"]) == ("date", 25)
    assert row["samples"] == ["100", "101", "102", "103", "104"]


def test_codes(spark):
    df = spark.createDataFrame(
        [(13.0, 7, True, "x"), (None, None, None, None), (float("nan"), 0, False, "")],
        "a double, b bigint, c boolean, d string",
    )
    assert [tuple(r) for r in types.normalize_codes(df).collect()] == [
        ("13", "7", "True", "x"), (None, None, None, None), (None, "0", "False", ""),
    ]


def test_code_with_fraction(spark):
    df = spark.createDataFrame([(13.0,), (1.5,)], "code double")
    with pytest.raises(Exception, match="fraction"):
        types.normalize_codes(df).collect()
    assert column(types.normalize_codes(df, fraction="keep"), "code") == ["13", "1.5"]


def test_types_by_name(spark):
    df = spark.createDataFrame(
        [(20240101.0, "5", "9.5", 3.0)], "Close_Date double, date_amount string, amount string, n double"
    )
    got = types.transform_dtype(df)
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "double", "double", "string"]
    assert tuple(got.first()) == (20240101, None, 9.5, "3")


def test_narrow_types(spark):
    df = spark.createDataFrame(
        [(1, 40000, 2**40, 0.5, 123456.785, "a", 5), (100, -5, 0, 0.25, 0.1, "a", 6), (3, 0, 0, 0.0, 0.0, "b", 7)],
        "a bigint, b bigint, c bigint, d double, e double, s string, label bigint",
    )
    got, report = types.narrow_types(df, exclude=["label"])
    assert [f.dataType.simpleString() for f in got.schema] == [
        "tinyint", "int", "bigint", "float", "double", "string", "bigint",
    ]
    assert [tuple(r)[:4] for r in got.orderBy("label").collect()] == [
        (1, 40000, 2**40, 0.5), (100, -5, 0, 0.25), (3, 0, 0, 0.0),
    ]
    by = {r["column"]: r for r in report.collect()}
    assert by["s"]["distinct_count"] == 2 and not by["s"]["category_candidate"]


def test_amount_text(spark):
    values = [0.0, 1000.0, -12345.678, 9.99995, 1.00005, 0.00012, 1e15, None, -1.0]
    df = spark.createDataFrame([(v,) for v in values], "amount double")
    assert column(text.format_amounts(df), "amount") == [
        "sign=0| mant=0.0000| exponent=0",
        "sign=1| mant=1.0000| exponent=3",
        "sign=-1| mant=1.2346| exponent=4",
        "sign=1| mant=10.0000| exponent=0",
        "sign=1| mant=1.0001| exponent=0",
        "sign=1| mant=1.2000| exponent=-4",
        "sign=1| mant=1.0000| exponent=15",
        None,
        "sign=-1| mant=1.0000| exponent=0",
    ]


def test_date_text(spark):
    df = spark.createDataFrame([(20240229,), (20230229,), (None,), (7,)], "date int")
    assert column(text.format_dates(df), "date") == ["2024-02-29", None, None, None]


def test_missing_spellings(spark):
    values = [None, "", "nan", "NaN", "None", "<NA>", "NULL", "x", "null"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert column(text.fill_missing_text(df), "s") == ["NULL"] * 7 + ["x", "null"]


def test_serialise_with_patterns(spark):
    df = spark.createDataFrame(
        [(12345678.5, 3.0, "N/A", "y"), (None, 1e-7, "", "n"), (-0.5, 1e16, "a^ b", None)],
        "x double, w double, s string, t string",
    )
    got = text.serialize_rows_patterns(df, "t")
    assert [r["text"] for r in got.collect()] == [
        "x:12345678.5^ w:3^ s:None",
        "x:None^ w:0.0000001^ s:None",
        "x:-0.5^ w:10000000000000000^ s:a^ b",
    ]
    strict = text.serialize_rows_strict(df, "t", ["s"], include_column_names=False)
    assert [r["text"] for r in strict.collect()] == ["N/A", "None", "a^ b"]
    assert [r["original_labels"] for r in got.collect()] == ["y", "n", None]


def test_text_columns_leave_out_the_label(spark):
    df = spark.createDataFrame([("a", "L", 0, "train")], "f string, my_label string, labels int, split string")
    got = text.serialize_rows(df, label="my_label")
    assert tuple(got.first()) == ("train", 0, "f: a")
    assert got.columns == ["split", "labels", "text"]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["회사.회사명", "New Col-1", "id"])
    assert naming.standardize_columns(df).columns == ["company_name", "new_col_1", "id"]
    renamed, done = naming.rename_from_mapping(df, {"id": "key", "zz": "y"})
    assert renamed.columns == ["회사.회사명", "New Col-1", "key"] and done == {"id": "key"}
    assert naming.drop_columns(df, ["회사.회사명", "zz"]).columns == ["New Col-1", "id"]
    assert naming.missing_columns(df, ["id", "b", "a"]) == ["b", "a"]
    with pytest.raises(ValueError, match="label"):
        naming.select_features(df, ["id"], "label")


def test_select_features_keeps_order_and_drops(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (2, None, "y")], "n int, label string, f string")
    got = naming.select_features(df, ["f", "label", "n", "f", "zz"], "label")
    assert got.columns == ["f", "label", "n"]
    assert collected(got) == [("x", "a", 1)]


DAYS = [
    (20240309, "holiday", "weekend"),  # Saturday
    (20240301, "holiday", "holiday"),  # Friday, fixed holiday
    (20240304, "workday", "weekday"),
    (20240310, "holiday", "weekend"),  # Sunday
    (None, "workday", None),
    (20241399, "workday", None),
]


def test_day_types(spark):
    df = spark.createDataFrame([(d,) for d, _, _ in DAYS], "date int")
    holidays = lookup.fixed_holidays([2024])
    assert column(lookup.day_type2(df, holidays), "day_type") == [a for _, a, _ in DAYS]
    assert column(lookup.day_type3(df, holidays, "date"), "day_type") == [b for _, _, b in DAYS]
    iso = spark.createDataFrame([("2024-03-01",), ("2024-03-04 10:00:00",)], "date string")
    assert column(lookup.day_type3(iso, holidays, "date"), "day_type") == ["holiday", "weekday"]
    table = spark.createDataFrame([(dt.date(2024, 3, 4),)], "date date")
    assert column(lookup.day_type2(df, table), "day_type")[2] == "holiday"


def test_code_maps(spark):
    df = spark.createDataFrame(
        [(1.0, "10", None), (None, "99", "nan"), (9.0, None, "")],
        "vat_message_code double, document_type string, own string",
    )
    got = lookup.normalize_codes_to_text(df, {"own": {"nan": "missing"}, "nothing": {"a": "b"}})
    assert [tuple(r) for r in got.collect()] == [
        ("standard", "tax_invoice", None), ("unregistered", "99", "missing"), ("9", None, ""),
    ]


def test_large_code_map_is_joined(spark):
    codes = {str(i): f"t{i}" for i in range(1000)}
    df = spark.range(3).select(F.col("id").cast("double").alias("a"), "id")
    got = lookup.normalize_codes_to_text(df, {"a": codes})
    assert collected(got) == [("t0", 0), ("t1", 1), ("t2", 2)]
    got = lookup.categorize_accounts(df.select(F.col("id").alias("account")), codes)
    assert collected(got) == [(0, "t0"), (1, "t1"), (2, "t2")]


def test_last_category_wins(spark):
    df = spark.createDataFrame([("Cash from Sales",), ("STOCK loan",), (None,), ("x",)], "account string")
    assert column(lookup.tax_category(df), "tax_category") == ["asset", "equity", "Other", "Other"]


SPACED = ["", "  ", "a", " a\tb　c\xa0d ", "x\x1cy\x85z", "a b​c", "\n\n\r\nq", "tab\x0bvt\x0cff"]


def test_words_are_python_words(spark):
    df = spark.createDataFrame([(s,) for s in SPACED], "s string")
    assert column(df.select(words(F.col("s")).alias("w")), "w") == [s.split() for s in SPACED]
    assert column(df.select(word_count(F.col("s")).alias("n")), "n") == [len(s.split()) for s in SPACED]


def test_filters_and_missing(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("b", float("nan")), (None, None), ("c", 5.0)], "k string, x double"
    )
    keys = lambda d: sorted(column(d, "k"), key=str)
    assert keys(rows.drop_nulls(df, ["x", "zz"])) == ["a", "c"]
    assert set(column(rows.keep_rows(df, [{"column": "k", "values": ["a", None]}]), "k")) == {"a", None}
    assert set(column(rows.drop_rows(df, [{"column": "k", "values": ["a"]}]), "k")) == {"b", None, "c"}
    assert set(column(rows.drop_rows(df, [{"column": "k", "values": ["a", None]}]), "k")) == {"b", "c"}
    assert keys(rows.range_filter(df, "x", low=0.0)) == ["a", "c"]
    assert keys(rows.range_filter(df, "x", 0.0, 2.0)) == ["a"]
    assert set(column(rows.row_filters(df, [{"column": "k", "operator": "!=", "value": "a"}]), "k")) == {"b", None, "c"}
    assert rows.row_filters(df, [{"column": "k", "operator": "?", "value": 1}]).count() == 4
    assert rows.row_filters(df, [{"column": "k", "operator": "==", "value": None}]).count() == 0


def test_observed_filters_agree_with_report(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("a", 4)], "k string, x int")
    rules = [{"column": "x", "operator": ">", "value": 1}, {"column": "k", "operator": "!=", "value": "b"}]
    filtered, watch = rows.observed_row_filters(df, rules)
    assert filtered.count() == 2
    report = rows.row_filter_report(df, rules).orderBy("step").collect()
    assert [r["rows_after"] for r in report] == [watch.get["left1"], watch.get["left2"]] == [3, 2]


def test_empty_table(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "none"))
    with pytest.raises(ValueError, match="empty"):
        read_table(spark, str(tmp_path / "none"))


def test_dedup_by_key_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("k", 2, None), ("k", 1, "z"), ("k", 1, None), (None, 5, "a"), (None, 4, "b")], "k string, o int, v string"
    )
    assert collected(rows.dedup_by_key(df, ["k"])) == sorted([("k", 1, "z"), (None, 4, "b")], key=repr)
    assert collected(rows.dedup_by_key(df, ["k"], "last")) == sorted([("k", 2, None), (None, 5, "a")], key=repr)
    assert rows.duplicates_removed(df.unionByName(df)).first()["rows_removed"] == 5


def test_class_filters(spark):
    df = spark.createDataFrame([(x,) for x in ["a"] * 4 + ["b"] * 3 + ["c"] * 2 + [None]], "label string")
    assert set(column(rows.filter_minority_classes(df, "label", 2), "label")) == {"a", "b"}
    assert set(column(rows.class_filter(df, "label", 2), "label")) == {"a", "b", "c"}
    assert rows.filter_minority_classes(df, "label", 0).count() == 10
    with pytest.raises(ValueError, match="1 label"):
        rows.filter_minority_classes(df, "label", 3)
    report = rows.class_filter_report(df, "label", 3).first()
    assert (report["removed_classes"], report["removed_rows"]) == (1, 3)
