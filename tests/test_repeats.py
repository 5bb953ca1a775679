"""Exact sizes where rows repeat or a key is shared, on any partitioning."""

from collections import Counter

import pytest

from tabwright.operators import ordering
from tabwright.operators.sampling import sample_random, sample_rows, sample_size, sample_stratified, subset_splits
from tabwright.operators.splitting import split_ratios, split_two_step
from tabwright.operators.tokens import token_analysis


def split_sizes(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


@pytest.fixture(scope="module")
def ten_kinds(spark):
    return spark.range(1000).selectExpr("cast(id % 10 as string) as label", "cast(id % 10 as int) as x")


def test_split_sizes_of_ten_repeated_rows(ten_kinds):
    assert split_sizes(split_two_step(ten_kinds, "label", 0.13, 0.05)) == {"train": 870, "valid": 80, "test": 50}
    assert split_sizes(split_two_step(ten_kinds, "label", 0.13, 0.05, stratify=False)) == {"train": 870, "valid": 80, "test": 50}
    assert split_sizes(split_ratios(ten_kinds, "label", 0.8, 0.1, 0.1)) == {"train": 800, "val": 100, "test": 100}


def test_stratified_shares_of_repeated_rows(ten_kinds):
    found = Counter((r["label"], r["split"]) for r in split_two_step(ten_kinds, "label", 0.2, 0.1).collect())
    assert found == {(str(i), s): n for i in range(10) for s, n in (("train", 80), ("valid", 10), ("test", 10))}


def test_one_cut_by_class_and_the_other_not(spark):
    # Two rows of one class: the hold-out is by class, its halves are not.
    rows = [("a", 1)] * 300 + [("b", 2)] * 300 + [("c", 3)] * 2
    df = spark.createDataFrame(rows, "label string, x int")
    got = split_two_step(df, "label", 0.01, 0.005)
    assert split_sizes(got) == {"train": 595, "valid": 3, "test": 4}
    assert Counter((r["label"], r["x"]) for r in got.collect()) == Counter(rows)


def test_samples_of_repeated_rows(ten_kinds):
    assert sample_random(ten_kinds, 0.07).count() == 70
    assert sample_size(ten_kinds, 333).count() == 333
    assert {r["count"] for r in sample_stratified(ten_kinds, "label", 0.33).groupBy("label").count().collect()} == {33}
    assert {r["count"] for r in sample_rows(ten_kinds, 7, "label").groupBy("label").count().collect()} == {7}
    assert {r["count"] for r in subset_splits(ten_kinds, 0.5, "label").groupBy("label").count().collect()} == {50}
    stats, _ = token_analysis(ten_kinds.selectExpr("concat('a b ', label) as text"), sample=123)
    assert stats.first()["sample_size"] == 123


def test_a_key_that_many_rows_share(spark):
    df = spark.range(3000).selectExpr("id % 3 as k", "id as x", "cast(null as string) as s")
    for part in (1, 7):
        got = sample_random(df.repartition(part), 0.1, key="k")
        assert got.count() == 300 and len({r["x"] for r in got.collect()}) == 300
    first, second = (sorted(r["x"] for r in sample_random(df.repartition(n), 0.1, key="k").collect()) for n in (2, 5))
    assert first == second
    parts = split_two_step(df, "s", 0.2, 0.1, key="k", stratify=False)
    assert split_sizes(parts) == {"train": 2400, "valid": 300, "test": 300}
    assert sorted(r["x"] for r in parts.collect()) == list(range(3000))


def test_null_and_empty_text_are_two_rows_with_one_key(spark):
    df = spark.createDataFrame([(None,)] * 40 + [("",)] * 40 + [("z",)] * 40, "t string")
    assert {sample_size(df, n).count() for n in (1, 39, 41, 79)} == {1, 39, 41, 79}
    got = Counter(r["t"] for r in sample_size(df, 119).collect())
    assert sum(got.values()) == 119 and all(n <= 40 for n in got.values())


def test_many_copies_are_numbered_in_steps(spark):
    df = spark.range(25_000).selectExpr("id % 2 as x")
    placed = ordering._copies_in_order(df, [])
    assert sorted(r["__place"] for r in placed.collect()) == list(range(25_000))
    assert sample_size(df, 20_001, task_rows=100).count() == 20_001
