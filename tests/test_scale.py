"""The ways around big groups give the same results as the plain ways."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.operators import group_features as gf
from tabwright.operators.ordering import number_rows
from tabwright.operators.quantiles import exact_quantiles
from tabwright.operators.sampling import sample_random, sample_rows, sample_size, sample_stratified, subset_splits
from tabwright.operators.splitting import share_out, split_ratios, split_two_step
from tests.conftest import plan, rows

PROBS = [0.0, 0.05, 0.25, 0.5, 0.98, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """A hot group of continuous values, one of few values, one constant, small ones, NULLs."""
    rng = np.random.default_rng(7)
    parts = [
        pd.DataFrame({"g": "hot", "x": rng.lognormal(3, 2, 40_000)}),
        pd.DataFrame({"g": "few", "x": rng.integers(0, 5, 20_000).astype(float)}),
        pd.DataFrame({"g": "same", "x": np.full(9_000, 3.5)}),
        pd.DataFrame({"g": "one", "x": [42.0]}),
        pd.DataFrame({"g": "two", "x": [1.0, 2.0]}),
        pd.DataFrame({"g": "heap", "x": np.r_[np.zeros(15_000), rng.normal(0, 1, 5_000)]}),
    ]
    data = pd.concat(parts, ignore_index=True)
    df = spark.createDataFrame(data).repartition(6)
    gaps = spark.createDataFrame([("hot", None), ("gap", None), (None, 1.0)], "g string, x double")
    return df.unionByName(gaps), data


@pytest.mark.parametrize("task_rows", [1_000_000, 2_000, 100])
def test_quantiles_per_group(skewed, task_rows):
    df, data = skewed
    found = {r["g"]: r for r in exact_quantiles(df, ["g"], F.col("x"), PROBS, task_rows).collect()}
    for name, part in data.groupby("g"):
        want = np.quantile(part["x"], PROBS)
        got = [found[name][f"q{i}"] for i in range(len(PROBS))]
        assert np.allclose(got, want, rtol=1e-12, atol=1e-12), name
        assert found[name]["n"] == len(part)


@pytest.mark.parametrize("task_rows", [1_000_000, 2_000])
def test_quantiles_of_everything(skewed, task_rows):
    df, data = skewed
    row = exact_quantiles(df.where("g is not null"), [], F.col("x"), PROBS, task_rows).first()
    assert np.allclose([row[f"q{i}"] for i in range(len(PROBS))], np.quantile(data["x"], PROBS), rtol=1e-12)


def test_features_do_not_depend_on_the_way(skewed):
    df, _ = skewed
    config = gf.ZScoreConfig(column="x", group_by="g", clip_min=-3, clip_max=5)
    plain, split = [
        rows(gf.zscore_log(df, config, n)[0].where("g in ('hot', 'heap')").select(
            "g", F.round("x", 9), F.round("x_zscore", 9)))
        for n in (1_000_000, 2_000)
    ]
    assert plain == split


@pytest.fixture(scope="module")
def labelled(spark):
    """A third of the rows has one label."""
    label = F.when(F.col("id") < 3_000, "hot").otherwise(F.concat(F.lit("l"), (F.col("id") % 40).cast("string")))
    return spark.range(9_000).select("id", label.alias("label"))


def brute(df, size_of, by="label", seed=42):
    data = df.toPandas()
    import hashlib

    data["h"] = [hashlib.md5(f"{seed}:{i}".encode()).hexdigest() for i in data["id"]]
    data["k"] = data["id"].astype(str)
    out = []
    for _, part in data.groupby(by) if by else [(None, data)]:
        out += part.sort_values(["h", "k"])["id"].tolist()[: size_of(len(part))]
    return sorted(out)


@pytest.mark.parametrize("task_rows", [1_000_000, 3])
@pytest.mark.parametrize("partitions", [1, 17])
def test_samples(labelled, task_rows, partitions):
    df = labelled.repartition(partitions)

    def ids(found):
        return sorted(r["id"] for r in found.collect())

    got = sample_stratified(df, "label", 0.05, 42, "id", task_rows)
    assert ids(got) == brute(labelled, lambda n: round(0.05 * n))
    assert ids(sample_random(df, 0.01, 42, "id", task_rows)) == brute(labelled, lambda n: int(n * 0.01), None)
    assert ids(sample_size(df, 77, 42, "id", task_rows)) == brute(labelled, lambda n: 77, None)
    assert ids(sample_rows(df, 200, "label", 42, "id", task_rows)) == brute(labelled, lambda n: min(n, 200))
    assert ids(subset_splits(df, 0.3, "label", 42, "id", task_rows)) == brute(labelled, lambda n: int(n * 0.3))


def test_sample_of_rows_without_key(labelled):
    df = labelled.select("label", (F.col("id") * 2).alias("n"))
    a, b = [rows(sample_stratified(df.repartition(n), "label", 0.1)) for n in (2, 5)]
    assert a == b and len(a) == sum(round(0.1 * n) for n in [3000, *[150] * 40])


def test_sample_seeds_differ_and_limits(labelled):
    one, other = [rows(sample_random(labelled, 0.05, seed, "id")) for seed in (1, 2)]
    assert len(one) == len(other) == 450 and one != other
    assert sample_size(labelled, 10**6, key="id").count() == 9_000
    assert sample_random(labelled, 0.00001, key="id").count() == 0
    assert sample_stratified(labelled, "label", 1.5).count() == 9_000


@pytest.mark.parametrize("task_rows", [1_000_000, 3])
def test_two_step_split(labelled, task_rows):
    df = labelled.withColumn("label", F.when(F.col("label") == "l7", None).otherwise(F.col("label")))
    split = split_two_step(df, "label", 0.1, 0.04, 42, "id", task_rows=task_rows)
    again = split_two_step(df.repartition(13), "label", 0.1, 0.04, 42, "id", task_rows=task_rows)
    assert rows(split) == rows(again)
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sizes == {"train": 8100, "valid": 540, "test": 360}
    assert split.select("id").distinct().count() == 9_000
    per = {
        (r["label"], r["split"]): r["count"]
        for r in split.groupBy("label", "split").count().collect()
    }
    assert abs(per["hot", "test"] - 120) <= 1 and abs(per["hot", "valid"] - 180) <= 1
    assert abs(per[None, "train"] - 135) <= 1


def test_split_falls_back_to_random(spark):
    df = spark.range(200).select("id", F.when(F.col("id") == 0, "rare").otherwise("often").alias("label"))
    sizes = lambda d: {r["split"]: r["count"] for r in d.groupBy("split").count().collect()}
    assert sizes(split_two_step(df, "label", 0.2, 0.1, key="id")) == {"train": 160, "valid": 20, "test": 20}
    assert sizes(split_ratios(df, "label", 0.8, 0.1, 0.1, key="id")) == {"train": 160, "val": 20, "test": 20}


def test_second_cut_falls_back(spark):
    # Labels of four rows: one row of each is held out, too few to cut again by label.
    df = spark.range(400).select("id", (F.col("id") % 100).cast("string").alias("label"))
    got = split_two_step(df, "label", 0.25, 0.125, key="id")
    sizes = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert sizes == {"train": 300, "valid": 50, "test": 50}
    train = got.where("split = 'train'").groupBy("label").count().select("count").distinct().collect()
    assert [r[0] for r in train] == [3]


def test_split_arguments(labelled):
    for test, val in [(0, 0.1), (1, 0.5), (0.2, 0), (0.2, 0.2), (0.1, 0.3)]:
        with pytest.raises(ValueError):
            split_two_step(labelled, "label", test, val)
    with pytest.raises(ValueError):
        split_two_step(labelled, "nothing", 0.2, 0.1)


def test_shares_add_up_in_both_ways(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 11), ("c", 1), ("d", 7)], "label string, count bigint")
    a = rows(share_out(sizes, "label", 10, 29, 4))
    b = rows(share_out(sizes, "label", 10, 29, 10**9))
    assert sum(r[2] for r in a) == 10
    assert [tuple(map(str, r)) for r in a] == [tuple(map(str, r)) for r in b]


def test_numbering_in_ranges(spark):
    df = spark.range(5_000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("k"))
    few = rows(number_rows(df, [F.col("k")]))
    many = rows(number_rows(df.repartition(7), [F.col("k")], task_rows=100))
    assert [(a, int(b)) for a, b in few] == [(a, int(b)) for a, b in many]


def test_row_passes_have_no_shuffle_and_no_python(labelled):
    df = sample_stratified(labelled, "label", 0.1, 42, "id")
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in final and "BroadcastHashJoin" in final
    split = split_two_step(labelled, "label", 0.1, 0.05, 42, "id")
    final = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in final
    for text in (plan(df), plan(split)):
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_large_parameter_tables_are_not_broadcast(spark, skewed):
    df, _ = skewed
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = rows(gf.robust_standardize(df, "g", "x")[0])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = gf.robust_standardize(df, "g", "x")[0]
        assert "Broadcast" not in plan(got)
        assert rows(got) == want
        split = split_two_step(df.where("g is not null").withColumn("id", F.monotonically_increasing_id()), "g", 0.1, 0.05, 42, ["g", "x", "id"])
        assert "BroadcastHashJoin" not in plan(split)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
