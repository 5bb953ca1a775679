"""Labels, profiles, metrics, tokens and storage on small tables."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import group_features as gf
from tabwright.operators import labels, metrics, profile, text, tokens
from tabwright.plans.staged import StagedConfig, staged_text
from tabwright.sources import tables
from tabwright.sources.packaging import package_dataset, read_package
from tabwright.sources.shared import settle
from tests.conftest import plan, rows


def names(df):
    return [r["label"] for r in df.orderBy("id").collect()]


# --- labels -----------------------------------------------------------------------------


def test_slots_overflow_and_placeholder_names(spark):
    df = spark.createDataFrame([("b",), ("a",), ("dummy_1",), (None,), ("dummy_9",)], "y string")
    assert names(labels.label_slots(df, "y", 4)) == ["a", "b", "dummy_9", "dummy_4"]
    assert names(labels.label_slots(df, "y", 9)) == ["a", "b", *[f"dummy_{i}" for i in range(3, 10)]]
    with pytest.raises(ValueError, match="fit"):
        labels.label_slots(df, "y", 2)


def test_mapping_grows_or_refuses(spark):
    old = labels.label_mapping_create(spark.createDataFrame([("m",), ("k",)], "y string"), "y", 3)
    assert names(old) == ["k", "m", "DUMMY_000"]
    df = spark.createDataFrame([("z",), ("a",), ("m",)], "y string")
    new = labels.label_mapping_update(df, "y", old, 3)
    assert names(new) == ["k", "m", "a", "z"]
    assert rows(new.where("is_new").select("label")) == [("a",), ("z",)]
    assert names(labels.label_mapping_update(df, "y", old, 6))[4:] == ["DUMMY_000", "DUMMY_001"]
    with pytest.raises(ValueError, match="fit"):
        labels.label_mapping_update(df, "y", old, 3, overflow="error")


def test_encoding(spark):
    slots = settle(labels.label_slots(spark.createDataFrame([("a",), ("b",)], "y string"), "y", 3))
    df = spark.createDataFrame([("b",), ("q",), (None,)], "y string")
    assert [r["labels"] for r in labels.encode_labels(df, slots, "y").collect()] == [1, 0, 0]
    coded = labels.encode_labels(df, slots, "y", unknown_id=-1)
    assert [r["labels"] for r in coded.collect()] == [1, -1, -1]
    named = labels.with_label_names(coded, slots)
    assert named.schema["labels"].metadata["labels"] == ["a", "b", "dummy_3"]
    assert profile.infer_num_labels(named).first()[0] == 3
    assert profile.infer_num_labels(coded).first()[0] == 2


# --- profiles ---------------------------------------------------------------------------


def test_statistics_with_gaps(spark):
    df = spark.createDataFrame(
        [(1.0, "a", None), (float("nan"), "a", None), (0.0, None, None), (-0.0, "b", None), (4.0, "", None)],
        "x double, s string, e int",
    )
    got = {r["column"]: r for r in profile.column_statistics(df).collect()}
    x = got["x"]
    assert (x["count"], x["null_count"], x["unique_count"]) == (4, 1, 3)
    want = np.array([1.0, 0.0, 0.0, 4.0])
    assert np.allclose(
        [x["mean"], x["std"], x["min"], x["max"], x["median"], x["q1"], x["q3"]],
        [want.mean(), want.std(ddof=1), 0, 4, *np.quantile(want, [0.5, 0.25, 0.75])],
    )
    assert (got["s"]["unique_count"], got["s"]["mean"]) == (3, None)
    assert (got["e"]["count"], got["e"]["unique_count"], got["e"]["median"]) == (0, 0, None)
    missing = {r["column"]: r["null_ratio"] for r in profile.missing_stats(df).collect()}
    assert missing == {"x": 0.2, "s": 0.2, "e": 1.0}
    assert {r["null_ratio"] for r in profile.missing_stats(df.limit(0)).collect()} == {0.0}


def test_profile_diff(spark):
    make = lambda data: spark.createDataFrame(data, "column string, metric string, value string")
    then = make([("a", "n", "1"), ("b", "n", None), ("c", "n", "3")])
    now = make([("a", "n", "2"), ("b", "n", None), ("d", "n", "4")])
    assert rows(profile.profile_diff(now, then)) == [
        ("a", "n", "1", "2", "changed"), ("d", "n", None, "4", "added"),
    ]
    assert profile.profile_diff(now, then, include_removed=True).count() == 3
    assert profile.profile_diff(now).count() == 3


# --- weights and metrics ----------------------------------------------------------------


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 100 + [(2,)] * 3 + [(None,)], "labels int")
    got = [r["weight"] for r in metrics.class_weights(df, "labels", 4, 0.3, 0.2, 3.0).orderBy("id").collect()]
    raw = np.clip(np.power(1.0 / np.array([100, 1, 3, 1]), 0.3), 0.2, 3.0)
    assert np.allclose(got, raw / raw.mean(), rtol=1e-6)
    off = metrics.class_weights(df, "labels", 4, 0.3, 0.2, 3.0, enabled=False)
    assert {r["weight"] for r in off.collect()} == {1.0}
    for bad in ((0, 0.2, 3.0), (4, 3.0, 0.2)):
        with pytest.raises(ValueError):
            metrics.class_weights(df, "labels", bad[0], 0.3, *bad[1:])


def test_metrics_by_hand(spark):
    # Class 2 is never predicted, class 3 never true.
    pairs = [(0, 0), (0, 0), (0, 1), (1, 1), (2, 3), (2, 0)]
    df = spark.createDataFrame(pairs, "label int, pred int")
    got = metrics.classification_metrics(df).first()
    y, p = np.array(pairs).T
    f1, prec, rec, support = [], [], [], []
    for k in range(4):
        tp = int(((y == k) & (p == k)).sum())
        np_, ns = int((p == k).sum()), int((y == k).sum())
        prec.append(tp / np_ if np_ else 0.0)
        rec.append(tp / ns if ns else 0.0)
        f1.append(2 * tp / (np_ + ns) if np_ + ns else 0.0)
        support.append(ns)
    w = np.array(support) / len(pairs)
    assert np.allclose(
        [got["accuracy"], got["f1_weighted"], got["f1_macro"], got["precision"], got["recall"]],
        [3 / 6, w @ f1, np.mean(f1), w @ prec, w @ rec],
    )
    money = spark.createDataFrame([(0, 1, 30.0), (0, 0, 70.0)], "label int, pred int, amount double")
    row = metrics.misclassified_amount(money, "amount", by=[]).first()
    assert (row["misclassified_amount"], row["misclassified_share"]) == (30.0, 0.3)


# --- group features ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def groups(spark):
    data = [("g", x) for x in (1.0, -2.0, 3.0, 4.0, 100.0)] + [("g", None)]
    data += [("flat", 5.0)] * 4 + [("flat", None), ("one", 7.0), (None, 1.0)]
    data += [("two", 1.0), ("two", 9.0)] + [("none", None)] * 4
    return spark.createDataFrame(data, "g string, x double")


def test_robust(groups):
    got, parameters = gf.robust_standardize(groups, "g", "x")
    state = {r["g"]: (r["state"], r["rows"], r["sample_count"], r["outlier_removed"]) for r in parameters.collect()}
    assert state == {
        "g": ("scaled", 6, 4, 2), "flat": ("degenerate", 5, 4, 1), "one": ("skipped", 1, 1, 0),
        "two": ("skipped", 2, 2, 0), "none": ("skipped", 4, 0, 4),
    }
    z = (np.array([1, 2, 3, 4, 100]) - 2.5) / np.std([1, 2, 3, 4], ddof=1)
    want = np.round(np.clip(1 + (z + 1) * 99 / 6, 1, 100))
    scaled = {(r["g"], r["x"]): r["x_scaled"] for r in got.collect()}
    assert [scaled["g", x] for x in (1.0, -2.0, 3.0, 4.0, 100.0)] == want.tolist()
    assert scaled["g", None] is None and scaled["flat", 5.0] == 50.5 and scaled["flat", None] == 50.5
    assert scaled["one", 7.0] is scaled[None, 1.0] is scaled["none", None] is None
    other = gf.robust_standardize(groups, "g", "x", degenerate="as_reference")[0]
    assert {r["x_scaled"] for r in other.where("g = 'flat'").collect()} == {100.0}
    with pytest.raises(ValueError, match="outlier"):
        gf.robust_standardize(groups, "g", "x", method="guess")


def test_zscore(groups):
    config = gf.ZScoreConfig(
        column="x", group_by="g", clip_min=-3, clip_max=5, linear=True, target_max=10, log_epsilon=0.1
    )
    got, parameters = gf.zscore_log(groups, config)
    known = {r["g"]: r for r in parameters.collect()}
    assert set(known) == {"g", "flat", "one", "two"}
    assert known["one"]["std"] is None and known["flat"]["std"] == 0 and known["g"]["outliers_removed"] == 1
    log = np.log(np.array([1, 2, 3, 4, 100]) + 0.1)
    z = np.clip((log - log[:4].mean()) / log[:4].std(ddof=1), -3, 5)
    want = np.round(1 + (z + 3) * 9 / 8)
    scaled = {(r["g"], r["x"]): r["x_zscore"] for r in got.collect()}
    assert [scaled["g", x] for x in (1.0, -2.0, 3.0, 4.0, 100.0)] == want.tolist()
    assert scaled["g", None] is scaled["flat", 5.0] is scaled["one", 7.0] is scaled[None, 1.0] is None
    again = gf.apply_zscore(groups, parameters, config)
    assert rows(again) == rows(got)
    with pytest.raises(ValueError, match="finite"):
        gf.ZScoreConfig(column="x", linear=True)


# --- tokens -----------------------------------------------------------------------------


def letters():
    """An encoder that gives every character a number."""
    return lambda texts: [[ord(ch) for ch in t] for t in texts]


def test_injected_encoder(spark):
    df = spark.createDataFrame([("abc", 1, "train"), ("", 2, "test"), (None, 3, "test")], "text string, labels int, split string")
    got = tokens.tokenize_text(df, max_length=2, make_encoder=letters).orderBy("labels").collect()
    assert [(r["input_ids"], r["attention_mask"], r["length"], r["raw_length"]) for r in got] == [
        ([97, 98], [1, 1], 2, 3), ([], [], 0, 0), ([], [], 0, 0),
    ]
    padded = tokens.tokenize_text(df, max_length=4, make_encoder=letters, pad_to_max=True, pad_id=9)
    first = padded.orderBy("labels").first()
    assert (first["input_ids"], first["attention_mask"], first["length"]) == ([97, 98, 99, 9], [1, 1, 1, 0], 4)


def test_real_tokenizer(spark):
    def make():
        from tokenizers import Tokenizer, models, pre_tokenizers

        made = Tokenizer(models.WordLevel({"a": 0, "b": 1, "?": 2}, unk_token="?"))
        made.pre_tokenizer = pre_tokenizers.Whitespace()
        return lambda texts: [e.ids for e in made.encode_batch(texts)]

    df = spark.createDataFrame([("b a zz",)], "text string")
    assert tokens.tokenize_text(df, make_encoder=make).first()["input_ids"] == [1, 0, 2]


def test_length_report(spark):
    rng = np.random.default_rng(3)
    data = [(s, int(n)) for s in ("train", "test") for n in rng.integers(0, 400, 300)]
    df = spark.createDataFrame(data, "split string, raw_length int").withColumn(
        "length", F.least("raw_length", F.lit(256))
    )
    got = {r["split"]: r for r in tokens.token_length_report(df).collect()}
    for name in ("train", "test", "overall"):
        raw = np.array([n for s, n in data if name in (s, "overall")])
        for prefix, x in (("", np.minimum(raw, 256)), ("raw_", raw)):
            assert got[name][f"{prefix}max"] == x.max() and got[name][f"{prefix}min"] == x.min()
            for p in (50, 75, 90, 95, 99):
                assert np.isclose(got[name][f"{prefix}p{p}"], np.percentile(x, p))
            assert np.isclose(got[name][f"{prefix}mean"], x.mean())
    words = df.select(F.repeat(F.lit("w "), F.col("raw_length")).alias("text"))
    stats, bands = tokens.token_analysis(words)
    raw = np.array([n for _, n in data])
    assert np.isclose(stats.first()["std"], raw.std())
    assert [r["rows"] for r in bands.orderBy("step").collect()] == [
        int(((raw > lo) & (raw <= hi)).sum())
        for lo, hi in [(-1, 50), (50, 100), (100, 200), (200, 300), (300, 400), (400, 500), (500, 10**9)]
    ]


def test_length_histogram(spark):
    sizes = [1, 1, 5, 30, 51, 51]
    df = spark.createDataFrame([("x" * n,) for n in sizes], "text string")
    got = {r["bin"]: r["rows"] for r in text.text_length_histogram(df).collect()}
    want, _ = np.histogram(sizes, bins=50)
    assert got == {i: int(n) for i, n in enumerate(want) if n}


# --- storage ----------------------------------------------------------------------------


def test_materialize_once(spark, tmp_path):
    path = str(tmp_path / "once")
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("y"), F.lit(None).cast("string").alias("s"))
    kept, wrote = tables.materialize_once(df, path, "src", "y", 100)
    assert wrote and kept.count() == 1000 and len(kept.inputFiles()) >= 10
    assert not tables.materialize_once(df.repartition(5), path, "src", "y")[1]
    assert tables.read_manifest(spark, path)["num_classes"] == 7
    # Another source, other rows, and a NULL that moved to another column are all changes.
    assert tables.materialize_once(df, path, "other", "y")[1]
    assert tables.materialize_once(df.where("id > 0"), path, "other", "y")[1]
    one = spark.createDataFrame([("a", None)], "p string, q string")
    two = spark.createDataFrame([(None, "a")], "p string, q string")
    prints = [tables.table_fingerprint(d).first()["fingerprint"] for d in (one, two)]
    assert prints[0] != prints[1]
    with pytest.raises(ValueError):
        tables.read_manifest(spark, str(tmp_path / "nothing"))


def test_package(spark, tmp_path):
    path = str(tmp_path / "package")
    df = spark.range(10).select("id", F.when(F.col("id") < 8, "train").otherwise("test").alias("split"))
    package_dataset(df, path, {"target_column": "계정"}, {"numbers": spark.range(3)})
    info = json.loads(spark.read.text(f"{path}/info").first()[0])
    assert info["splits"]["train"] == {"rows": 8, "ratio": 0.8} and info["target_column"] == "계정"
    test = read_package(spark, path, "test")
    assert test.count() == 2 and "PartitionFilters: [isnotnull(split" in plan(test)
    assert spark.read.json(f"{path}/tables/numbers").count() == 3


def test_staged_package(spark, tmp_path):
    df = spark.range(120).select(
        F.col("id").alias("key"), (F.col("id") % 3).cast("string").alias("y"), (F.col("id") * 1.5).alias("v")
    )
    path = str(tmp_path / "staged")
    config = StagedConfig(target="y", total_classes=5, features=["v"], key="key", required=["v", "w"])
    out, reports = staged_text(df, config, package_to=path)
    assert out.count() == 120
    info = json.loads(spark.read.text(f"{path}/info").first()[0])
    assert info["missing_required_columns"] == ["w"] and info["feature_columns"] == ["v"]
    assert spark.read.json(f"{path}/tables/label_mapping").count() == 5
    # A later run keeps the ids and adds to them.
    more = df.withColumn("y", F.when(F.col("key") < 30, "0a").otherwise(F.col("y")))
    mapping = staged_text(more, config, reports["label_mapping"])[1]["label_mapping"]
    assert names(mapping) == ["0", "1", "2", "0a", "DUMMY_000"]


def test_stage_counts_and_observed_rows(spark):
    a = spark.range(10)
    b = a.where("id > 3")
    assert rows(profile.stage_row_counts([("a", a), ("b", b)])) == [(0, "a", 10, 10, 0), (1, "b", 10, 6, 4)]
    seen, watch = profile.observe_rows(b, "b")
    seen.write.format("noop").mode("overwrite").save()
    assert watch.get["rows"] == 6


# --- plans ------------------------------------------------------------------------------


def test_filters_reach_the_file(spark):
    from tabwright.operators.rows import drop_nulls, drop_rows, keep_rows

    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    df = drop_nulls(df, ["o_orderkey"])
    df = keep_rows(df, [{"column": "o_orderpriority", "values": ["5-LOW", "2-HIGH"]}])
    df = drop_rows(df, [{"column": "o_orderstatus", "values": ["P"]}]).select("o_orderkey")
    text_plan = plan(df)
    pushed = text_plan[text_plan.rindex("PushedFilters"):].split("ReadSchema")[0]
    assert "IsNotNull(o_orderkey)" in pushed and "In(o_orderpriority" in pushed
    assert "Or(IsNull(o_orderstatus)" in pushed
    assert "o_totalprice" not in text_plan[text_plan.rindex("ReadSchema"):]


def test_row_wise_operators_run_on_a_stream(spark, tmp_path):
    from tabwright.operators import lookup, types
    from tabwright.operators.naming import standardize_columns
    from tabwright.operators.rows import drop_nulls, keep_rows

    spark.createDataFrame(
        [(20240301.0, "5", "1"), (20240304.0, None, "2")], ["전표일자", "매입.합계금액", "매출매입코드"]
    ).write.parquet(str(tmp_path / "in"))
    raw = spark.readStream.schema("`전표일자` double, `매입.합계금액` string, `매출매입코드` string").parquet(str(tmp_path / "in"))

    def prepare(df):
        df = types.transform_dtype(standardize_columns(df))
        df = keep_rows(drop_nulls(df, ["date"]), [{"column": "transaction_code", "values": ["1", "2"]}])
        df = lookup.day_type2(lookup.normalize_codes_to_text(df), lookup.fixed_holidays([2024]))
        return text.serialize_rows(text.prepare_text_fields(df), separator="^ ", key_value_separator=":")

    job = (
        prepare(raw).writeStream.format("memory").queryName("prepared")
        .option("checkpointLocation", str(tmp_path / "state")).start()
    )
    job.processAllAvailable()
    job.stop()
    assert rows(spark.table("prepared")) == [
        ("date:2024-03-01^ total_amount:sign=1| mant=5.0000| exponent=0^ transaction_code:sale^ day_type:holiday",),
        ("date:2024-03-04^ total_amount:NULL^ transaction_code:purchase^ day_type:workday",),
    ]


def test_estimated_distinct_counts(spark):
    df = spark.range(5000).select("id", (F.col("id") % 10).cast("string").alias("s"), F.lit(None).cast("int").alias("e"))
    got = {r["column"]: r["unique_count"] for r in profile.column_statistics(df, exact_distinct=False).collect()}
    assert abs(got["id"] - 5000) < 500 and got["s"] == 10 and got["e"] == 0


def test_shared_folder(spark, monkeypatch):
    from tabwright.sources import shared

    assert shared.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    monkeypatch.setattr(shared, "_SETTING", "spark.no.such.setting")
    folder = shared.shared_folder(spark)
    assert folder == shared.shared_folder(spark) and "tabwright-" in folder


def test_rename_by_a_mapping_file(spark, tmp_path):
    from tabwright.operators.naming import rename_from_mapping
    from tabwright.sources.mappings import mapping_dict, read_mapping

    path = tmp_path / "names.json"
    path.write_text(json.dumps({"전표.키": "key", "zz": "y"}, ensure_ascii=False, indent=2), encoding="utf-8")
    names_of = mapping_dict(read_mapping(spark, str(path)))
    renamed, done = rename_from_mapping(spark.createDataFrame([(1, 2)], ["전표.키", "v"]), names_of)
    assert renamed.columns == ["key", "v"] and done == {"전표.키": "key"}
