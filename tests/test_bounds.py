"""Bounds that hold at any size: what a task holds at once, and how rows are dealt."""

import random

from pyspark.sql import functions as F

from tabwright.catalog.stored import _dealt
from tabwright.fixed_values import WORD_SPACE
from tabwright.functions.text import word_count, words
from tabwright.operators import tokens
from tabwright.operators.group_features import OutlierRule, iqr_outliers
from tabwright.plans.staged import StagedConfig, staged_text
from tabwright.sources.shared import is_stored
from tests.conftest import rows


def test_encoders_get_a_bounded_run_of_texts(spark):
    most_rows, most_bytes = tokens.RUN_ROWS, tokens.RUN_BYTES

    def encoder():
        def encode(texts):
            assert len(texts) <= most_rows
            assert len(texts) == 1 or sum(len(t.encode()) for t in texts) <= most_bytes
            return [[len(t), 7] if t else [] for t in texts]

        return encode

    size = F.when(F.col("id") % 997 == 0, most_bytes + F.col("id")).otherwise(F.col("id") % 2000)
    text = F.when(F.col("id") % 5 != 1, F.repeat(F.lit("é"), size.cast("int")))
    df = spark.range(0, 5000, 1, 1).select("id", text.alias("text"))
    got = tokens.tokenize_text(df, make_encoder=encoder, max_length=3, pad_to_max=True, pad_id=9)
    length = F.coalesce(F.length("text"), F.lit(0))
    want = df.select(
        "id",
        F.when(length > 0, F.array(length, F.lit(7), F.lit(9))).otherwise(F.array(*[F.lit(9)] * 3)),
        F.when(length > 0, F.array(*map(F.lit, (1, 1, 0)))).otherwise(F.array(*[F.lit(0)] * 3)),
        F.lit(3),
        F.when(length > 0, 2).otherwise(0),
    )
    assert rows(got) == rows(want)


def test_values_that_are_a_bound_are_inside(spark):
    # Of two values the smaller is the lower bound at 0.25, 0.75 and 0.5 times the spread.
    pairs = [(11604, 184383.75, 361608.527), (13101, 128492.9, 206858.6), (3316, 98926.42, 186768.42),
             (1, -5.3, 2.7), (2, 0.1, 0.3), (3, -0.7, -0.1), (4, 1e-7, 3e9)]
    data = [(g, x) for g, low, high in pairs for x in (low, high)]
    rule = OutlierRule(lower_coefficient=0.5, upper_coefficient=0.5)
    df = spark.createDataFrame(data, "g int, x double")
    for task_rows in (1_000_000, 1):
        assert rows(iqr_outliers(df, "x", "g", rule, task_rows)) == rows(df)
    # A value next to a bound is outside, as is one of a group with more rows.
    more = [(g, x) for g, low, high in pairs for x in (low, low, high, high, low - 2 * (high - low))]
    kept = iqr_outliers(spark.createDataFrame(more, "g int, x double"), "x", "g", rule)
    assert rows(kept.groupBy("g").count()) == sorted(((g, 4) for g, *_ in pairs), key=repr)
    near = spark.createDataFrame([(x,) for x in (0.0, 1.0, 1.0 + 1e-13)], "x double")
    flat = OutlierRule(0.0, 0.5, 0.0, 0.0)
    assert rows(iqr_outliers(near, "x", rule=flat)) == [(0.0,), (1.0,)]


def test_rows_dealt_anew_come_in_parts_of_bounded_size(spark):
    # Parts of the bounded size are cut when the query runs, however many there are.
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "2"}
    old = {k: spark.conf.get(k) for k in settings}
    seen = {}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for n in (50_000, 200_000):
            df = spark.range(0, n, 1, 40).select("id", F.xxhash64("id").alias("x"))
            parts = _dealt(df, "id").select(F.spark_partition_id().alias("p"), "id").groupBy("p").count()
            seen[n] = [r["count"] for r in parts.collect()]
            assert sum(seen[n]) == n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert max(seen[200_000]) < 1.5 * max(seen[50_000]) and len(seen[200_000]) > 10


def test_staged_preparation_makes_its_input_once(spark, tmp_path):
    path = str(tmp_path / "input")
    spark.range(400).selectExpr("id as key", "id % 3 as y", "id * 1.5 as v").write.parquet(path)
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    stored = spark.read.parquet(path)
    config = StagedConfig(target="y", total_classes=5, features=["v"], key="key", rules=[{"column": "v", "operator": ">", "value": 9}])
    text, reports = staged_text(stored.mapInArrow(count, stored.schema), config)
    want, other = staged_text(stored, config)
    assert rows(text) == rows(want) and rows(text) != []
    assert all(rows(reports[k]) == rows(other[k]) for k in reports)
    assert made.value == 400
    assert is_stored(stored) and is_stored(stored.selectExpr("cast(v as float) as w", "y"))
    assert not is_stored(stored.unionByName(stored)) and not is_stored(stored.join(stored.select("y"), "y"))


def test_word_counts_are_those_of_the_words(spark):
    signs = [*WORD_SPACE, ord("a"), ord("é"), 0x20, 0x20, ord("b")]
    rng = random.Random(3)
    texts = ["", " ", "  ", None, "a", " a", "a ", "a b", "a  b", "\ta\t", "a\x1fb", "é è", *(
        "".join(chr(rng.choice(signs)) for _ in range(rng.randrange(12))) for _ in range(3000)
    )]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = df.select("t", word_count(F.col("t")).alias("n"), F.size(words(F.col("t"))).alias("m"))
    assert both.where(~F.col("n").eqNullSafe(F.col("m"))).collect() == []
    plain = spark.createDataFrame([("a b c",)], "t string").select(word_count(F.col("t"))).first()[0]
    assert plain == 3
