"""Hard negatives against all products, and candidates against what must be among them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import catalog, hard_negatives
from tabwright.llm.hard_negatives import Best, LengthBucket

NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
KINDS = "vec_id bigint, embedding array<double>, label int, rank string, v string, block int"


def brute(rows, every=100):
    """From (vec_id, embedding, label), one row per id."""
    usable = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = math.fmod(label + 1, 10) if i % 7 == 0 else label
        row = (label, list(vector))
        usable[i] = min(usable.get(i, row), row)
    ints = {i: [math.floor(x) for x in (256 * x for x in v)] for i, (_, v) in usable.items()}

    def score(a, b):
        return min(max(sum(x * y for x, y in zip(ints[a], ints[b], strict=False)), -(2**63)), 2**63 - 1)

    out = set()
    for a in usable:
        if a % every:
            continue
        scores = sorted(((score(a, b), -b) for b in usable if b != a), reverse=True)
        for ps, p in [x for x in scores if usable[-x[1]][0] == usable[a][0]][:5]:
            fit = [x for x in scores if usable[-x[1]][0] != usable[a][0] and 80 * ps <= 100 * x[0] <= 100 * ps][:5]
            out |= {(a, -p, k + 1, -n, ps, ns) for k, (ns, n) in enumerate(fit)}
    return out


def got(df):
    rows = [tuple(r[n] for n in NAMES) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def mined(frame, **more):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(frame, label, F.col("vec_id") % 100 == 0, **more)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = brute(rows)
    assert want and got(catalog.QUERIES["op11_hard_negatives"](spark, folder)) == want


def test_edges(spark):
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=6).tolist(), int(rng.integers(0, 3))) for i in range(400)]
    rows += [(400, [1.0] * 6, 1), (400, [1.0] * 6, 1), (400, [0.5] * 6, 0), (500, [0.0] * 6, 2), (501, [], 1), (600, [2.0, 3.0], 0), (602, [1.0] * 9, 2),
             (700, None, 1), (701, [1.0] * 6, None), (None, [1.0] * 6, 1), (702, [1.0, None] * 3, 1), (703, [float("nan")] * 6, 1), (704, [float("-inf")] * 6, 2),
             (800, [1e6] * 6, 5), (801, [1e6] * 6, 5), (802, [9e5] * 6, 6), (900, [3e9] * 6, 7), (901, [3e9] * 6, 7), (902, [2.9e9] * 6, 8), (1000, [-1.0] * 6, 9)]
    rows += [(2000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0], i % 2) for i in range(300)]
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], KINDS)
    assert got(mined(frame)) == brute(rows)
    empty = mined(frame.where("false"))
    assert empty.collect() == [] and tuple(empty.columns) == NAMES


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 90)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    rng = np.random.default_rng(12)
    heads = rng.normal(size=(4, 16))
    rows = [(i, (heads[i % 4] * rng.uniform(0.5, 3) + rng.normal(size=16) * 0.3).tolist(), int(rng.integers(0, 12) // 6)) for i in range(1000)]
    assert got(mined(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))) == brute(rows)


def test_candidates_hold_all_that_reach_the_limit_and_few_others():
    rng = np.random.default_rng(13)
    heads = rng.normal(size=(20, 16))
    heads *= 4 / np.sqrt(np.square(heads).sum(axis=1, keepdims=True))
    vectors = np.floor(256 * (heads[rng.integers(0, 20, 1000)] + rng.normal(size=(1000, 16)) * 0.2))
    bucket = LengthBucket(np.arange(1000), vectors, np.sqrt(np.square(vectors).sum(axis=1)))
    seen = 0
    for i in range(200):
        anchor = vectors[i]
        length = float(np.sqrt(np.square(anchor).sum()))
        scores = vectors @ anchor
        limit = float(np.sort(scores)[-20])
        unit = anchor / length
        places = bucket.candidates(np.argsort(-np.abs(unit))[:4], unit, length, limit)
        places = np.arange(1000)[places]
        assert set(np.flatnonzero(scores >= limit)) <= set(places)
        seen += len(places)
        assert bucket.candidates(np.argsort(-np.abs(unit))[:4], unit, length, length * bucket.longest * 1.01) is None
    assert seen < 0.5 * 200 * 1000


def test_best_keeps_ties_by_id():
    best = Best(3)
    best.offer(np.array([5, 7, 5, 5, 7]), np.array([9, 4, 2, 3, 1]))
    best.offer(np.array([7, 5]), np.array([0, 1]))
    assert best.rows == [(7, 0), (7, 1), (7, 4)] and best.limit() == 7
