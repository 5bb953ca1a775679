"""Operators without SQL against plain enumeration: licence windows, Viterbi paths, shard bounds."""

import random
from collections import Counter
from itertools import product

import numpy as np
import pytest

from tabwright.llm import language_id, license_scan, sharding
from tests.llm.test_results import FOLDER, docs  # noqa: F401


class Plain(license_scan.Scanner):
    """Every unit against every template, every window counted from scratch."""

    def best(self, found):
        if not found:
            return None
        mine = license_scan.bigrams(found)
        score, name = min((-license_scan.dice(mine, b), name) for _, name, b in self.made)
        return (name, -score) if -score >= self.least else None

    def windows(self, found, taken):
        grams = list(zip(found, found[1:], strict=False))
        near = []
        for size, name, b in self.made:
            for i in range(len(grams)):
                if grams[i] in b:
                    score = license_scan.dice(Counter(grams[i : i + size]), b)
                    if score >= self.least:
                        near.append((-score, -size, name, i, min(i + size, len(grams)) + 1))
        hits, taken = [], list(taken)
        for score, _, name, start, end in sorted(near):
            if all(end <= s or start >= e for s, e in taken):
                taken.append((start, end))
                hits.append((name, -score))
        return hits


def test_license_windows():
    random.seed(41)
    letters = "a b c d e f g h".split()
    for _ in range(300):
        templates = [(f"t{k}", " ".join(random.choice(letters) for _ in range(random.randint(3, 9)))) for k in range(3)]
        least = random.choice([0.6, 0.8, 0.9])
        fast, plain = license_scan.Scanner(templates, least), Plain(templates, least)
        text = [random.choice(letters) for _ in range(random.randint(0, 30))]
        for _, t in random.sample(templates, 2):
            at = random.randint(0, len(text))
            text[at:at] = t.split()
        taken = [(0, random.randint(0, 3))]
        assert fast.windows(text, taken) == plain.windows(text, taken)
        assert fast.best(text[:8]) == plain.best(text[:8])


def test_license_scan_of_whole_documents(spark, docs):  # noqa: F811
    short = [(n, t) for n, t in license_scan.TEMPLATES if len(t) < 600]
    plain = Plain(short, 0.8)
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(docs), short).collect()}
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        if len(text or "") > 20_000:
            continue
        units, hits = plain.scan(text or "")
        names = ",".join(sorted({n for n, _ in hits}))
        assert (got[i].n_units, got[i].n_matches, got[i].licenses) == (units, len(hits), names)
        assert got[i].score == pytest.approx(max((s for _, s in hits), default=0.0))


def test_viterbi_by_all_paths():
    rng = np.random.default_rng(42)
    for _ in range(150):
        texts = [rng.normal(size=(int(rng.integers(0, 7)), 3)).astype(np.float32) * 2 for _ in range(5)]
        switch = float(rng.choice([0.1, 1.0, 3.0]))

        def total(scores, path):
            return sum(s[p] for s, p in zip(scores, path, strict=True)) - switch * sum(a != b for a, b in zip(path, path[1:], strict=False))

        for scores, labels in zip(texts, language_id.viterbi(texts, switch), strict=True):
            assert len(labels) == len(scores)
            if len(scores):
                best = max(total(scores, path) for path in product(range(3), repeat=len(scores)))
                assert total(scores, labels.tolist()) == pytest.approx(best, abs=1e-4)


@pytest.mark.parametrize("hot", [0, 1])
def test_shard_bounds_are_where_exact_sums_put_them(spark, hot):
    random.seed(43)
    sizes = {random.randint(-(2**63), 2**63 - 1): random.randint(1, 400) for _ in range(3000)}
    if hot:
        sizes[12345] = sum(sizes.values()) // 2
    frame = spark.createDataFrame(list(sizes.items()), "key bigint, size bigint")
    split = sharding.find_splitters(frame, 8, 0.01)
    light = sorted((k, s) for k, s in sizes.items() if k not in split.heavy)
    heavy = [0] * 8
    for k, at in split.heavy.items():
        heavy[at] += sizes[k]
    rooms, below = sharding._room(heavy, sum(s for _, s in light)), 0.0
    allowed = sum(sizes.values()) / 8 * 0.01
    largest = max(s for _, s in light)
    for room, bound in zip(rooms, split.bounds, strict=False):
        below += room
        under = sum(s for k, s in light if k < bound)
        assert abs(under - below) <= max(allowed, largest)


def test_equal_texts_share_a_shard(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.assign_shards(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    of_text = {}
    for i, text in rows:
        assert of_text.setdefault(text, got[i][0]) == got[i][0]
    places = Counter(s for s, _ in got.values())
    assert sorted(got.values()) == sorted((s, k) for s, n in places.items() for k in range(n))
