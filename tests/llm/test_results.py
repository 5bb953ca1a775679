"""Operators against brute force on the smallest tables, and on rows made for edges."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabwright.llm import catalog, fingerprints, hashing, language_id, language_model, license_scan, mixing, near_duplicates, packing, quality_rules, sharding, suffix_dedup
from tabwright.llm.components import connected_components
from tabwright.llm.suffix_sorting import suffix_array
from tests.llm import brute
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
KINDS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, key string, __n int, shard string, kept string"
LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas()


@pytest.fixture(scope="module")
def edges(spark):
    """NULLs, blanks, ties, repeated rows, long texts, many copies, clashing column names."""
    near = [f"{' '.join(f'n{j}' for j in range(100))} tail{i}" for i in range(30)]
    texts = [None, "", " \n\t ", "x", "Two words", "é 漢字 Ω", "!!! ...", LONG, LONG, *["the copy of all copies " * 30] * 40,
             *near, f"a {PASSAGE} b", f"other text before {PASSAGE}", "line\nline\nline " * 40, "a" * 3000, "ab" * 1500]
    rows = [(i, t, ["en", "de", None][i % 3], ["s", None, "t"][i % 3], len(t or ""), 7, "k", 1, "z", "no") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "no id at all", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, KINDS)


@pytest.fixture(scope="module")
def none(edges):
    return edges.where("false")


def by_id(df, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_sql(spark, name):
    assert differences(spark, connect(FOLDER), FOLDER, catalog.QUERIES[name], catalog.SQL[name]) == []


@pytest.mark.parametrize(
    "operator",
    [
        suffix_dedup.removal_report, suffix_dedup.without_repeats, near_duplicates.near_duplicates,
        near_duplicates.without_near_duplicates, language_model.score, packing.pack, quality_rules.judge,
        quality_rules.judge_counts, quality_rules.keep_good, mixing.mix, mixing.mixed_documents, fingerprints.compare_edits,
        language_id.identify, license_scan.scan_licenses, sharding.assign_shards, sharding.exchange,
    ],
)
def test_edges_and_nothing(operator, edges, none):
    empty = operator(none)
    assert empty.collect() == []
    found = operator(edges)
    assert found.columns == empty.columns
    dropping = (mixing.mixed_documents, quality_rules.keep_good, near_duplicates.without_near_duplicates)
    n, all_rows = found.count(), edges.count()
    if operator is mixing.mixed_documents:
        assert 0 < n <= 2 * all_rows + 2
    else:
        assert 0 < n < all_rows if operator in dropping else n >= all_rows


# --- 1 ---------------------------------------------------------------------------------


def test_suffix_array():
    random.seed(1)
    for _ in range(500):
        t = [random.randint(1, random.randint(1, 4)) for _ in range(random.randint(0, 40))] + [0]
        assert suffix_array(np.array(t)) == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("most_classes", [2000, 1])
def test_suffix_dedup(spark, docs, edges, most_classes):
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    for frame, window in ((spark.createDataFrame(docs), 400), (edges.where("doc_id is not null and doc_id not in (7, 8)"), 100)):
        rows = frame.select("doc_id", "text").collect()
        got = by_id(suffix_dedup.removal_report(frame, window, most_classes), *names)
        assert got == dict(zip([r[0] for r in rows], brute.removed([r[1] for r in rows], window), strict=True))


def test_a_passage_in_many_texts_is_no_one_tasks_work(spark):
    """Its anchor is met in a different piece of every text, and in equal pieces of all of them."""
    chance = random.Random(12)
    other = lambda: "".join(chance.choices("abcdefghijklmnopqrstuvwxyz ", k=chance.randrange(300, 500)))
    texts = [f"{other()}{PASSAGE}{PASSAGE}{other()}" for _ in range(200)] + [PASSAGE] * 40
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        shared = suffix_dedup._shared_pieces(suffix_dedup._identified(frame), 400)
        placed = shared.where("mixed").select("h", F.input_file_name().alias("file"))
        hot = placed.groupBy("h").agg(F.count("file").alias("n"), F.count_distinct("file").alias("tasks"))
        hot = hot.where("n >= 200").collect()
    finally:
        spark.conf.set(name, before)
    assert hot and all(r["tasks"] == int(spark.conf.get("spark.sql.shuffle.partitions")) for r in hot)
    assert shared.where("mixed and more is not null").count() == 0
    for most_classes in (2000, 100):
        got = by_id(suffix_dedup.removal_report(frame, 400, most_classes), "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert got == dict(enumerate(brute.removed(texts, 400)))


# --- 2 ---------------------------------------------------------------------------------


def test_components(spark):
    random.seed(2)
    links = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(220)] + [(0, i) for i in range(400, 500)]
    parent = {x: x for pair in links for x in pair}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {x: c for x, c in got.items()} == {x: top(x) for x in parent if any(x in p and p[0] != p[1] for p in links)}


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, docs, edges, n, percent):
    for frame in (spark.createDataFrame(docs), edges.where("doc_id is not null").dropDuplicates(["doc_id"])):
        rows = frame.select("doc_id", "text").collect()
        ids = [r[0] for r in rows]
        top, sizes = brute.components(ids, [r[1] for r in rows], n, percent)
        got = by_id(near_duplicates.near_duplicates(frame, n, percent), "n_shingles", "component_id", "kept")
        assert got == {i: (s, c, c == i) for i, s, c in zip(ids, sizes, top, strict=True)}


def test_pivot_rounds(spark):
    """A chain of near copies, in which most pairs of a bucket are no links."""
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):
        base = list(base)
        base[i * 2] = f"new{i}"
        texts.append((i, " ".join(base)))
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    top, _ = brute.components([r[0] for r in texts], [r[1] for r in texts], 3, 85)
    got = by_id(near_duplicates.near_duplicates(frame, 3, 85), "component_id")
    assert [got[i][0] for i, _ in texts] == top


def test_long_words():
    long = b"y" * 10_000
    assert hashing.word_hashes(b"Ab cd\tAB " + long).tolist()[0] == hashing.word_hashes(b"ab").tolist()[0]
    assert [len(x) for x in hashing.batched([b"a b", None, b"", b"c", long])] == [2, 0, 0, 1, 1]


# --- 3 ---------------------------------------------------------------------------------


def test_language_model(spark, docs):
    df = spark.createDataFrame(docs)
    want, n = brute.unigram(docs.doc_id, docs.text)
    got = by_id(language_model.score(df, sent_words=1500), "n_tokens", "n_known", "base_score", "score", "held_out", "train_tokens")
    better = Counter()
    for i, (tokens, known, base) in zip(docs.doc_id, want, strict=True):
        r = got[i]
        assert (r[0], r[1], r[5]) == (tokens, known, n)
        assert r[2] == pytest.approx(base)
        assert r[4] == (zlib.crc32(str(i).encode()) % 7 == 2)
        better[r[4]] += r[3] - base
    assert better[False] > 0 and better[True] > 0


def test_network_slopes():
    """Slopes of back-propagation against small changes of the weights."""
    random = np.random.default_rng(0)
    net = language_model.Network.start(random.integers(1, 50, 40).astype(float), classes=5)
    net.w = {k: v.astype(np.float64) + 0.1 * random.standard_normal(v.shape) * (v > -100) for k, v in net.w.items()}
    ids, targets = random.integers(0, 40, (6, 3)), random.integers(0, 40, (6, 3))
    fresh = np.zeros((6, 3), bool)
    fresh[0] = True
    fresh[3, 1] = True
    state = np.zeros((3, language_model.HIDDEN))

    def loss():
        out, kept = net.run(ids, state, True, fresh)
        found, d, grads = net.log_parts(out.reshape(-1, language_model.HIDDEN).astype(np.float64), targets.ravel(), True)
        return -found.sum(), d.reshape(out.shape), grads, kept

    _, d, grads, kept = loss()
    grads |= net.backward(ids, kept, d, fresh)
    for name, at in (("wh", (3, 5)), ("wh", (2, 40)), ("wx", (1, 7)), ("b", (20,)), ("wc", (2, 3)), ("bc", (1,))):
        step = 1e-2
        net.w[name][at] += step
        up = loss()[0]
        net.w[name][at] -= 2 * step
        down = loss()[0]
        net.w[name][at] += step
        assert (up - down) / (2 * step) == pytest.approx(grads[name][at], rel=0.05, abs=5e-3)


def test_probabilities_sum_to_one():
    net = language_model.Network.start(np.arange(1, 71).astype(float), classes=8)
    states = np.random.default_rng(0).standard_normal((1, language_model.HIDDEN)).astype(np.float32)
    logs = net.log_parts(np.repeat(states, 70, 0), np.arange(70))[0]
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-5)


# --- 4 ---------------------------------------------------------------------------------


def test_license_scan(spark, docs, edges):
    """Against all templates for all units, without bounds; and on changed licence lines."""
    made = [(n, license_scan.bigrams(license_scan.words(t))) for n, t in license_scan.TEMPLATES]
    for frame in (spark.createDataFrame(docs), edges):
        rows = frame.select("doc_id", "text").collect()
        hits = Counter()
        for r in rows:
            for line in (r.text or "").split("\n"):
                found = license_scan.bigrams(license_scan.words(line))
                hits[r.doc_id] += found.total() > 0 and max(license_scan.dice(found, b) for _, b in made) >= 0.8
        got = license_scan.scan_licenses(frame).collect()
        matches = Counter()
        for r in got:
            matches[r.doc_id] += r.n_matches
        assert all(matches[i] >= n > 0 for i, n in hits.items() if n)
    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8)
    assert scanner.best(license_scan.words("released under THE MIT license"))[0] == "MIT"
    assert scanner.best(license_scan.words("All Rights Reserved!")) == ("reserved", 1.0)
    assert scanner.best(license_scan.words("Licensed under CC BY-NC 4.0."))[0] == "CC-BY-NC-4.0"
    assert scanner.best(license_scan.words("no licence in this line of text at all")) is None
    split = "This program is free software: you can redistribute it and/or modify it under\nthe terms of the GNU General Public License as published by the Free Software Foundation,\neither version 3 of the License, or (at your option) any later version."
    assert scanner.scan("text before\n\n" + split + "\n\ntext after")[1][0][0] == "GPL-3.0"
    random.seed(4)
    vocabulary = sorted({w for _, t in license_scan.TEMPLATES for w in license_scan.words(t)})
    for _ in range(500):
        name, text = random.choice(license_scan.TEMPLATES)
        w = license_scan.words(text)
        for _ in range(random.randint(0, 4)):
            w[random.randrange(len(w))] = random.choice(vocabulary)
        best = max(license_scan.dice(license_scan.bigrams(w), b) for _, b in made)
        hit = scanner.best(w)
        assert (hit is not None) == (best >= 0.8) and (hit is None or hit[1] == best)


def test_real_licence_texts():
    """Files of installed packages, whole and inside longer texts, and common notices."""
    from importlib.metadata import distribution

    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8)
    names = lambda text: {n for n, _ in scanner.scan(text)[1]}
    around = " ".join(f"other{i}" for i in range(700))
    for package, name in (("attrs", "MIT"), ("urllib3", "MIT"), ("idna", "BSD"), ("requests", "Apache-2.0")):
        dist = distribution(package)
        text = next(p.locate().read_text() for p in dist.files if p.name.startswith("LICENSE"))
        assert name in names(text), package
        assert name in names(f"{around} {' '.join(text.split())} {around}"), package
    for text, name in (("Licensed under the MIT License.", "MIT"), ("This project is licensed under the MIT License.", "MIT"),
                       ("Copyright 2020 Foo Inc. All rights reserved.", "reserved")):
        assert name in names(text) and name in names(f"{around} {text} {around}")
    assert names(around) == set()


# --- 5 ---------------------------------------------------------------------------------


def _ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_encoder_takes_words_apart():
    texts = ["Hello, world. it's A.B, x.", "<|endoftext|> and<|STARTOFTEXT|>", "Éa, ÑÑ. 12, 3.5", "a<|startoftext|>b c", "", "tab\tnew\nline nbsp"]
    for text, ids in zip(texts, packing.Encoder().encode(pa.array(texts, pa.string())), strict=True):
        assert ids.tolist() == _ids(text).tolist()


@pytest.mark.parametrize("group", [50_000, 60])
def test_packing(spark, docs, edges, group):
    for frame in (spark.createDataFrame(docs), edges.where("doc_id is not null").dropDuplicates(["doc_id"])):
        ids = {r[0]: _ids(r[1]) for r in frame.select("doc_id", "text").collect()}
        rows = packing.pack(frame, group=group).collect()
        sequences, covered = defaultdict(list), defaultdict(list)
        for r in rows:
            piece = ids[r.doc_id][r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(piece.tobytes()) and r.doc_tokens == ids[r.doc_id].size and r.length > 0
            sequences[r.sequence_id].append((r.offset, r.length))
            covered[r.doc_id].append((r.start, r.length))
        for held in (*sequences.values(), *([*c] for c in covered.values())):
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
        assert all(sum(n for _, n in s) <= 2048 for s in sequences.values())
        assert {i: sum(n for _, n in c) for i, c in covered.items()} == {i: x.size for i, x in ids.items()}
        if group > 1000:
            assert sum(sum(n for _, n in s) < 2048 for s in sequences.values()) <= 1
            filled = packing.sequence_ids(frame, packing.pack(frame)).collect()
            assert sum(len(r.ids) for r in filled) == sum(x.size for x in ids.values())


def test_sum_of_squares_takes_the_least_change():
    random = np.random.default_rng(5)
    sizes = random.integers(1, 64, 300)
    sequence, offset, _ = packing.sum_of_squares(sizes, 64)
    count, fill = Counter(), Counter()
    for s, q, o in zip(sizes.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        def after(h, s=s):
            c = Counter(count)
            if h:
                c[h] -= 1
            if h + s < 64:
                c[h + s] += 1
            return sum(x * x for x in c.values())

        levels = [h for h in range(64 - s + 1) if not h or count[h]]
        assert o == fill[q] and after(o) == min(map(after, levels))
        if o:
            count[o] -= 1
        fill[q] += s
        if fill[q] < 64:
            count[fill[q]] += 1


# --- 6 ---------------------------------------------------------------------------------


def test_base_counts(spark, docs, edges):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for frame in (spark.createDataFrame(docs), edges.where("doc_id is not null").dropDuplicates(["doc_id"])):
        want = {r[0]: brute.base_counts(r[1]) for r in frame.select("doc_id", "text").collect()}
        assert by_id(quality_rules.judge(frame), *names) == want


def test_good_documents_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = catalog.op6_quality_rules(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("not base_failed")
    shares = {r["quality"]: r["share"] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert shares[1] == 1 and shares[0] < 0.1


def test_each_common_word_is_counted(spark):
    frame = spark.createDataFrame([("the OF the cat and the", "en"), ("der x die der", "de"), ("the", None)], "text string, lang string")
    got = {r["reference"]: r["common"] for r in quality_rules.language_references(frame).collect()}
    assert got["en"] == [3000, 1000, 1000] + [0] * 9 + [1000]
    assert got["de"] == [2000, 1000] + [0] * 10 + [1000]


def test_long_documents_do_not_set_the_reference(spark):
    frame = spark.createDataFrame([("the of and", "en")] * 9 + [("zzz " * 100_000, "en")], "text string, lang string")
    got = quality_rules.language_references(frame).where("reference = 'en'").first()["common"]
    assert got == [9000, 9000, 9000] + [0] * 9 + [1_000_000]


def test_counts_and_texts_are_judged_alike(spark, docs, edges):
    names = ("n_words", "n_symbols", "n_repeat_words", "base_failed", "kept")
    for frame in (spark.createDataFrame(docs), edges.where("doc_id is not null").dropDuplicates(["doc_id"])):
        assert by_id(quality_rules.judge(frame), *names) == by_id(quality_rules.judge_counts(frame), *names)


def test_documents_without_a_language_meet_all_documents(spark):
    rows = [(i, "plain words in the text of a document " * 10, "en") for i in range(30)]
    rows += [(100, "plain words in the text of a document " * 10 + str(i), None) for i in range(1)]
    rows += [(101, "0123456789 " * 60, None), (102, "0123456789 " * 60, "xx")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    got = by_id(quality_rules.judge_counts(frame), "character_distance", "word_distance")
    assert got[100][0] < 0.2 and got[101][0] > 0.35 and got[102][0] == 0
    assert all(got[i][1] is None for i in (100, 101, 102))


@pytest.mark.parametrize("size", [50, 90, 400, 3000])
def test_texts_without_common_words_go(spark, size):
    """At every length the plain rule lets through; of texts with their share of them, at most one by chance."""
    chance = random.Random(6)
    # The listed words' shares of all words are about those in the tables, 18 % together.
    shares = {lang: [0.05, 0.027, 0.021, 0.015, 0.012, 0.011, 0.01, 0.008, 0.007, 0.006, 0.006, 0.005] for lang in quality_rules.COMMON_WORDS}

    def text(lang, n, common):
        rest = [f"word{chance.randrange(10**6)}x" for _ in range(n)]
        return " ".join(chance.choices([*quality_rules.COMMON_WORDS[lang], None], [*shares[lang], 1 - sum(shares[lang])])[0] or w if common else w for w in rest)

    rows = [(k, lang, text(lang, max(size, 100), True)) for lang in shares for k in range(40)]
    rows += [(100 + k, lang, text(lang, size, False)) for lang in shares for k in range(2)]
    frame = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    kept = Counter((r.lang, r.doc_id >= 100) for r in quality_rules.keep_good(frame, character_distance=1.0).collect())
    assert all(kept[lang, False] >= 39 and kept[lang, True] == 0 for lang in shares)


def test_labelled_texts_by_the_relative_limit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    plain = quality_rules.judge(docs).where("not base_failed").join(labels, "doc_id").groupBy("quality").count()
    found = quality_rules.keep_good(docs).join(labels, "doc_id").groupBy("quality").count()
    before, after = ({r["quality"]: r["count"] for r in x.collect()} for x in (plain, found))
    assert after[1] == before[1] and after.get(0, 0) < 0.1 * before[0]


# --- 7 ---------------------------------------------------------------------------------


def test_permutations(spark):
    for n in (1, 2, 97, 1000):
        df = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("p"))
        rows = df.withColumn("q", mixing.unpermuted(F.col("p"), F.lit(n), F.lit(3))).collect()
        assert sorted(r.p for r in rows) == list(range(n)) and all(r.q == r.id for r in rows)


def _targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    rest, total, done = set(order), 1.5 * sum(sizes.values()), {}
    while rest:
        level = (total - sum(done.values())) / sum(weight[s] for s in rest)
        above = {s for s in rest if level * weight[s] > 2 * sizes[s]}
        if not above:
            return done | {s: level * weight[s] for s in rest}
        done |= {s: 2.0 * sizes[s] for s in above}
        rest -= above
    return done


def test_mixing(spark, docs, edges):
    for frame in (spark.createDataFrame(docs), edges):
        rows = mixing.mix(frame).collect()
        sizes, taken, target = Counter(), Counter(), {}
        for r in rows:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            target[r.source] = r.target
            assert 0 <= r.taken <= 2 * r.size
        for s, t in _targets(sizes).items():
            assert target[s] == pytest.approx(t) and abs(taken[s] - t) <= 1
        assert sorted(map(repr, mixing.mix(frame.repartition(7)).collect())) == sorted(map(repr, rows))
        mixed = mixing.mixed_documents(frame)
        words = sum(len((r.text or "").encode().split()) for r in mixed.collect())
        assert words == sum(taken.values()) and mixed.columns == frame.columns


# --- 8 ---------------------------------------------------------------------------------


@pytest.mark.parametrize("bytes_per_range", [8 << 20, 20_000])
def test_fingerprints(spark, docs, monkeypatch, bytes_per_range):
    monkeypatch.setattr(fingerprints, "_BUCKET_BYTES", bytes_per_range)
    got = by_id(fingerprints.compare_edits(spark.createDataFrame(docs)), "n_chars", "edited_sha256", "near_edited", "near_next")
    rows = docs.sort_values("doc_id", ascending=False)
    ids, texts = rows.doc_id.tolist(), rows.text.tolist()

    def likeness(a, b):
        a, b = brute.shingles(a, 5), brute.shingles(b, 5)
        return len(a & b) / len(a | b) if a | b else 1.0

    for k, (i, text) in enumerate(zip(ids, texts, strict=True)):
        following = texts[(k + 1) % len(texts)]
        edited = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        assert got[i][:2] == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert got[i][2] == pytest.approx(likeness(text, edited), abs=0.16)
        assert got[i][3] == pytest.approx(likeness(text, following), abs=0.16)


def test_parts_merge(spark):
    left, right = " ".join(f"a{i}" for i in range(900)), " ".join(f"a{i}" for i in range(896, 1500))
    df = spark.createDataFrame([(left, right, left + right[len("a896 a897 a898 a899") :])], "l string, r string, w string")
    for c in ("l", "r", "w"):
        df = fingerprints.with_fingerprint(df, c, f"{c}f")
    row = df.select(
        (fingerprints.merged(F.col("lf"), F.col("rf")) == F.col("wf")).alias("same"),
        fingerprints.distinct_shingles(F.col("wf")).alias("n"),
        fingerprints.containment(F.col("lf"), F.col("wf")).alias("inside"),
    ).first()
    assert row.same and row.inside == 1 and row.n == pytest.approx(1496, rel=0.3)


# --- 9 ---------------------------------------------------------------------------------


def test_held_out_languages(spark):
    rows = catalog.op9_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_spans_and_scripts(spark):
    german, english = "der und die nicht ein das mit von zu ist " * 8, "the of and to in that is for was with "  * 8
    greek = "και το της που για με από στην των δεν " * 8
    rows = [(i, t, k) for i, (t, k) in enumerate([(german, "de"), (english, "en"), (greek, "el")] * 5)]
    train = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.learn(train)
    tests = [(0, german + english), (1, "των"), (2, "12 34"), (3, None), (4, "漢字")]
    got = by_id(language_id.predict(spark.createDataFrame(tests, "doc_id bigint, text string"), model, with_spans=True), "lang_pred", "spans")
    assert [s["lang"] for s in got[0][1]] == ["de", "en"] and got[1][0] == "el"
    assert got[2][0] == got[3][0] == "und" and got[4][0] in ("de", "el", "en")


# --- 10 --------------------------------------------------------------------------------


def test_sharding(spark, docs, edges):
    for frame in (spark.createDataFrame(docs), edges):
        rows = sharding.assign_shards(frame, 6).collect()
        loads, slots = Counter(), defaultdict(list)
        for r in rows:
            loads[r.shard] += r.size
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(loads) <= set(range(6))
        crcs = defaultdict(set)
        for r in rows:
            crcs[r.text_crc32, r.size].add(r.shard)
        assert all(len(s) == 1 for s in crcs.values())
    loads = Counter()
    for r in sharding.assign_shards(spark.createDataFrame(docs), 6).collect():
        loads[r.shard] += r.size
    assert max(loads.values()) < 1.03 * min(loads.values())


def test_splitters_refine(spark):
    keys = spark.range(20_000).select((F.lit(2**62) + F.col("id")).alias("key"), F.lit(10).cast("bigint").alias("size"))
    bounds = sharding.find_splitters(keys, 4).bounds
    assert [b - 2**62 for b in bounds] == pytest.approx([5000, 10_000, 15_000], abs=6)


# --- all stages ------------------------------------------------------------------------


def test_pipeline(spark, edges, none):
    import corpus_pipeline

    for frame in (edges, none):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), frame.schema)
            assert docs.columns == frame.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
        tokens = sum(_ids(r.text).size for r in docs.collect())
        assert (packed.agg(F.sum("length")).first()[0] or 0) == tokens


def test_pipeline_stages_by_hand(spark):
    """Each stage's decision against brute force on what the one before kept."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good = corpus_pipeline.quality(spark, docs, FOLDER).toPandas()
    assert all(brute.base_counts(t)[0] >= 50 and 2 * brute.base_counts(t)[4] <= brute.base_counts(t)[0] for t in good.text)
    frame = spark.createDataFrame(good)
    single = corpus_pipeline.near_dedup(spark, frame, FOLDER).toPandas()
    top, _ = brute.components(good.doc_id.tolist(), good.text.tolist(), 5, 80)
    assert set(single.doc_id) == set(top)
    trimmed = corpus_pipeline.suffix_dedup_stage(spark, spark.createDataFrame(single), FOLDER).toPandas().set_index("doc_id")
    for i, want in zip(single.doc_id, brute.removed(single.text, corpus_pipeline.REPEATED), strict=True):
        left = trimmed.text[i].encode()
        assert want[0] - want[1] - 6 * want[2] <= len(left) <= want[0] - want[1]


def test_pipeline_takes_passages_of_over_fifty_words(spark):
    """A passage of 51 words goes from all documents that share it; what is theirs alone stays."""
    import corpus_pipeline

    passage = " ".join(f"pas{i}" for i in range(51))
    rest = [" ".join(f"own{i}x{j}" for j in range(80)) for i in range(12)]
    texts = [f"{r} {passage} {r[::-1]}" if i < 8 else r for i, r in enumerate(rest)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.suffix_dedup_stage(spark, frame, FOLDER).collect()}
    for i, r in enumerate(rest):
        assert passage[20:-20] not in got[i] and r[:-8] in got[i]
        assert got[i] == texts[i] or i < 8
