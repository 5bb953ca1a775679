"""What runs leave behind: sinks, and the earlier copy after a crash."""

import pytest

from tabwright.catalog.flows import STAGED, raw_purchases
from tabwright.plans.staged import staged_text
from tabwright.sources import shared
from tabwright.sources.packaging import read_package
from tabwright.sources.tables import materialize_once, read_manifest

FOLDER = "/root/testdata/sf0.001"


def held(spark, part):
    return shared.listed(spark, f"{shared.shared_folder(spark)}/{part}")


def test_a_run_leaves_only_its_sinks(spark, tmp_path):
    before = [held(spark, part) for part in ("settled", "stages")]
    stages = {s: shared.listed(spark, s) for s in before[1]}
    with shared.run_scope(spark, "staged") as run:
        text, _ = staged_text(raw_purchases(spark, FOLDER), STAGED, package_to=str(tmp_path / "package"))
        rows = text.count()
        assert any(run in p for p in held(spark, "settled"))
    assert [p for p in held(spark, "settled") if p not in before[0]] == []
    assert all(shared.listed(spark, s) == stages.get(s, []) for s in held(spark, "stages"))
    assert read_package(spark, str(tmp_path / "package")).count() == rows > 0


def test_runs_inside_runs(spark):
    with shared.run_scope(spark, "outer") as outer:
        kept = shared.settle(spark.range(3))
        with shared.run_scope(spark, "inner") as inner:
            shared.settle(spark.range(4))
            assert shared.current_run(spark) == inner
        assert shared.current_run(spark) == outer
        assert kept.count() == 3 and not any(inner in p for p in held(spark, "settled"))
    assert shared.current_run(spark) == "loose" and not any(outer in p for p in held(spark, "settled"))


def test_a_crash_leaves_finished_stages(spark, tmp_path):
    folder = str(tmp_path / "stages")
    shared.checkpoint_stage(spark.range(5), "rows", folder)
    with pytest.raises(ValueError), shared.run_scope(spark, "crash") as run:
        shared.settle(spark.range(9))
        shared.checkpoint_stage(spark.range(6), "rows", folder)
        raise ValueError("half-way")
    assert not any(run in p for p in held(spark, "settled"))
    assert shared.newest_stage(spark, "rows", folder).count() == 6
    # A copy that a dead task left without its mark does not count, and does not go while it is newest.
    (tmp_path / "stages" / "rows" / "99999999999999999999-x").mkdir()
    shared.sweep_stages(spark, folder)
    assert len(shared.listed(spark, f"{folder}/rows")) == 2
    assert shared.newest_stage(spark, "rows", folder).count() == 6
    assert shared.newest_stage(spark, "none", folder) is None


def test_materialised_copies_are_swept(spark, tmp_path):
    path = str(tmp_path / "once")
    seen = []
    for n in (3, 4, 5, 6):
        table, fresh = materialize_once(spark.range(n), path, f"source {n}")
        assert fresh and table.count() == n
        seen.append(read_manifest(spark, path)["data"])
        assert not materialize_once(spark.range(n), path, f"source {n}")[1]
    left = [p.rsplit("/", 1)[1] for p in shared.listed(spark, path) if "/data-" in p]
    assert left == [p.rsplit("/", 1)[1] for p in seen[-2:]]
    assert len(shared.listed(spark, f"{path}/manifest")) == 2
    assert read_manifest(spark, path)["rows"] == 6


def test_ids_of_a_vocabulary_file(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tabwright.catalog import QUERIES
    from tabwright.operators.tokens import tokenize_once

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(vocabulary)
    plain.encode_special_tokens = True
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["tokenize_text_ids"](spark, FOLDER).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        ids = plain.encode(text, add_special_tokens=False).ids
        assert (got[i]["input_ids"], got[i]["length"], got[i]["raw_length"]) == (ids[:256], min(256, len(ids)), len(ids))
    df = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, None), (3, "")], "doc_id int, text string")
    first, fresh = tokenize_once(df, str(tmp_path / "ids"), vocabulary)
    again, anew = tokenize_once(df.repartition(3), str(tmp_path / "ids"), vocabulary)
    assert (fresh, anew) == (True, False) and sorted(map(str, first.collect())) == sorted(map(str, again.collect()))
    assert {r["doc_id"]: r["raw_length"] for r in first.collect()} == {1: len(plain.encode("a <|endoftext|> b", add_special_tokens=False).ids), 2: 0, 3: 0}
    assert tokenize_once(df, str(tmp_path / "ids"), vocabulary, max_length=2)[1]
    assert tokenize_once(df.where("doc_id < 3"), str(tmp_path / "ids"), vocabulary, max_length=2)[1]


def test_fingerprints_tell_tables_apart(spark):
    from tabwright.sources.tables import table_fingerprint

    df = spark.range(50).selectExpr("id", "if(id % 5 = 0, null, concat('t', id)) as t")
    of = lambda d: tuple(table_fingerprint(d).first())
    same = of(df)
    assert of(df.repartition(7, "t")) == same
    others = [
        df.where("id != 3"), df.unionByName(df.where("id = 3")), df.selectExpr("id", "if(id = 3, 'x', t) as t"),
        df.selectExpr("id", "coalesce(t, '') as t"), df.where("id != 3").unionByName(df.where("id = 4")),
    ]
    assert len({of(d) for d in others} | {same}) == len(others) + 1


def test_a_package_needs_a_split_column(spark, tmp_path, monkeypatch):
    from tabwright.sources import packaging

    monkeypatch.setattr(packaging, "MOST_SPLITS", 20)
    df = spark.range(30).selectExpr("id as split", "'x' as text")
    with pytest.raises(ValueError):
        packaging.package_dataset(df.repartition(1), str(tmp_path / "package"), {})
