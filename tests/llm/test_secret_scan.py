"""Secrets against plain regular expressions and entropies counted from scratch."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import pytest

from tabwright.llm import catalog, secret_scan
from tests.llm.test_results import FOLDER, docs, edges, none  # noqa: F401

FORMS = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 12),
         ("access", r"AKIA[A-Z0-9]+", 0, 0, 18), ("hex", r"[0-9a-f]+", 0, 0, 16)]
NAMES = ("n_assign", "n_access", "n_hex", "base_sha256")


def base(text):
    found = [(m.start(), i, m.end()) for i, (_, p, flags, group, least) in enumerate(FORMS) for m in re.finditer(p, text or "", flags) if len(m[group]) >= least]
    counts = Counter(i for _, i, _ in found)
    spelled = ",".join(f"{FORMS[i][0]}:{a}:{b}" for a, i, b in sorted(found))
    return (*(counts[i] for i in range(3)), hashlib.sha256(spelled.encode()).hexdigest()), spelled


def entropy(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def check(frame, rows):
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, *(r[n] for n in NAMES)) for r in secret_scan.secret_report(frame).collect())
    assert got == sorted((i is not None, i or 0, *base(t)[0]) for i, t in rows)


def test_forms(spark, docs, edges):  # noqa: F811
    for frame in (spark.createDataFrame(docs), edges):
        check(frame, [tuple(r) for r in frame.select("doc_id", "text").collect()])


def test_forms_at_their_borders(spark):
    texts = ["password: short", "PassWord='abcdefghijkl'", "apikey=password=secretsecretsecret", "api_key : token:abcdefghijklm", "ſecret=abcdefghijklmnop",
             "toKen=abcdefghijklmnop", "AKIA" + "Z" * 13, "AKIA" + "Z" * 14, "xAKIAAKIA" + "0" * 14, "0" * 15, "é漢" + "0a" * 8 + "G", "token\t=abcdefghijklm",
             "secret=\nabcdefghijklmnop", 'passwd"  =  "' + "a" * 12, "token=" + "ab" * 400_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    check(frame, list(enumerate(texts)))


def test_whole_query(spark):
    got = {r["doc_id"]: r for r in catalog.QUERIES["op12_secret_scan"](spark, FOLDER).collect()}
    for i, text in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        want, spelled = base(text)
        assert tuple(got[i][n] for n in NAMES) == want
        assert [s for s in got[i]["spans"].split(",") if s and not s.startswith("entropy")] == [s for s in spelled.split(",") if s]


@pytest.mark.parametrize(("window", "limit"), [(8, 2.5), (28, 4.1), (5, 0.0), (4, 2.0)])
def test_sliding_counts_equal_entropy(window, limit):
    random.seed(12)
    for _ in range(200):
        text = "".join(random.choice("abcXYZ0189/+"[: random.randint(2, 12)]) for _ in range(random.randint(0, 60)))
        want = set()
        for i in range(len(text) - window + 1):
            w = text[i : i + window]
            steps = sum(abs(ord(a) - ord(b)) == 1 for a, b in zip(w, w[1:], strict=False)) + (i > 0 and abs(ord(w[0]) - ord(text[i - 1])) == 1) * 0
            if entropy(w) >= limit - 1e-10 and any(c.isdigit() for c in w) and steps <= 0.5 * window:
                want |= set(range(i, i + window))
        got = {p for a, b in secret_scan.dense_windows(text, window, limit) for p in range(a, b)}
        assert got == want


def spans(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: [(s["kind"], s["secret"]) for s in r["found"]] for r in secret_scan.scan_secrets(frame).collect()}


def test_unknown_secrets_are_found(spark):
    random.seed(13)
    keys = [base64.b64encode(random.randbytes(36)).decode() for _ in range(100)] + [random.randbytes(24).hex().upper() for _ in range(100)]
    found = spans(spark, [f"the value {k} stands here" for k in keys])
    caught = sum(any(kind == "entropy" for kind, _ in found[i]) for i in range(len(keys)))
    assert caught >= 0.97 * len(keys)


def test_allowed_strings_are_left_alone(spark):
    rest = ["123e4567-e89b-12d3-a456-426614174000", "https://host7.example.org/a1/b2/c3/Qx7LpZ0vK9mW4tRb2sYd", "usr/local/lib/python3/site-packages/numpy2/core/x86_64",
            "abcdefghijklmnopqrstuvwxyz0123456789ABCDEF", "sha256:" + hashlib.sha256(b"x").hexdigest().upper(), "Donaudampfschifffahrtsgesellschaftskapitaen",
            "getElementsByTagNameFromDocumentFragment", "00000000000000000000000000000000000000", "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY0", "=" * 80, "-" * 100]
    found = spans(spark, rest)
    assert [r for i, r in enumerate(rest) if any(kind == "entropy" for kind, _ in found[i])] == []


def test_clean_documents_have_no_entropy_spans(spark, docs):  # noqa: F811
    report = secret_scan.secret_report(spark.createDataFrame(docs)).where("n_entropy > 0 and n_assign + n_hex = 0")
    assert report.count() == 0


def test_masking(spark):
    frame = spark.createDataFrame([(1, "a token=abcdefghijklmnop b", "k"), (2, None, "k"), (3, "é plain", None)], "doc_id bigint, text string, kept string")
    assert [tuple(r) for r in secret_scan.masked(frame).orderBy("doc_id").collect()] == [(1, "a " + "*" * 22 + " b", "k"), (2, None, "k"), (3, "é plain", None)]


def test_nothing(none):  # noqa: F811
    assert secret_scan.secret_report(none).collect() == []
