"""The language model's work per word, and its fast ways against plain ones."""

import time

import numpy as np
import pyarrow as pa
import pytest

from tabwright.llm import language_model

ODD = [" A  b\x0b\x0cC \x1cd ", None, "", " \t\n\x0b\x0c\r ", "É x\xa0y É", "one", "\nTwo\r\nwords", None, "x " * 500, "  "]


def batch_of(texts):
    n = len(texts)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array(texts, pa.string()), pa.array([False] * n)], ["doc_id", "text", "held_out"]
    )


def plain_words(text):
    return (text or "").encode().lower().split()


def test_words_of_odd_texts():
    words, sizes = language_model.split_words(pa.array(ODD))
    assert sizes.tolist() == [len(plain_words(t)) for t in ODD]
    assert [w.encode() for w in words.to_pylist()] == [w for t in ODD for w in plain_words(t)]
    known = [b"x", "É".encode(), b"b"]
    _, _, _, places = next(language_model._gathered(batch_of(ODD), language_model._listed(known)))
    assert places.tolist() == [known.index(w) if w in known else -1 for t in ODD for w in plain_words(t)]
    ids = language_model._ids(places, sizes, 2)
    assert [len(i) for i in ids] == (sizes + 1).tolist() and all(i[-1] == 0 for i in ids)
    assert np.concatenate(ids)[np.concatenate(ids) > 0].tolist() == [p + 2 if 0 <= p < 2 else 1 for p in places]


def test_words_cost_less_than_python_values():
    """Words are split and looked up in at most 0.7 of the time that Python's take."""
    random = np.random.default_rng(0)
    texts = [" ".join(f"w{i}" for i in random.zipf(1.2, 400) % 100_000) for _ in range(2000)]
    batch, known = batch_of(texts), [f"w{i}".encode() for i in range(65_536)]
    of, listed = {w: i for i, w in enumerate(known)}, pa.array([w.decode() for w in known])

    def seconds(way):
        start = time.process_time()
        way()
        return time.process_time() - start

    def plain():
        for text in batch.column("text").cast(pa.binary()):
            words = text.as_py().lower().split()
            np.fromiter((of.get(w, -1) for w in words), np.int64, len(words))

    pairs = [(seconds(lambda: [None for _ in language_model._gathered(batch, listed)]), seconds(plain)) for _ in range(5)]
    assert min(a for a, _ in pairs) < 0.7 * min(b for _, b in pairs)


def test_scoring_keeps_its_lanes_full(monkeypatch):
    """A few long texts don't make the network step for them alone, run after run."""
    random = np.random.default_rng(0)
    vocabulary = np.array([f"w{i}" for i in range(30)])
    texts = []
    for _ in range(3):
        texts += [" ".join(vocabulary[random.integers(0, 30, n)]) for n in [5000, *[500] * 2095]]
    net = language_model.Network.start(np.arange(32, 0, -1).astype(float))
    net.w["ww"] += 0.3 * random.standard_normal(net.w["ww"].shape).astype(np.float32)
    steps, run = [], language_model.Network.run
    monkeypatch.setattr(language_model.Network, "run", lambda self, ids, *rest: steps.append(ids.shape[0]) or run(self, ids, *rest))
    known = language_model._listed([w.encode() for w in vocabulary])
    found = list(language_model._score(iter([batch_of(texts)]), net, known, np.full(30, 9), 30, 1, 271, 31, -2.0))
    assert sum(f.num_rows for f in found) == len(texts)
    assert sum(steps) < 8_000  # 3.2 million words; 16,014 in runs of a million, groups of 512
    scores = np.concatenate([f.column("score").to_numpy() for f in found])
    for i in (0, 1, 2096, 5000):
        ids = np.array([*(int(w[1:]) + 2 for w in texts[i].split()), 0], np.int32)
        assert scores[i] == pytest.approx(language_model.score_documents(net, [ids])[0] / np.log(10), rel=1e-5)


@pytest.mark.parametrize("size", [0.1, 30.0])
def test_shares_against_plain_softmax(size):
    """Also where sums are cut at the largest, and where targets are more than go at once."""
    random = np.random.default_rng(1)
    net = language_model.Network.start(random.integers(1, 50, 90).astype(float))
    for name in ("wc", "ww"):
        net.w[name] += size * random.standard_normal(net.w[name].shape).astype(np.float32)
    states = np.tanh(random.standard_normal((3000, language_model.HIDDEN))).astype(np.float32)
    targets = random.integers(0, 90, 3000)
    got, d_states, grads = net.log_parts(states, targets, True)
    w = {k: v.astype(float) for k, v in net.w.items()}

    def shares(sums):
        e = np.exp(np.minimum(sums, 60))
        return e / e.sum(-1, keepdims=True)

    of, inside = np.divmod(targets, net.per_class)
    classes, words = shares(states @ w["wc"] + w["bc"]), shares(np.einsum("nh,nhp->np", states, w["ww"][of]) + w["bw"][of])
    at = np.arange(3000)
    want = np.log(classes[at, of]) + np.log(words[at, inside])
    assert got == pytest.approx(want, rel=1e-4, abs=1e-3)
    classes[at, of] -= 1
    words[at, inside] -= 1
    assert grads["wc"] == pytest.approx(states.T @ classes, rel=1e-3, abs=0.02)
    assert d_states == pytest.approx(classes @ w["wc"].T + np.einsum("np,nhp->nh", words, w["ww"][of]), rel=1e-3, abs=0.02)
