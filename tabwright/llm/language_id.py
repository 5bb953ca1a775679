"""Language identification of mixed-language text.

A word's script (from code point ranges) narrows the languages it can be of: those in
whose training texts the script is met often enough. Each candidate language gives the
word a log-likelihood from letter n-grams (1 to 3 letters, hashed to a fixed number of
bins). A Viterbi pass over a document's words, with a penalty for switching, labels spans
of words; the language with most letters is the document's, and its share of the letters
the score.

The n-gram and script counts come from at most ``SAMPLE`` training documents per language
(those least by hash, so the choice does not depend on partitioning). They are counted in
tasks and summed in Spark; the model is one row of ``BINS`` numbers per language.

Defined cases: a NULL text, or one without a letter, gets ``und`` and score 0, as does
every text when there is nothing to learn from; rows without a language are not learned
from; words without letters carry no evidence; ties go to the language least by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabwright.llm.common import crc32_of_id, settle

BINS = 1 << 14
SAMPLE = 2_000
SWITCH = 8.0
SCRIPT_SHARE = 0.01
SEED = 9
_SMOOTH = 0.5
_IMPOSSIBLE = -1e3
_KNOWN_WORDS = 400_000
_LANES = 2048
UNKNOWN = "und"

#: First code point of each range and its script (0 is none of these).
SCRIPTS = ["other", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "devanagari", "thai", "hangul", "kana", "han"]
RANGES = [
    (0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1), (0x00AB, 0), (0x00B5, 0),
    (0x00BA, 1), (0x00BB, 0), (0x00C0, 1), (0x00D7, 0), (0x00D8, 1), (0x00F7, 0), (0x00F8, 1), (0x02B0, 0),
    (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0900, 7), (0x0980, 0),
    (0x0E00, 8), (0x0E80, 0), (0x1100, 9), (0x1200, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 10),
    (0x3100, 0), (0x3400, 11), (0x4DC0, 0), (0x4E00, 11), (0xA000, 0), (0xAC00, 9), (0xD7B0, 0), (0xF900, 11),
    (0xFB00, 0), (0x20000, 11), (0x30000, 0),
]
_STARTS = np.array([r[0] for r in RANGES], np.uint32)
_SCRIPT = np.array([r[1] for r in RANGES], np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-case words: n-gram bins of all, where each word's begin, its main script and
    its number of letters of any known script."""
    joined = " " + " ".join(words) + "  "
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = 1 + np.cumsum(sizes + 1)  # one past each word's blank
    starts = ends - 1 - sizes
    a, b, c = points[:-2], points[1:-1], points[2:]
    mix = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % BINS
    grams = np.stack(
        [mix(a + np.uint64(1 << 40)), mix(a * np.uint64(0x10001) + b * np.uint64(31)), mix(a * np.uint64(0x1000003) + b * np.uint64(0x10001) + c * np.uint64(31))], 1
    )
    script = _SCRIPT[np.searchsorted(_STARTS, points.astype(np.uint32), side="right") - 1]
    counts = np.zeros((len(words), len(SCRIPTS)), np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    letters = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    np.add.at(counts, (owner, script[letters]), 1)
    counts[:, 0] = 0
    main = np.where(counts.any(1), counts.argmax(1), 0)
    # A word's grams begin at the blank before it and go on to its last letter.
    return grams, starts - 1, main, counts.sum(1)


class Model:
    """``logs`` (languages, bins) and ``allowed`` (languages, scripts)."""

    def __init__(self, names: list[str], counts: np.ndarray, scripts: np.ndarray) -> None:
        self.names = names
        smooth = counts + _SMOOTH
        self.logs = np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32).T.copy()
        share = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
        self.allowed = share >= SCRIPT_SHARE

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(words, languages) log-likelihoods, and letters per word."""
        grams, starts, main, letters = word_features(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        index = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        each = self.logs[grams[index, 0]]
        each = each + self.logs[grams[index, 1]]
        each += self.logs[grams[index, 2]]
        scores = np.add.reduceat(each, np.cumsum(sizes) - sizes, axis=0)
        fits = self.allowed[:, main].T
        fits[~fits.any(1)] = True
        scores = np.where(fits, scores, scores + _IMPOSSIBLE)
        scores[letters == 0] = 0
        return scores.astype(np.float32), letters


def viterbi(scores: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """The best language of each word of each document, with a penalty for each change.

    Documents run side by side, longest first; a step is a few operations on all.
    """
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    out: list[np.ndarray] = [np.empty(0, np.int8)] * len(scores)
    for begin in range(0, len(order), _LANES):
        here = order[begin : begin + _LANES]
        sizes = np.array([len(scores[i]) for i in here])
        steps = int(sizes[0])
        if not steps:
            continue
        flat = np.concatenate([scores[i] for i in here])
        first = np.cumsum(sizes) - sizes
        lanes_at = np.searchsorted(-sizes, -np.arange(steps), side="left")
        best = flat[first[: lanes_at[0]]].copy()
        came, ends = [], np.zeros(len(here), np.int64)
        for t in range(1, steps):
            lanes = lanes_at[t]
            ended = slice(lanes, len(best))
            ends[lanes : len(best)] = best[ended].argmax(1)
            best = best[:lanes]
            top = best.argmax(1)
            moved = best[np.arange(lanes), top][:, None] - np.float32(switch)
            stay = best >= moved
            came.append(np.where(stay, -1, top[:, None]).astype(np.int8))
            best = np.where(stay, best, moved) + flat[first[:lanes] + t]
        ends[: len(best)] = best.argmax(1)
        labels = np.empty(int(sizes.sum()), np.int8)
        now = ends.copy()
        for t in range(steps - 1, 0, -1):
            lanes = lanes_at[t]
            labels[first[:lanes] + t] = now[:lanes]
            back = came[t - 1][np.arange(lanes), now[:lanes]]
            now[:lanes] = np.where(back < 0, now[:lanes], back)
        alive = lanes_at[0]
        labels[first[:alive]] = now[:alive]
        for k, i in enumerate(here):
            out[i] = labels[first[k] : first[k] + sizes[k]]
    return out


class Labeller:
    """Labels texts; words met before are looked up."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._scores = np.empty((0, len(self.model.names)), np.float32)
        self._letters = np.empty(0, np.int64)

    def label(self, texts: list[str]) -> list[tuple[list[str], np.ndarray, np.ndarray]]:
        """Words, their languages (by number) and their letters, for each text."""
        if len(self._known) > _KNOWN_WORDS:
            self._forget()
        words = [t.lower().split() for t in texts]
        new = list(dict.fromkeys(w for each in words for w in each if w not in self._known))
        for begin in range(0, len(new), 50_000):
            part = new[begin : begin + 50_000]
            scores, letters = self.model.word_scores(part)
            self._known.update(zip(part, range(len(self._letters), len(self._letters) + len(part)), strict=True))
            self._scores = np.concatenate((self._scores, scores))
            self._letters = np.concatenate((self._letters, letters))
        index = [np.fromiter(map(self._known.__getitem__, each), np.int64, len(each)) for each in words]
        labels = viterbi([self._scores[i] for i in index])
        return [(w, lab, self._letters[i]) for w, lab, i in zip(words, labels, index, strict=True)]


def spans(words: list[str], labels: np.ndarray, names: list[str]) -> list[tuple[int, int, str]]:
    """Runs of one language: first word, number of words, language."""
    if not len(words):
        return []
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(labels)) + 1, [len(words)]))
    return [(int(a), int(b - a), names[labels[a]]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _predict(batches: Iterator[pa.RecordBatch], model: Model | None, with_spans: bool) -> Iterator[pa.RecordBatch]:
    labeller = Labeller(model) if model else None
    span = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))
    for batch in batches:
        texts = batch.column("text").to_pylist()
        known = [i for i, t in enumerate(texts) if labeller and has_letter(t)]
        pred, score, found = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
        for begin in range(0, len(known), _LANES):
            part = known[begin : begin + _LANES]
            for i, (words, labels, letters) in zip(part, labeller.label([texts[i] for i in part]), strict=True):
                # Letters outside the ranges above count if there are no others.
                weight = letters if letters.any() else np.ones(len(words))
                share = np.bincount(labels, weight, len(model.names))
                pred[i] = model.names[int(share.argmax())]
                score[i] = float(share.max() / share.sum())
                if with_spans:
                    found[i] = [dict(zip(("first", "words", "lang"), s, strict=True)) for s in spans(words, labels, model.names)]
        arrays = [batch.column(c) for c in batch.schema.names if c != "text"]
        names = [c for c in batch.schema.names if c != "text"]
        arrays += [pa.array(pred, pa.string()), pa.array(score, pa.float64())]
        names += ["lang_pred", "score"]
        if with_spans:
            arrays, names = [*arrays, pa.array(found, span)], [*names, "spans"]
        yield pa.RecordBatch.from_arrays(arrays, names)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = text.lower().split()
            if not words:
                continue
            grams, starts, main, _ = word_features(words)
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            index = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
            mine = counts.setdefault(lang, np.zeros(BINS + len(SCRIPTS), np.int64))
            mine[:BINS] += np.bincount(grams[index].ravel(), minlength=BINS)
            mine[BINS:] += np.bincount(main, minlength=len(SCRIPTS))
    for lang, values in counts.items():
        at = np.flatnonzero(values)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * at.size), pa.array(at), pa.array(values[at])], ["lang", "at", "n"])


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model from ``lang`` and ``text`` of at most ``sample`` rows of each language."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", F.xxhash64("text", F.lit(SEED)).alias("h")
    )
    # How many are expected below a hash gives the sample; the rest is told by rank.
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows_of"))
    share = F.least(F.lit(1.0), F.lit(2.0 * sample) / F.col("rows_of"))
    near = rows.join(settle(sizes).withColumnRenamed("lang", "of"), F.col("lang") == F.col("of")).where(
        (F.col("h").cast("double") / 2.0**64 + 0.5) <= share
    )
    rank = F.row_number().over(W.partitionBy("lang").orderBy("h", "text"))
    chosen = near.withColumn("__rank", rank).where(F.col("__rank") <= sample).select("lang", "text")
    counted = (
        chosen.repartition("text").mapInArrow(_count, "lang string, at bigint, n bigint")
        .groupBy("lang", "at").agg(F.sum("n").alias("n"))
        .toPandas()
    )
    if counted.empty:
        return None
    names = sorted(counted["lang"].unique())
    table = np.zeros((len(names), BINS + len(SCRIPTS)))
    table[np.searchsorted(names, counted["lang"]), counted["at"]] = counted["n"]
    return Model(list(names), table[:, :BINS], table[:, BINS:])


def predict(docs: DataFrame, model: Model | None, carried: str = "doc_id bigint", with_spans: bool = False) -> DataFrame:
    """The carried columns of ``docs`` with ``lang_pred``, ``score`` and, if asked, ``spans``."""
    kinds = f"{carried}, lang_pred string, score double"
    if with_spans:
        kinds += ", spans array<struct<first:int,words:int,lang:string>>"
    names = [c.split()[0] for c in carried.split(", ")]
    return docs.select(*names, "text").mapInArrow(partial(_predict, model=model, with_spans=with_spans), kinds)


def identify(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` for every row of ``docs``.

    Learns from the rows outside ``held_out``: by default the CRC-32 of the id modulo 5
    is 0.
    """
    if held_out is None:
        held_out = crc32_of_id(F.col("doc_id")) % 5 == 0
    marked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", held_out.alias("held_out"))
    model = learn(marked.where("not held_out"))
    return predict(marked, model, "doc_id bigint, held_out boolean")
