"""A gated recurrent language model over words, and the log-likelihood of whole documents.

Words: the commonest words of the training documents, an end of text, and one mark for
all other words. There are as many as the root of the number of different words, from
``LEAST_VOCABULARY`` to ``MOST_VOCABULARY`` (the stated size of the model: 33 weights a
word), in as many classes as words a class. The network predicts the next of these; if it is the mark,
the word itself has the share that smoothed counts give it among all words outside the
vocabulary (with one place kept for words never seen), so the score is a probability of
the text itself. The output is factored: first a class, then a word within it, classes
holding equal numbers of words by count; so a step costs the square root of a full
softmax. Output biases start at the logarithms of the counts, so training starts from the
unigram model.

Training: truncated back-propagation over windows of ``STEPS`` words, in numpy, with many
documents side by side and the state carried from window to window. Every task trains a
copy of the model on all training documents of its partition; copies are averaged, each
weighted by its words, in Spark. Documents are dealt to ``ROUNDS`` rounds by hash, and
each round starts from the average of the one before. Every training document is used
once, whole.

Scoring runs the network over every document with the state carried from its first word
to its last, documents lying end to end in lanes of one length; counts of words outside the vocabulary that are too many to send to every
task are met by a join.

Defined cases: NULL is an empty text, which is one end of text; repeated rows count as
often as they are there; without training documents every count is 0 and the network
keeps its first weights; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from heapq import heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import crc32_of_id, runs_of_bytes, settle

HIDDEN = 16
INPUT = 16
LEAST_VOCABULARY, MOST_VOCABULARY = 1022, 16_382
STEPS = 32
LANES = 512
#: Longer documents are trained on in parts of so many words, each with a new state.
PART = 1024
#: Lanes of documents scored side by side, and words at a time.
LEAST_LANES, SCORE_LANES = 32, 512
SCORE_STEPS = 64
#: Targets whose shares are computed in one go.
AT_ONCE = 1024
RATE = 0.03
ROUNDS = 2
#: Most words whose counts go to every task; the rest meet the texts by a join.
SENT_WORDS = 65_536
SEED = 3
#: Texts made into words in one go have so many bytes, or are one text.
RUN_BYTES = 1 << 21
#: Documents gathered as ids before the network runs over them.
RUN_DOCS, RUN_WORDS = 4096, 1 << 20
#: The same for scoring, where a longest text of few leaves most lanes idle.
SCORE_DOCS, SCORE_WORDS = 16_384, 1 << 22
#: Different words that a task counts before it sends them on.
COUNTED = 300_000
_CUT = 5.0
_LARGEST = np.float32(60)


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after the other, lower case A-Z, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten()
    # Blanks at the ends of a text, and a text of blanks alone, give empty words.
    real = pc.greater(pc.binary_length(words), 0)
    empty = np.flatnonzero(~real.to_numpy(zero_copy_only=False))
    if empty.size:
        sizes -= np.bincount(np.searchsorted(np.cumsum(sizes), empty, side="right"), minlength=sizes.size)
        words = words.filter(real)
    return words, sizes


# --- the network ---------------------------------------------------------------------


class Network:
    """Weights by name; ids are 0 end of text, 1 other words, 2... the vocabulary."""

    def __init__(self, weights: dict[str, np.ndarray], per_class: int) -> None:
        self.w = weights
        self.per_class = per_class

    @classmethod
    def start(cls, counts: np.ndarray, classes: int | None = None, seed: int = SEED) -> Network:
        """``counts``: of each id in training. Ids are dealt to classes in order of counts."""
        random = np.random.default_rng(seed)
        n = counts.size
        classes = classes or math.isqrt(max(n - 1, 0)) + 1
        per = -(-n // classes)
        share = (counts + 1.0) / (counts.sum() + n)
        padded = np.zeros(classes * per)
        padded[:n] = share
        padded = padded.reshape(classes, per)
        of_class = np.maximum(padded.sum(1), 1e-12)
        inner = np.where(padded > 0, np.log(np.maximum(padded, 1e-30) / of_class[:, None]), -1e4)
        normal = lambda *shape: (random.standard_normal(shape) * 0.1).astype(np.float32)
        return cls(
            {
                "embed": normal(n, INPUT),
                "wx": normal(INPUT, 3 * HIDDEN),
                "wh": normal(HIDDEN, 3 * HIDDEN),
                "b": np.zeros(3 * HIDDEN, np.float32),
                "wc": normal(HIDDEN, classes) * 0,
                "bc": np.log(of_class).astype(np.float32),
                "ww": np.zeros((classes, HIDDEN, per), np.float32),
                "bw": inner.astype(np.float32),
            },
            per,
        )

    def _gates(self, name: str) -> np.ndarray:
        """Recurrent or input weights by gate (update, reset, new), each as one block of memory."""
        return np.ascontiguousarray(self.w[name].reshape(-1, 3, HIDDEN).swapaxes(0, 1))

    def run(
        self, ids: np.ndarray, state: np.ndarray, keep: bool, fresh: np.ndarray | None = None
    ) -> tuple[np.ndarray, list]:
        """States after each step for ids (steps, lanes); ``keep``: with what backward needs;
        ``fresh``: where a document begins, at which the state is set to nothing."""
        w, h = self.w, HIDDEN
        steps, lanes = ids.shape
        wh = self._gates("wh")
        table = np.matmul(w["embed"], self._gates("wx")) + w["b"].reshape(3, 1, h)
        # The logistic function takes its argument with the sign changed.
        table[:2] *= -1
        wh[:2] *= -1
        out = np.empty((steps, lanes, h), np.float32)
        kept = []
        x, gates, new, held = (np.empty((*n, lanes, h), wh.dtype) for n in ((3,), (2,), (), ()))
        for t in range(steps):
            if fresh is not None and fresh[t].any():
                state = state * ~fresh[t][:, None]
            if keep:
                gates, new = np.empty_like(gates), np.empty_like(new)
            np.take(table, ids[t], axis=1, out=x, mode="clip")
            np.matmul(state, wh[:2], out=gates)
            gates += x[:2]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates
            np.multiply(r, state, out=held)
            np.matmul(held, wh[2], out=new)
            new += x[2]
            np.tanh(new, out=new)
            if keep:
                kept.append((state, z, r, new))
            np.subtract(new, state, out=held)
            held *= z
            state = np.add(state, held, out=out[t])
        return out, kept

    def log_parts(self, states: np.ndarray, targets: np.ndarray, slopes: bool = False) -> tuple:
        """Natural log-probability of each target; with ``slopes`` also what backward needs.

        Targets are taken in order of their class, ``AT_ONCE`` at a time, which the caches
        hold. Biases are weights of a state that is always 1.
        """
        w, h = self.w, HIDDEN
        n, classes = targets.size, w["bc"].size
        of, inside = np.divmod(targets, self.per_class)
        order = np.argsort(of.astype(np.int16), kind="stable")
        of, inside = of[order], inside[order]
        edges = np.searchsorted(of, np.arange(classes + 1)).tolist()
        sorted_states = np.ones((n, h + 1), np.result_type(states, w["wc"]))
        sorted_states[:, :h] = np.take(states, order, axis=0)
        kind = sorted_states.dtype
        at, most = np.arange(min(n, AT_ONCE)), max(classes, self.per_class)
        room, ones = np.empty(most * at.size, kind), np.ones(most, kind)
        largest = np.abs(states).max(initial=0)
        found, out = np.empty(n, kind), np.empty(n)
        d_sorted, d_states, grads = None, None, None
        if slopes:
            d_sorted = np.empty((n, h), kind)
            d_class, d_word = np.zeros((h + 1, classes), kind), np.zeros((classes, h + 1, self.per_class), kind)

        def joined(name: str, biases: str) -> tuple[np.ndarray, np.ndarray]:
            """Weights with their biases, and for each set of them whether a sum may be too large."""
            bounds = np.abs(w[name]).sum(-2) * largest + w[biases]
            return np.concatenate((w[name], w[biases][..., None, :]), -2), bounds.max(-1) > _LARGEST

        def share(weights: np.ndarray, cut: bool, low: int, high: int, target: np.ndarray) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
            """Logarithms for targets low to high, and the slopes of weights and states."""
            mine, wide = sorted_states[low:high], weights.shape[1]
            flat = room[: wide * (high - low)]
            spots = at[: high - low] * wide + target[low:high]
            e = np.matmul(mine, weights, out=flat.reshape(-1, wide))
            if cut:
                np.minimum(e, _LARGEST, out=e)
            logs = flat[spots]
            np.exp(e, out=e)
            sums = e @ ones[:wide]
            logs -= np.log(sums)
            if not slopes:
                return logs, None, None
            e *= np.reciprocal(sums, out=sums)[:, None]
            flat[spots] -= 1
            return logs, mine.T @ e, e @ weights[:h].T

        weights, cut = joined("wc", "bc")
        for low in range(0, n, AT_ONCE):
            high = min(low + AT_ONCE, n)
            found[low:high], d_weights, d_mine = share(weights, cut, low, high, of)
            if slopes:
                d_class += d_weights
                d_sorted[low:high] = d_mine
        weights, cut = joined("ww", "bw")
        for c in range(classes):
            for low in range(edges[c], edges[c + 1], AT_ONCE):
                high = min(low + AT_ONCE, edges[c + 1])
                logs, d_weights, d_mine = share(weights[c], cut[c], low, high, inside)
                found[low:high] += logs
                if slopes:
                    d_word[c] += d_weights
                    d_sorted[low:high] += d_mine
        out[order] = found
        if slopes:
            grads = {"wc": d_class[:h], "bc": d_class[h], "ww": d_word[:, :h], "bw": d_word[:, h]}
            back = np.empty(n, np.int64)
            back[order] = np.arange(n)
            d_states = np.take(d_sorted, back, axis=0)
        return out, d_states, grads

    def backward(self, ids: np.ndarray, kept: list, d_out: np.ndarray, fresh: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of the recurrent part from those of its outputs (steps, lanes, hidden)."""
        w, h = self.w, HIDDEN
        steps, lanes = ids.shape
        wh = self._gates("wh")
        turned = np.ascontiguousarray(wh.swapaxes(1, 2))
        dx = np.empty((steps, lanes, 3 * h), np.float32)
        d_wh = np.zeros_like(wh)
        d_gates = np.empty((3, lanes, h), wh.dtype)
        d_z, d_r, d_new = d_gates
        back, one, two = (np.zeros((lanes, h), wh.dtype) for _ in range(3))
        for t in range(steps - 1, -1, -1):
            state, z, r, new = kept[t]
            back += d_out[t]
            np.multiply(back, z, out=one)
            back -= one
            np.multiply(new, new, out=two)
            np.subtract(1, two, out=two)
            np.multiply(one, two, out=d_new)
            np.subtract(new, state, out=two)
            two *= one
            np.subtract(1, z, out=one)
            np.multiply(two, one, out=d_z)
            held = d_new @ turned[2]
            held *= r
            np.multiply(r, state, out=one)
            np.subtract(state, one, out=two)
            np.multiply(held, two, out=d_r)
            back += held
            d_wh[:2] += np.matmul(state.T, d_gates[:2])
            d_wh[2] += one.T @ d_new
            for d, to in zip(d_gates[:2], turned, strict=False):
                back += d @ to
            dx[t].reshape(lanes, 3, h)[:] = d_gates.swapaxes(0, 1)
            if fresh[t].any():
                back *= ~fresh[t][:, None]
        flat, words = dx.reshape(-1, 3 * h), ids.ravel()
        order = np.argsort(words.astype(np.min_scalar_type(w["embed"].shape[0])), kind="stable")
        sorted_words = words[order]
        first = np.flatnonzero(np.append(True, sorted_words[1:] != sorted_words[:-1]))
        d_embed = np.ascontiguousarray(np.take(flat @ w["wx"].T, order, axis=0).T)
        return {
            "wx": np.take(w["embed"], words, axis=0).T @ flat,
            "wh": d_wh.swapaxes(0, 1).reshape(h, 3 * h),
            "b": np.ones(words.size, flat.dtype) @ flat,
            "embed": (sorted_words[first], np.add.reduceat(d_embed, first, axis=1).T),
        }


def _streams(texts: list[np.ndarray], lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents laid end to end in lanes: (steps, lanes) ids, -1 where a lane is done, and
    the number of the document.

    A lane's input before its first word of a document is the end of text before it, and
    the state starts anew there.
    """
    order = sorted(range(len(texts)), key=lambda i: -texts[i].size)
    fill, parts = [(0, lane) for lane in range(lanes)], [[] for _ in range(lanes)]
    for i in order:
        size, lane = fill[0]
        parts[lane].append(i)
        heapreplace(fill, (size + texts[i].size, lane))
    ids = np.full((lanes, max(fill)[0]), -1, np.int32)
    owner = np.full(ids.shape, -1, np.int32)
    for lane, each in enumerate(parts):
        if each:
            joined = np.concatenate([texts[i] for i in each])
            ids[lane, : joined.size] = joined
            owner[lane, : joined.size] = np.repeat(each, [texts[i].size for i in each])
    return np.ascontiguousarray(ids.T), np.ascontiguousarray(owner.T)


def _windows(texts: list[np.ndarray], lanes: int, steps: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows of the documents in lanes: inputs, targets, where a document begins, the
    document of each target, and the lanes still in use."""
    ids, owner = _streams(texts, lanes)
    last_id, last_owner = np.zeros(lanes, np.int32), np.full(lanes, -1, np.int32)
    for start in range(0, ids.shape[0], steps):
        targets, of = ids[start : start + steps], owner[start : start + steps]
        fresh = (of != np.concatenate((last_owner[None], of[:-1]))) & (of >= 0)
        inputs = np.concatenate((last_id[None], targets[:-1]))
        inputs = np.where(fresh | (inputs < 0), 0, inputs)
        last_id, last_owner = np.maximum(targets[-1], 0), of[-1]
        used = np.flatnonzero(targets[0] >= 0)
        yield inputs[:, used], targets[:, used], fresh[:, used], of[:, used], used


def train_on(net: Network, texts: list[np.ndarray], squares: dict[str, np.ndarray]) -> float:
    """One pass of truncated back-propagation over documents (ids, the end included)."""
    if not texts:
        return 0.0
    parts = [t[i : i + PART] for t in texts for i in range(0, t.size, PART)]
    lanes = min(LANES, len(parts))
    state = np.zeros((lanes, HIDDEN), np.float32)
    total = 0.0
    for inputs, targets, new, _, used in _windows(parts, lanes, STEPS):
        out, kept = net.run(inputs, state[used], True, new)
        state[used] = out[-1]
        real = np.flatnonzero(targets.ravel() >= 0)
        found, d_out, grads = net.log_parts(np.take(out.reshape(-1, HIDDEN), real, axis=0), targets.ravel()[real], True)
        total += float(found.sum())
        if real.size < targets.size:
            d_real, d_out = d_out, np.zeros((targets.size, HIDDEN), np.float32)
            d_out[real] = d_real
        grads |= net.backward(inputs, kept, d_out.reshape(out.shape), new)
        _step(net, grads, squares, max(LANES * STEPS // 4, real.size))
    return total


def _step(net: Network, grads: dict, squares: dict[str, np.ndarray], n: int) -> None:
    """Adagrad on the mean slope; rows that got no slope stay."""
    for name, g in grads.items():
        at, slope = g if name == "embed" else (slice(None), g)
        slope = np.clip(slope / n, -_CUT, _CUT)
        squares[name][at] += slope * slope
        net.w[name][at] -= RATE * slope / np.sqrt(squares[name][at] + 1e-10)


def score_documents(net: Network, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of each document (ids, the end included), state carried through."""
    scores = np.zeros(len(texts))
    if not texts:
        return scores
    # No more lanes than documents of the greatest length would fill: a lane's end is idle time.
    sizes = [t.size for t in texts]
    lanes = min(max(-(-sum(sizes) // max(sizes)), LEAST_LANES), SCORE_LANES, len(texts))
    state = np.zeros((lanes, HIDDEN), np.float32)
    for inputs, targets, fresh, of, used in _windows(texts, lanes, SCORE_STEPS):
        out, _ = net.run(inputs, state[used], False, fresh)
        state[used] = out[-1]
        real = np.flatnonzero(targets.ravel() >= 0)
        found, _, _ = net.log_parts(np.take(out.reshape(-1, HIDDEN), real, axis=0), targets.ravel()[real])
        scores += np.bincount(of.ravel()[real], found, len(texts))
    return scores


# --- in Spark ------------------------------------------------------------------------


def _ids(places: np.ndarray, sizes: np.ndarray, vocabulary: int) -> list[np.ndarray]:
    """The network's ids of each text, the end included, from the places of all their words."""
    ids = np.zeros(places.size + sizes.size, np.int32)
    at = np.arange(places.size) + np.repeat(np.arange(sizes.size), sizes)
    ids[at] = np.where((places >= 0) & (places < vocabulary), places + 2, 1)
    return np.split(ids, np.cumsum(sizes + 1)[:-1])


def vocabulary_size(different: int) -> int:
    """Words of the network for a corpus of so many different words."""
    return min(max(math.isqrt(max(different, 0)), LEAST_VOCABULARY), MOST_VOCABULARY)


def _gathered(batch: pa.RecordBatch, known: pa.Array) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """Runs of rows of a batch: one past the last, their words, how many each row has, and
    the place of each word among the known ones, -1 for others.

    Words exist for one run of bytes at a time, however many rows a batch has.
    """
    column = batch.column("text")
    for begin, end in runs_of_bytes(column, RUN_BYTES):
        words, sizes = split_words(column.slice(begin, end - begin))
        places = pc.index_in(words, value_set=known.cast(words.type))
        yield end, words, sizes, pc.fill_null(places, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _listed(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def _train(batches: Iterator[pa.RecordBatch], net: Network, known: pa.Array) -> Iterator[pa.RecordBatch]:
    squares = {k: np.full_like(v, 1e-8) for k, v in net.w.items()}
    total, waiting, size = 0, [], 0
    for batch in batches:
        for _, _, sizes, places in _gathered(batch, known):
            for ids in _ids(places, sizes, len(known)):
                waiting.append(ids)
                size += ids.size
                if len(waiting) == RUN_DOCS or size >= RUN_WORDS:
                    train_on(net, waiting, squares)
                    total, waiting, size = total + size, [], 0
    if waiting:
        train_on(net, waiting, squares)
        total += size
    if total:
        flat = np.concatenate([net.w[k].ravel() for k in sorted(net.w)]).astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(flat.size)), pa.array(flat * total), pa.array(np.full(flat.size, float(total)))],
            ["at", "value", "weight"],
        )


def train(docs: DataFrame, net: Network, known: dict[bytes, int], rounds: int = ROUNDS) -> Network:
    """The network after ``rounds`` of training copies in all tasks and averaging them."""
    words = _listed(sorted(known, key=known.get))
    deal = F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(5))
    for r in range(rounds):
        # The first round, which sets the average to start from, has a fifth of the documents.
        mine = docs.where(deal == 0 if r == 0 else deal > 0) if rounds > 1 else docs
        averaged = (
            mine.select("text").mapInArrow(partial(_train, net=net, known=words), "at bigint, value double, weight double")
            .groupBy("at").agg((F.sum("value") / F.sum("weight")).alias("value"))
        )
        found = averaged.toPandas().sort_values("at")  # as many rows as the network has weights
        if len(found):
            flat, at, weights = found["value"].to_numpy(), 0, {}
            for k in sorted(net.w):
                size = net.w[k].size
                weights[k] = flat[at : at + size].reshape(net.w[k].shape).astype(np.float32)
                at += size
            net = Network(weights, net.per_class)
    return net


def _score(
    batches: Iterator[pa.RecordBatch], net: Network, known: pa.Array, counts: np.ndarray,
    vocabulary: int, end_count: int, n: int, v: int, log_other: float,
) -> Iterator[pa.RecordBatch]:
    """Scores of what every task knows, and the words that only the join knows.

    ``known``: words by rank, ``counts``: theirs; ``log_other``: log10 of the share of all
    words outside the vocabulary.
    """
    bottom = math.log10(n + v + 1)
    # At the last place, which -1 names, words that are not known here: nothing yet.
    logs = np.append(np.log10(counts + 1.0) - bottom, 0.0)
    outside = np.where(np.arange(logs.size) < vocabulary, 0.0, logs - log_other)
    outside[-1] = 0.0
    end_log = math.log10(end_count + 1) - bottom

    def counted(words: pa.Array, sizes: np.ndarray, places: np.ndarray) -> tuple:
        """Per row: tokens, known ones, base, share of words outside; and a list of unknown words."""
        row = np.repeat(np.arange(sizes.size), sizes)
        per_row = partial(np.bincount, row, minlength=sizes.size)
        spots = np.flatnonzero(places < 0)
        rare = (
            pa.table({"row": row[spots], "word": words.take(pa.array(spots)).cast(pa.binary())})
            .group_by(["row", "word"], use_threads=False).aggregate([([], "count_all")]).sort_by("row").combine_chunks()
        )
        ends = np.cumsum(np.bincount(rare["row"].to_numpy(), minlength=sizes.size))
        pairs = [rare[c].combine_chunks() if rare.num_rows else pa.array([], kind) for c, kind in (("word", pa.binary()), ("count_all", pa.int64()))]
        listed = pa.ListArray.from_arrays(
            pa.array(np.append(0, ends), pa.int32()), pa.StructArray.from_arrays(pairs, ["word", "times"])
        )
        known_here = sizes - np.bincount(row[spots], minlength=sizes.size) + (end_count > 0)
        return sizes + 1, known_here, per_row(logs[places]) + end_log, per_row(outside[places]), listed

    def scored(batch: pa.RecordBatch, first: int, parts: list[tuple], ids: list[np.ndarray]) -> pa.RecordBatch:
        *columns, rare = zip(*parts, strict=True)
        tokens, seen, base, other = map(np.concatenate, columns)
        here = batch.slice(first, len(ids))
        return pa.RecordBatch.from_arrays(
            [
                here.column("doc_id"), here.column("held_out"), pa.array(tokens, pa.int64()), pa.array(seen, pa.int64()),
                pa.array(base, pa.float64()), pa.array(score_documents(net, ids) / math.log(10) + other, pa.float64()), pa.concat_arrays(rare),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"],
        )

    for batch in batches:
        parts, ids, size, first = [], [], 0, 0
        for end, words, sizes, places in _gathered(batch, known):
            parts.append(counted(words, sizes, places))
            ids += _ids(places, sizes, vocabulary)
            size += places.size + sizes.size
            if len(ids) >= SCORE_DOCS or size >= SCORE_WORDS or end == batch.num_rows:
                yield scored(batch, first, parts, ids)
                parts, ids, size, first = [], [], 0, end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their counts, sent on whenever there are many different ones."""
    waiting: list[pa.Table] = []

    def merged() -> pa.Table:
        return pa.concat_tables(waiting).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})

    for batch in batches:
        column = batch.column("text")
        for begin, end in runs_of_bytes(column, RUN_BYTES):
            found = split_words(column.slice(begin, end - begin))[0].value_counts()
            waiting.append(pa.table({"word": found.field("values").cast(pa.string()), "n": found.field("counts")}))
            if sum(t.num_rows for t in waiting) >= 2 * COUNTED:
                waiting = [merged()]
                if waiting[0].num_rows >= COUNTED:
                    yield from waiting.pop().to_batches()
    if waiting:
        yield from merged().to_batches()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (lower case A-Z) and its count ``n``; the end of text is the empty word."""
    ends = docs.agg(F.count(F.lit(1)).alias("n")).select(F.lit("").alias("word"), "n").where("n > 0")
    return (
        docs.select("text").mapInArrow(_count, "word string, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n"))
        .unionByName(ends)
    )


def score(docs: DataFrame, held_out: Column | None = None, vocabulary: int | None = None, sent_words: int = SENT_WORDS) -> DataFrame:
    """Every row of ``docs`` with the unigram and the network's score.

    ``held_out`` marks the rows not to learn from; by default those whose CRC-32 of the
    id modulo 7 is 2. Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score``, in log10.
    """
    if held_out is None:
        held_out = crc32_of_id(F.col("doc_id")) % 7 == 2
    marked = docs.select(F.col("doc_id"), "text", held_out.alias("held_out"))
    training = marked.where("not held_out")
    counts = settle(word_counts(training))
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    vocabulary = vocabulary or vocabulary_size(v)
    # The least count of which, with all above, no more than sent_words words are.
    fits, least = 0, None
    for row in sorted(counts.where("word <> ''").groupBy("n").count().collect(), reverse=True):
        fits += row["count"]
        if fits > sent_words:
            break
        least = row["n"]
    top = counts.where("word <> ''").where(F.col("n") >= least).collect() if least else []
    top.sort(key=lambda r: (-r["n"], r["word"]))
    ends = counts.where("word = ''").first()
    words, sizes = [r["word"].encode() for r in top], np.array([r["n"] for r in top], np.int64)
    end = ends["n"] if ends else 0
    chosen = words[:vocabulary]
    inside = int(sizes[:vocabulary].sum())
    of_ids = np.array([end, n - inside - end, *sizes[:vocabulary]], float)
    net = train(training, Network.start(of_ids), {w: i for i, w in enumerate(chosen)})
    # Places of the smoothed counts outside the vocabulary: those words, and one unseen.
    places = v - len(chosen) - (end > 0)
    log_other = math.log10((of_ids[1] + places + 1) / (n + v + 1))
    first = settle(
        marked.mapInArrow(
            partial(
                _score, net=net, known=_listed(words), counts=sizes,
                vocabulary=len(chosen), end_count=end, n=n, v=v, log_other=log_other,
            ),
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, rare array<struct<word:binary,times:bigint>>",
        ).withColumn("row", F.monotonically_increasing_id())
    )
    bottom = math.log10(n + v + 1)
    rare = first.select("row", F.explode("rare").alias("w")).select("row", F.col("w.word").cast("string").alias("w"), F.col("w.times").alias("times"))
    others = counts.select(F.col("word").alias("known_word"), F.col("n").alias("c"))
    log = F.log10(F.coalesce("c", F.lit(0)) + 1.0) - F.lit(bottom)
    found = (
        rare.join(others, F.col("w") == F.col("known_word"), "left")
        .groupBy(F.col("row").alias("of"))
        .agg(
            F.sum(F.when(F.col("c").isNotNull(), F.col("times"))).alias("more"),
            F.sum(log * F.col("times")).alias("logs"),
            F.sum("times").alias("times"),
        )
    )
    logs, times = F.coalesce("logs", F.lit(0.0)), F.coalesce("times", F.lit(0))
    return (
        first.drop("rare").join(found, F.col("row") == F.col("of"), "left")
        .select(
            "doc_id", "held_out", "n_tokens",
            (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
            F.lit(n).cast("bigint").alias("train_tokens"),
            (F.col("base_score") + logs).alias("base_score"),
            (F.col("score") + logs - times * F.lit(log_other)).alias("score"),
        )
    )


__all__ = ["Network", "score", "score_documents", "train", "train_on", "vocabulary_size", "word_counts"]
