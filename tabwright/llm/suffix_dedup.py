"""Removal of long repeated byte strings, found in suffix order.

A byte goes if it is inside a string of ``WINDOW`` bytes that also starts anywhere else,
in the same document or another. Windows of that length are brought together in steps:

1. Every text is cut into pieces: neighbouring windows that share an anchor (``windows``).
   Equal windows are in pieces of one anchor hash at one distance from the anchor. A task
   sends one row per distinct piece of a batch: hashes and places, no text. Pieces whose
   anchor hash is met once are done; most texts end here. What a batch knows by itself goes
   past the task of the anchor hash: a passage in very many texts would fill that task.
2. Equal pieces are one class; if all pieces of an anchor hash are equal, every window of
   theirs repeats. Where pieces differ, the text of one piece per class goes to a task by
   its anchor hash. There the pieces are written as blocks of ``BLOCK`` bytes in step with
   their anchors, one after the other, and their suffixes are sorted by grouping
   (``suffix_sorting``). Equal windows are neighbours in that order, as they agree in all
   blocks inside them; whole windows are then compared by two 64-bit hashes.
3. Repeated windows go back to all places of their class and become spans of documents.

An anchor hash with more than ``MOST_CLASSES`` different pieces (a passage in very many
contexts) is not sorted in one task: its windows are counted by their own hashes, which
spreads them over all tasks and gives the same windows. Strings are told apart by 64-bit
hashes next to the anchor's 64 bits.

Defined cases: a NULL or empty text has no bytes and keeps none; rows with one id and
text repeat each other; a NULL id stands for its text; an empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabwright.llm.common import settle
from tabwright.llm.suffix_sorting import suffix_array
from tabwright.llm.windows import anchor_of, digest, pieces

WINDOW = 400
BLOCK = 8
MOST_CLASSES = 2_000
_SORT_BYTES = 1 << 21
_DOCS = 512
_PLACE = pa.struct([("rid", pa.int64()), ("mark", pa.int32()), ("start", pa.int64())])
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ASK, _DIFFERS, _REPEATS = 0, 1, 2


def _identified(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__rid`` and ``__mark``, which together name a document."""
    return docs.withColumns(
        {
            "__rid": F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text")),
            "__mark": F.hash("text").bitwiseAND(F.lit(0xFFFFF)),
        }
    )


def _bytes(column: pa.Array) -> list[bytes]:
    return [x.as_py() or b"" for x in column.cast(pa.binary())]


def _told(places: dict[tuple[int, int, int], list[tuple[int, int, int]]]) -> list[tuple]:
    """The rows of a batch, with ``known``: what the batch alone settles of them.

    Two different pieces of an anchor hash tell its task that pieces differ; more of them
    are ``_DIFFERS``. A piece met twice or more repeats as a whole: one place of it stands
    for the class, the others are ``_REPEATS``.
    """
    met: dict[int, int] = {}
    rows = []
    for (h, d, n), where in places.items():
        met[h] = met.get(h, 0) + 1
        rows.append((h, d, n, *where[0], None, len(where), _ASK if met[h] <= 2 else _DIFFERS))
        if len(where) > 1:
            more = [dict(zip(("rid", "mark", "start"), w, strict=True)) for w in where[2:]]
            rows.append((h, d, n, *where[1], more or None, len(where) - 1, _REPEATS))
    return rows


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for begin in range(0, whole.num_rows, _DOCS):
            batch = whole.slice(begin, _DOCS)
            rids, marks = batch.column("rid").to_pylist(), batch.column("mark").to_pylist()
            places: dict[tuple[int, int, int], list[tuple[int, int, int]]] = {}
            for rid, mark, text in zip(rids, marks, _bytes(batch.column("text")), strict=True):
                hashes, first, count = pieces(text, window)
                for h, a, n in zip(hashes.tolist(), first.tolist(), count.tolist()):
                    places.setdefault((h, digest(text[a : a + n + window - 1]), n), []).append((rid, mark, a))
            rows = _told(places)
            names = ["h", "digest", "n", "rid", "mark", "start", "more", "times", "known"]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(_PLACE), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


_PIECES = (
    "h bigint, digest bigint, n int, rid bigint, mark int, start bigint, "
    "more array<struct<rid:bigint,mark:int,start:bigint>>, times int, known int"
)


def _shared_pieces(docs: DataFrame, window: int) -> DataFrame:
    """Settled: pieces whose anchor hash is met at two places or more; ``mixed``: not all equal."""
    found = docs.select(F.col("__rid").alias("rid"), F.col("__mark").alias("mark"), "text").mapInArrow(
        partial(_cut, window=window), _PIECES
    )
    ask = F.col("known") == _ASK
    # Rows that ask meet at their anchor hash, the others are dealt by their place as well.
    same = W.partitionBy("h", "apart")
    return settle(
        found.withColumn("apart", F.when(ask, 0).otherwise(F.hash("rid", "start")))
        .withColumns(
            {
                "all_times": F.sum("times").over(same),
                "low": F.min("digest").over(same),
                "high": F.max("digest").over(same),
            }
        )
        .where((F.col("all_times") > 1) | ~ask)
        .withColumn("mixed", F.when(ask, F.col("low") < F.col("high")).otherwise(F.col("known") == _DIFFERS))
        .drop("all_times", "low", "high", "known", "apart")
    )


def _fetch(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted pieces; for crowded anchors the hashes of their windows."""
    names = ["h", "digest", "n", "times", "piece", "at", "window"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
    for batch in batches:
        for text, wanted in zip(_bytes(batch.column("text")), batch.column("wanted"), strict=True):
            rows = []
            for w in wanted.as_py():
                a, n = w["start"], w["n"]
                if w["crowded"]:
                    rows += [(w["h"], w["digest"], n, w["times"], None, i, digest(text[a + i : a + i + window])) for i in range(n)]
                else:
                    rows.append((w["h"], w["digest"], n, w["times"], text[a : a + n + window - 1], None, None))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def _rolling(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` neighbours, by doubling."""
    out, size = None, 0
    power, step = values.astype(np.uint64), 1
    while True:
        if width & step:
            if out is None:
                out, size = power, step
            else:
                tail = power[size:]
                m = min(out.size, tail.size)
                out, size = out[:m] * np.uint64(pow(int(_ODD), step, 2**64)) + tail[:m], size + step
        if step * 2 > width:
            break
        power = power[:-step] * np.uint64(pow(int(_ODD), step, 2**64)) + power[step:]
        step *= 2
    return out ^ (out >> np.uint64(32))


_BYTE = np.random.default_rng(7).integers(0, 2**64, (2, 257), dtype=np.uint64)


def repeated_windows(texts: list[bytes], anchors: list[int], window: int, block: int = BLOCK) -> list[np.ndarray]:
    """For each piece, which of its windows are met at another place of any of the pieces.

    ``anchors``: the place in each piece that blocks are in step with.
    """
    least = (window - block + 1) // block  # whole blocks inside any window
    symbols, where, owner = [], [], []
    flat, base = [], []
    at = 0
    for k, (text, anchor) in enumerate(zip(texts, anchors, strict=True)):
        data = np.frombuffer(text, np.uint8)
        first = anchor % block
        count = (data.size - first) // block
        symbols.append(np.frombuffer(text[first : first + count * block], f"<u{block}"))
        where.append(at + first + block * np.arange(count))
        owner.append(count)
        flat.append(data.astype(np.int64))
        flat.append(np.array([256]))
        base.append(at)
        at += data.size + 1
    joined = np.concatenate(flat)
    values, names = np.unique(np.concatenate(symbols), return_inverse=True)
    # Symbol 0 ends the whole, 1 stands between pieces.
    total = int(sum(owner)) + len(texts) + 1
    line = np.ones(total, np.int64)
    place = np.full(total, -1, np.int64)
    starts = np.cumsum([0] + [c + 1 for c in owner])
    inside = np.concatenate([np.arange(s, s + c) for s, c in zip(starts, owner, strict=False)])
    line[inside], place[inside] = names + 2, np.concatenate(where)
    line[-1] = 0
    order = np.array(suffix_array(line), np.int64)
    runs = _rolling(_BYTE[0][line % 257] * (line.astype(np.uint64) * _ODD + np.uint64(1)), least)
    key = np.full(total, np.uint64(0))
    key[: runs.size] = runs
    short = np.ones(total, bool)
    short[: runs.size] = False
    in_order, cut = key[order], short[order]
    alike = (in_order[1:] == in_order[:-1]) & ~cut[1:] & ~cut[:-1]
    near = np.zeros(total, bool)
    near[1:] |= alike
    near[:-1] |= alike
    candidates = place[order[near]]
    candidates = candidates[candidates >= 0]
    # A window's first whole block starts at most block - 1 bytes after the window.
    windows = np.unique((candidates[:, None] - np.arange(block)[None, :]).ravel())
    sizes = np.array([len(t) for t in texts])
    base = np.array(base)
    of = np.searchsorted(base, windows, side="right") - 1
    offset = windows - base[np.maximum(of, 0)]
    fits = (of >= 0) & (offset >= 0) & (offset + window <= sizes[np.maximum(of, 0)])
    windows, of, offset = windows[fits], of[fits], offset[fits]
    out = [np.empty(0, np.int64)] * len(texts)
    if not windows.size:
        return out
    exact = np.stack([_rolling(_BYTE[i][joined], window)[windows] for i in (0, 1)], 1)
    _, name, times = np.unique(exact, axis=0, return_inverse=True, return_counts=True)
    again = times[name.ravel()] > 1
    of, offset = of[again], offset[again]
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    return [offset[cuts[k] : cuts[k + 1]] for k in range(len(texts))]


def _sort(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows of each piece; rows come in order of their anchor hash."""
    waiting: list[tuple[int, int, int, int, bytes]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        texts = [w[4] for w in waiting]
        anchors = [anchor_of(t, window) for t in texts]
        found = repeated_windows(texts, anchors, window)
        rows = []
        for (h, d, n, times, _), offsets in zip(waiting, found, strict=True):
            if times > 1:
                rows.append((h, d, 0, n))
            elif offsets.size:
                cut = np.flatnonzero(np.diff(offsets) > 1) + 1
                rows += [(h, d, int(r[0]), r.size) for r in np.split(offsets, cut)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["h", "digest", "first", "count"]
        )

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("h", "digest", "n", "times", "piece")), strict=True):
            if size >= _SORT_BYTES and waiting and row[0] != waiting[-1][0]:
                yield flush()
                waiting, size = [], 0
            waiting.append(row)
            size += len(row[4])
    if waiting:
        yield flush()


def repeated_spans(docs: DataFrame, window: int = WINDOW, most_classes: int = MOST_CLASSES) -> DataFrame:
    """``rid``, ``mark`` and ``spans`` (start, size) of documents with something to remove.

    ``docs`` has ``text`` and the names that ``_identified`` gives. Spans may overlap.
    """
    shared = _shared_pieces(docs, window)
    place = F.struct("rid", "mark", "start")
    classes = (
        shared.where("mixed").groupBy("h", "digest", "n")
        .agg(F.sum("times").alias("times"), F.min(place).alias("place"))
    )
    classes = settle(classes)
    crowds = classes.groupBy(F.col("h").alias("ch")).agg(F.count(F.lit(1)).alias("classes")).where(F.col("classes") > most_classes)
    wanted = (
        classes.join(settle(crowds), F.col("h") == F.col("ch"), "left").withColumn("crowded", F.col("ch").isNotNull())
        .groupBy(F.col("place.rid").alias("wrid"), F.col("place.mark").alias("wmark"))
        .agg(F.collect_list(F.struct("h", "digest", "n", "times", F.col("place.start").alias("start"), "crowded")).alias("wanted"))
    )
    fetched = settle(
        docs.select("__rid", "__mark", "text")
        .join(wanted, (F.col("__rid") == F.col("wrid")) & (F.col("__mark") == F.col("wmark")))
        .select("text", "wanted")
        .mapInArrow(
            partial(_fetch, window=window),
            "h bigint, digest bigint, n int, times bigint, piece binary, at int, window bigint",
        )
        .dropDuplicates(["h", "digest", "at"])
    )
    by_order = (
        fetched.where("piece is not null").select("h", "digest", "n", "times", "piece")
        .repartition("h").sortWithinPartitions("h", "digest")
        .mapInArrow(partial(_sort, window=window), "h bigint, digest bigint, first int, count int")
    )
    crowded = fetched.where("piece is null").select("h", "digest", "times", "at", "window")
    often = crowded.groupBy(F.col("h").alias("oh"), F.col("window").alias("ow")).agg(F.sum("times").alias("all")).where("all > 1")
    by_count = crowded.join(often, (F.col("h") == F.col("oh")) & (F.col("window") == F.col("ow"))).select(
        "h", "digest", F.col("at").alias("first"), F.lit(1).alias("count")
    )
    found = settle(by_order.unionByName(by_count)).select(
        F.col("h").alias("fh"), F.col("digest").alias("fd"), "first", "count"
    )
    mixed = shared.where("mixed").join(found, (F.col("h") == F.col("fh")) & (F.col("digest") == F.col("fd")))
    equal = shared.where("not mixed").select("*", F.lit(0).alias("first"), F.col("n").alias("count"))
    places = F.concat(F.array(place), F.coalesce("more", F.array().cast("array<struct<rid:bigint,mark:int,start:bigint>>")))
    return (
        mixed.select(places.alias("places"), "first", "count")
        .unionByName(equal.select(places.alias("places"), "first", "count"))
        .select(F.explode("places").alias("p"), "first", "count")
        .groupBy(F.col("p.rid").alias("rid"), F.col("p.mark").alias("mark"))
        .agg(F.collect_list(F.struct((F.col("p.start") + F.col("first")).alias("start"), (F.col("count") + window - 1).alias("size"))).alias("spans"))
    )


def _with_spans(docs: DataFrame, window: int, most_classes: int) -> DataFrame:
    named = _identified(docs)
    spans = settle(repeated_spans(named, window, most_classes)).select(
        F.col("rid").alias("__of"), F.col("mark").alias("__marked"), F.col("spans").alias("__spans")
    )
    return named.join(spans, (F.col("__rid") == F.col("__of")) & (F.col("__mark") == F.col("__marked")), "left")


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs (first byte, one past the last) of overlapping or touching spans."""
    out: list[list[int]] = []
    for s in sorted((x["start"], x["start"] + x["size"]) for x in spans or []):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [(a, b) for a, b in out]


def _kept(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *[x for r in runs for x in r], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(_bytes(batch.column("text")), batch.column("__spans"), strict=True):
            runs = _merged(spans.as_py())
            rows.append((len(text), sum(b - a for a, b in runs), len(runs), hashlib.sha256(_kept(text, runs)).hexdigest()))
        kinds = [pa.int64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def removal_report(docs: DataFrame, window: int = WINDOW, most_classes: int = MOST_CLASSES) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return (
        _with_spans(plain, window, most_classes).select("doc_id", "text", "__spans")
        .mapInArrow(_report, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    )


def _trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [n for n in batch.schema.names if n != "__spans"]
        out = []
        for text, spans in zip(batch.column("text").cast(pa.binary()), batch.column("__spans"), strict=True):
            data = text.as_py()
            # A character cut in two at the edge of a span goes with the span.
            out.append(None if data is None else _kept(data, _merged(spans.as_py())).decode(errors="ignore"))
        texts = pa.array(out, pa.string())
        yield pa.RecordBatch.from_arrays([texts if n == "text" else batch.column(n) for n in names], names)


def without_repeats(docs: DataFrame, window: int = WINDOW, most_classes: int = MOST_CLASSES) -> DataFrame:
    """``docs`` with repeated strings taken out of ``text``, and ``n_chars`` (if there) counted anew."""
    names = docs.columns
    quoted = [F.col(f"`{n}`") for n in names]
    met = _with_spans(docs.select(F.col("doc_id"), F.col("text"), F.struct(*quoted).alias("__row")), window, most_classes)
    kept = met.select("text", "__row", "__spans").mapInArrow(
        _trim, docs.select(F.col("text"), F.struct(*quoted).alias("__row")).schema
    )
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return kept.select(
        *[(changed[n].cast(docs.schema[n].dataType) if n in changed else F.col("__row").getField(n)).alias(n) for n in names]
    )
