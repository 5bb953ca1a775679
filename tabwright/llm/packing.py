"""Packing token pieces into sequences by the sum-of-squares rule.

A document's ids are cut into full pieces, each a sequence of its own, and a rest. Rests
are packed online: each goes on the fill level (or a new sequence) that makes the sum,
over the levels, of the squared number of partly filled sequences least; a level array
holds these numbers, so the state does not grow with the rows. Near the end some
sequences are left partly filled. A fixed share of the rests, chosen by hash, is kept
back for them: they are cut to fill those gaps, and what remains of them is laid end to
end. So only the last sequence of a group of pieces has padding.

Pieces are dealt by hash to groups of about ``GROUP`` pieces; each group is packed by
itself, and a lost one is packed again with the same result. Ids are computed in one pass
over the texts; only lengths and checksums are shuffled, and the ids of the rests that
may be cut.

Defined cases: a NULL text is an empty one and becomes the end id alone; repeated rows
are documents of their own, told apart by the order of their columns; no rows give no
sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import runs_of_bytes, settle

LENGTH = 2048
END = 1
VOCABULARY = "word_bpe_49k.json"
GROUP = 50_000
#: One rest in so many may be cut.
CUTTABLE = 8
_SEED = 5
_KNOWN_WORDS = 700_000
#: Texts encoded in one go have so many bytes, or are one text.
_RUN_BYTES = 1 << 22
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary, part bigint"
PLACED = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


#: Between words that are encoded in one go; its id is met in no word without its text.
_MARK = "<|startoftext|>"


#: A Latin letter (below U+0250; all but U+0130 stay letters in lower case) and a sign that
#: the vocabulary's splitting parts from it.
_LETTER_AND_SIGN = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])([.,!?;:&#$%*])"


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= array.size:
        return array
    out = np.zeros(max(size, 2 * array.size), array.dtype)
    out[: array.size] = array
    return out


class Encoder:
    """Ids of texts; words met before are looked up.

    The vocabulary's own splitting never joins what white space separates, nor letters
    and the signs after them, and it lower-cases letters; so a text's ids are those of
    its words one after the other, and ``word,`` has the ids of both its parts.
    """

    def __init__(self, path: str | None = None) -> None:
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        self._tokenizer = Tokenizer.from_file(path)
        self._mark = self._tokenizer.token_to_id(_MARK)
        self._forget()

    def _forget(self) -> None:
        self._known: dict[bytes, int] = {}
        self._starts = np.zeros(1 << 10, np.int64)
        self._flat = np.empty(1 << 10, np.uint32)

    def _add(self, words: list[bytes], sizes: np.ndarray, flat: np.ndarray) -> None:
        at = len(self._known)
        end = int(self._starts[at])
        self._known.update(zip(words, range(at, at + len(words)), strict=True))
        # Both grow by doubling, so that adding costs what is added.
        self._starts = _room(self._starts, at + 1 + len(words))
        self._starts[at + 1 : at + 1 + len(words)] = end + np.cumsum(sizes)
        self._flat = _room(self._flat, end + flat.size)
        self._flat[end : end + flat.size] = flat

    def _encode_words(self, words: list[bytes]) -> None:
        plain = [w for w in words if b"<|" not in w] if self._mark is not None else []
        if plain:
            texts = b" ".join(plain).decode().split(" ")
            joined = [_MARK.join(texts[i : i + 500]) + _MARK for i in range(0, len(texts), 500)]
            found = self._tokenizer.encode_batch_fast(joined, add_special_tokens=False)
            flat = np.concatenate([np.array(e.ids, np.uint32) for e in found])
            marks = np.flatnonzero(flat == self._mark)
            self._add(plain, np.diff(np.concatenate(([-1], marks))) - 1, flat[flat != self._mark])
        for w in words if self._mark is None else [w for w in words if b"<|" in w]:
            ids = np.array(self._tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.uint32)
            self._add([w], np.array([ids.size]), ids)

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known words one after the other, and how many each has."""
        first, size = self._starts[at], self._starts[at + 1] - self._starts[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if ends.size else 0
        return self._flat[np.arange(total) + np.repeat(first - (ends - size), size)], size

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text and the end id; each different word is looked up once."""
        if len(self._known) > _KNOWN_WORDS:
            self._forget()
        texts = pc.fill_null(texts, "")
        parted = pc.replace_substring_regex(pc.ascii_lower(texts), _LETTER_AND_SIGN, r"\1 \2")
        trimmed = pc.ascii_trim_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, parted))
        split = pc.ascii_split_whitespace(trimmed)
        counts = np.where(pc.equal(trimmed, "").to_numpy(False), 0, pc.list_value_length(split).to_numpy())
        every = split.flatten()
        every = every.filter(pc.not_equal(every, "")).dictionary_encode()
        words = every.dictionary.cast(pa.binary()).to_pylist()
        at = np.fromiter(map(self._known.get, words, repeat(-1)), np.int64, len(words))
        missed = np.flatnonzero(at < 0)
        if missed.size:
            missing = [words[i] for i in missed.tolist()]
            self._encode_words(missing)
            at[missed] = np.fromiter(map(self._known.__getitem__, missing), np.int64, len(missing))
        ids, size = self._gather(at[every.indices.to_numpy()])
        # Ids up to the end of each text, where the end id goes in.
        upto = np.concatenate(([0], np.cumsum(size)))[np.cumsum(counts)]
        ids = np.insert(ids, upto, np.uint32(END))
        return np.split(ids, (upto + np.arange(1, len(counts) + 1))[:-1])


_ENCODERS: dict[str | None, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """The worker's encoder, kept from task to task with the words it knows."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _cut(batches: Iterator[pa.RecordBatch], path: str | None, length: int) -> Iterator[pa.RecordBatch]:
    ids_of = encoder(path)
    for batch in batches:
        doc_ids, salts = batch.column("doc_id").to_pylist(), batch.column("salt").to_pylist()
        column = batch.column("text")
        for begin, end in runs_of_bytes(column, _RUN_BYTES):
            rows = []
            for i, ids in enumerate(ids_of.encode(column.slice(begin, end - begin)), begin):
                for start in range(0, ids.size, length):
                    piece = ids[start : start + length]
                    part = zlib.crc32(f"{salts[i]}:{start}".encode())
                    spare = piece.size < length and part % CUTTABLE == 0
                    rows.append(
                        (doc_ids[i], start, piece.size, checksum(piece), ids.size,
                         piece.astype("<u4").tobytes() if spare else None, part // CUTTABLE)
                    )
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "part"]
            kinds = [pa.int64()] * 5 + [pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names
            )


def token_pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """All ids of ``docs`` (``doc_id``, ``text``) in pieces of at most ``length``."""
    salted = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("doc_id", "text", F.lit(_SEED)).alias("salt")
    )
    return salted.mapInArrow(partial(_cut, path=path, length=length), PIECE)


def sum_of_squares(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
    """Where each size goes: its sequence, its offset there, and the fill of open sequences.

    Adding a piece of size s to a sequence at level h takes one from the count at h and
    adds one at h + s; the change in the sum of squares is 2 (count[h+s] - count[h] + 1),
    with counts of empty and of full sequences taken as none.
    """
    count = np.zeros(length + 1, np.int64)
    levels: list[list[int]] = [[] for _ in range(length + 1)]
    sequence, offset = np.empty(sizes.size, np.int64), np.empty(sizes.size, np.int64)
    used = 0
    none = np.int64(2**62)
    for i, s in enumerate(sizes.tolist()):
        here, then = count[: length - s + 1], count[s:]
        change = 2 * (then - here + 1)
        change[here == 0] = none
        change[0] = 2 * count[s] + 1  # a new sequence
        change[-1] = 1 - 2 * here[-1] if length - s and here[-1] else change[-1]  # filled up
        # Among equals the fullest, which leaves the least open.
        h = length - s - int(np.argmin(change[::-1]))
        if h:
            at = levels[h].pop()
            count[h] -= 1
        else:
            at, used = used, used + 1
        sequence[i], offset[i] = at, h
        if h + s < length:
            levels[h + s].append(at)
            count[h + s] += 1
    still_open = {at: h for h, each in enumerate(levels) for at in each}
    return sequence, offset, still_open


def _pack(key: tuple, group: pd.DataFrame, length: int) -> pd.DataFrame:
    base = int(key[0]) << 40
    group = group.sort_values(["part", "doc_id", "start", "ids_crc32"], kind="stable")
    full = (group["length"] == length).to_numpy()
    spare = group["ids"].notna().to_numpy()
    whole, rests, spares = group[full], group[~full & ~spare], group[~full & spare]
    sequence, offset, still_open = sum_of_squares(rests["length"].to_numpy(np.int64), length)
    rows = [
        whole.assign(sequence_id=np.arange(len(whole)), offset=0),
        rests.assign(sequence_id=len(whole) + sequence, offset=offset),
    ]
    used = len(whole) + (int(sequence.max()) + 1 if sequence.size else 0)
    gaps = sorted(((h, at) for at, h in still_open.items()), reverse=True)  # the fullest first
    gaps = [(len(whole) + at, h) for h, at in gaps]
    cut = []
    level, at, gaps = (gaps[0][1], gaps[0][0], gaps[1:]) if gaps else (0, used, [])
    used += at == used
    for doc_id, start, tokens, data in spares[["doc_id", "start", "doc_tokens", "ids"]].itertuples(index=False):
        ids = np.frombuffer(data, "<u4")
        while ids.size:
            if level == length:
                if gaps:
                    (at, level), gaps = gaps[0], gaps[1:]
                else:
                    at, level, used = used, 0, used + 1
            piece, ids = ids[: length - level], ids[length - level :]
            cut.append((doc_id, start, piece.size, checksum(piece), tokens, at, level))
            level += piece.size
            start += piece.size
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = [r[names] for r in rows] + [pd.DataFrame(cut, columns=names)]
    out = pd.concat([r for r in rows if len(r)], ignore_index=True)
    out["sequence_id"] += base
    return out


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id`` and ``offset``."""
    pieces = settle(token_pieces(docs, path, length))
    groups = -(-max(1, pieces.count()) // group)
    dealt = pieces.withColumn("group", F.pmod("part", F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(partial(_pack_group, length=length), PLACED)


def _pack_group(key: tuple, frame: pd.DataFrame, length: int) -> pd.DataFrame:
    return _pack(key, frame, length)


def sequence_ids(docs: DataFrame, packed: DataFrame, path: str | None = None) -> DataFrame:
    """The packed pieces with their ``ids``: texts are encoded again and cut as planned."""
    plan = packed.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("plan")
    )
    met = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(plan, "doc_id")
    return met.mapInArrow(partial(_fill, path=path), "sequence_id bigint, offset bigint, doc_id bigint, start bigint, ids array<int>")


def _fill(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    ids_of = encoder(path)
    for batch in batches:
        doc_ids = batch.column("doc_id").to_pylist()
        plans = batch.column("plan").to_pylist()
        column = batch.column("text")
        for begin, end in runs_of_bytes(column, _RUN_BYTES):
            rows = [
                (p["sequence_id"], p["offset"], doc_ids[i], p["start"], ids[p["start"] : p["start"] + p["length"]].astype(np.int32))
                for i, ids in enumerate(ids_of.encode(column.slice(begin, end - begin)), begin)
                for p in plans[i]
            ]
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                ["sequence_id", "offset", "doc_id", "start", "ids"],
            )
