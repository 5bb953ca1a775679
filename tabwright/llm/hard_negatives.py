"""Hard negatives: large inner products with rows of other labels, by pruned search.

Vectors become integers; the score of a row for an anchor is their inner product. An
anchor's positives are its best rows of the same label; its hard negatives, for each
positive, the best rows of other labels whose score lies between a share of the positive's
score and that score.

Rows are sorted by label and length over all tasks and cut into blocks; anchors are dealt
into blocks by hash. Each pair of blocks meets in one group of bounded size, with no
vector of an anchor or row in more than one place at a time. Inside, rows of a label form
buckets by length. A bucket whose longest vector cannot reach the anchor's limit is left
out. Otherwise the limit, divided by both lengths, is a least cosine t; the anchor's
largest coordinates q are its focus, and a row can reach t only if its coordinate there
lies within q * t -+ sqrt((1 - t^2) * (1 - q^2)). Binary search in the bucket's sorted
list of that coordinate gives the rows in range; those in range at every focus coordinate
are candidates and get their exact product. Limits rise as results come in: an anchor's
limit is the score of its fifth best row so far. Each pair of blocks sends at most
five rows for an anchor and positive, and the best of these are taken in Spark.

Defined cases: rows with a NULL id, label or vector, or a component that is NULL or not
finite take no part; of rows with one id the least by label and vector counts; of vectors
of unequal length the shorter is filled up with zeros; equal scores go by smaller id; no
positives or negatives give no rows. An empty table gives an empty table. Products are
exact: in 64-bit floats while they fit 53 bits, in Python's integers beyond; scores beyond
a bigint are held at its ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window as W

from tabwright.llm.common import settle

#: Rows and anchors that meet in one group, rows of a length bucket, focus coordinates.
ROWS, ANCHORS, BUCKET, FOCUS = 5000, 2000, 1000, 4
#: Below this least cosine every range covers nearly all rows: the bucket is taken whole.
_USEFUL = 0.3
_EXACT = 2.0**53
_LEAST, _MOST = -(2**63), 2**63 - 1

_BLOCK = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("labels", T.ArrayType(T.LongType())), T.StructField("vectors", T.ArrayType(T.ArrayType(T.DoubleType()))),
])
_POSITIVES = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor_id", "positive_id", "positive_score")])
_NEGATIVES = T.StructType([*_POSITIVES.fields, *[T.StructField(n, T.LongType()) for n in ("negative_id", "negative_score")]])


def clean_vectors(embeddings: DataFrame, label: Column, scale: float = 256.0) -> DataFrame:
    """vec_id, label and integer components (as doubles) of the rows that take part."""
    usable = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = embeddings.where(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & usable).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
        F.transform("embedding", lambda x: x.cast("double")).alias("v"),
    )
    least = kept.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    # Scaling by a power of two is exact; components beyond 2^52 have no fraction to drop.
    whole = F.transform("row.v", lambda x: F.when(F.abs(x) < 2.0**44, F.floor(x * scale).cast("double")).otherwise(x * scale))
    return least.select("vec_id", F.col("row.label").alias("label"), whole.alias("v"))


def _one_row(rows: pa.RecordBatch | pa.Table) -> dict[str, pa.Array]:
    """Ids, labels and vectors of several rows as one array each."""
    def packed(column: pa.Array | pa.ChunkedArray) -> pa.Array:
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
        return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)

    return {"ids": packed(rows.column("vec_id")), "labels": packed(rows.column("label")), "vectors": packed(rows.column("v"))}


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a task as blocks, one row each."""
    part, seq = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            block = _one_row(batch.slice(start, most))
            yield pa.RecordBatch.from_arrays([pa.array([part + seq]), *[c.cast(schema.field(n).type) for n, c in block.items()]], schema=schema)
            seq += 1


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros to ``width``."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy()
    if (lengths == width).all():
        return flat.reshape(len(vectors), width)
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


class _Block:
    """Ids, labels and vectors of one row of blocks."""

    def __init__(self, table: pa.Table):
        self.ids, self.labels, self._vectors = (table.column(n).combine_chunks().flatten() for n in ("ids", "labels", "vectors"))
        self.ids, self.labels = self.ids.to_numpy(), self.labels.to_numpy()
        self.width = int(np.diff(self._vectors.offsets.to_numpy()).max(initial=0))

    def vectors(self, width: int) -> np.ndarray:
        return _matrix(self._vectors, width)


class LengthBucket:
    """Rows of one label and about one length, with a sorted list for each coordinate."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        self.ids, self.vectors, self.longest = ids, vectors, float(lengths.max(initial=0.0))
        self._lengths, self._lists = lengths, None

    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        if self._lists is None:
            unit = (self.vectors / np.maximum(self._lengths, 1e-300)[:, None]).T
            order = np.argsort(unit, axis=1)
            self._lists = order, np.take_along_axis(unit, order, axis=1)
        return self._lists

    def candidates(self, focus: np.ndarray, unit: np.ndarray, length: float, limit: float) -> np.ndarray | slice | None:
        """Places of all rows that may reach ``limit`` (and others); None if there is none."""
        if limit <= 0 or not length:
            return None if limit > 0 else slice(None)
        # A little below the true value, so that rounding never drops a row.
        t = limit / (length * self.longest) * (1 - 1e-12) if self.longest else 2.0
        if t > 1:
            return None
        if t < _USEFUL:
            return slice(None)
        order, values = self._sorted()
        met = np.zeros(len(self.ids), dtype=np.int8)
        for f in focus:
            q = float(unit[f])
            reach = ((1 - t * t) * max(0.0, 1 - q * q)) ** 0.5 + 1e-9
            # Beyond t the range ends at 1, below -t it begins at -1.
            low = 0 if q < -t else np.searchsorted(values[f], q * t - reach, "left")
            high = len(met) if q > t else np.searchsorted(values[f], q * t + reach, "right")
            met[order[f, low:high]] += 1
        return np.flatnonzero(met == len(focus))


def _buckets(block: _Block, vectors: np.ndarray, label: int) -> list[LengthBucket]:
    """Buckets of one label of a block, the longest vectors first."""
    mine = np.flatnonzero(block.labels == label)
    lengths = np.sqrt(np.square(vectors[mine]).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    mine, lengths = mine[order], lengths[order]
    return [LengthBucket(block.ids[mine[i : i + BUCKET]], vectors[mine[i : i + BUCKET]], lengths[i : i + BUCKET]) for i in range(0, len(mine), BUCKET)]


def _products(vectors: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products."""
    if exact:
        return (vectors @ anchor).astype(np.int64)
    whole = [int(a) for a in anchor]
    return np.array([min(max(sum(int(x) * a for x, a in zip(row, whole, strict=True)), _LEAST), _MOST) for row in vectors], dtype=np.int64)


class Best:
    """The best few (score, id) so far: higher scores first, then smaller ids."""

    def __init__(self, most: int):
        self.most, self.rows = most, []

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.most:
            enough = np.partition(scores, len(scores) - self.most)[len(scores) - self.most]
            near = scores >= enough
            scores, ids = scores[near], ids[near]
        self.rows = sorted([*self.rows, *zip(scores.tolist(), ids.tolist(), strict=True)], key=lambda r: (-r[0], r[1]))[: self.most]

    def limit(self) -> int | None:
        """A row must score at least so much to get in; None while there is room."""
        return self.rows[-1][0] if len(self.rows) == self.most else None


class _Pair:
    """A block of anchors and a block of rows, with what both searches need."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        self.anchors, rows_ = _Block(anchors), _Block(rows)
        width = max(self.anchors.width, rows_.width)
        self.vectors, vectors = self.anchors.vectors(width), rows_.vectors(width)
        self.lengths = np.sqrt(np.square(self.vectors).sum(axis=1))
        self.units = self.vectors / np.maximum(self.lengths, 1e-300)[:, None]
        self.focus = np.argsort(-np.abs(self.units), axis=1)[:, :FOCUS]
        longest = np.sqrt(np.square(vectors).sum(axis=1)).max(initial=0.0)
        self.exact = bool(self.lengths.max(initial=0.0) * longest < _EXACT)
        self.buckets = {int(x): _buckets(rows_, vectors, x) for x in np.unique(rows_.labels)}

    def near(self, i: int, bucket: LengthBucket, limit: float) -> tuple[np.ndarray, np.ndarray] | None:
        """Scores and ids of the candidates of a bucket for an anchor."""
        places = bucket.candidates(self.focus[i], self.units[i], float(self.lengths[i]), limit)
        if places is None:
            return None
        return _products(bucket.vectors[places], self.vectors[i], self.exact), bucket.ids[places]


def _best_positives(pair: _Pair, most: int) -> list[dict]:
    out = []
    for i, (anchor, label) in enumerate(zip(pair.anchors.ids.tolist(), pair.anchors.labels.tolist(), strict=True)):
        best = Best(most)
        for bucket in pair.buckets.get(label, ()):
            limit = best.limit()
            if found := pair.near(i, bucket, float("-inf") if limit is None else limit):
                scores, ids = found
                other = ids != anchor
                best.offer(scores[other], ids[other])
        out += [{"anchor_id": anchor, "positive_id": p, "positive_score": s} for s, p in best.rows]
    return out


def _best_negatives(pair: _Pair, positives: dict[int, list[tuple[int, int]]], most: int, percent: int) -> list[dict]:
    order = sorted((b.longest, label, k) for label, buckets in pair.buckets.items() for k, b in enumerate(buckets))[::-1]
    out = []
    for i, (anchor, label) in enumerate(zip(pair.anchors.ids.tolist(), pair.anchors.labels.tolist(), strict=True)):
        # percent * positive <= 100 * negative <= 100 * positive needs a positive of 0 or more.
        wanted = {s: Best(most) for s, _ in positives.get(anchor, ()) if s >= 0}
        floors = {s: -(-percent * s // 100) for s in wanted}
        for _, other, k in order if wanted else ():
            if other == label:
                continue
            limits = {s: max(floors[s], b.limit() if b.limit() is not None else floors[s]) for s, b in wanted.items()}
            found = pair.near(i, pair.buckets[other][k], min(limits.values()))
            if not found:
                continue
            scores, ids = found
            for s, b in wanted.items():
                fit = (scores >= limits[s]) & (scores <= s)
                if fit.any():
                    b.offer(scores[fit], ids[fit])
        out += [
            {"anchor_id": anchor, "positive_id": p, "positive_score": s, "negative_id": n, "negative_score": x}
            for s, p in positives.get(anchor, ()) if s >= 0 for x, n in wanted[s].rows
        ]
    return out


def _meeting(anchors: DataFrame, rows: DataFrame, n_rows: int, n_anchors: int, work, schema: T.StructType) -> DataFrame:
    """Apply ``work`` to each pair of blocks: anchors by slot, rows by the task that cut the block."""
    arrow = to_arrow_schema(schema)

    def both(a: pa.Table, b: pa.Table) -> pa.Table:
        found: list[dict] = []
        for k in range(b.num_rows if a.num_rows else 0):
            found += work(a, b.slice(k, 1))
        return pa.Table.from_pylist(found, arrow)

    left = anchors.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
    right = rows.withColumn("at", F.shiftright("block", 32).cast("int")).withColumn(
        "slot", F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1)))
    )
    return left.groupBy("slot", "at").cogroup(right.groupBy("slot", "at")).applyInArrow(both, schema)


def _first(found: DataFrame, parts: list[str], score: str, row: str, most: int) -> DataFrame:
    order = W.partitionBy(*parts).orderBy(F.desc(score), row)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(embeddings: DataFrame, label: Column, anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """The hardest negatives of the rows where ``anchor`` (over vec_id and label) holds, for each positive."""
    rows = settle(clean_vectors(embeddings, label))
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n_rows = max(1, ceil(rows.count() / ROWS))
    arrow = to_arrow_schema(_BLOCK)
    blocks = settle(
        rows.withColumn("length", length).repartitionByRange(n_rows, "label", F.desc("length"), "vec_id")
        .sortWithinPartitions("label", F.desc("length"), "vec_id").select("vec_id", "label", "v")
        .mapInArrow(lambda batches: _cut(batches, arrow, ROWS), _BLOCK)
    )
    chosen = settle(rows.where(anchor))
    n_anchors = max(1, ceil(chosen.count() / ANCHORS))
    n_blocks = 1 + (blocks.agg(F.max(F.shiftright("block", 32))).first()[0] or 0)
    slots = chosen.withColumn("slot", F.pmod(F.xxhash64("vec_id"), F.lit(n_anchors)).cast("int"))
    near = _meeting(slots, blocks, n_blocks, n_anchors, lambda a, b: _best_positives(_Pair(pa.table(_one_row(a)), b), positives), _POSITIVES)
    best = settle(_first(near, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank"))

    told = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("positive_score", "positive_id"))).alias("positives"))
    asked = slots.join(told, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")

    def negatives_of(a: pa.Table, b: pa.Table) -> list[dict]:
        mine_ = dict(zip(a.column("vec_id").to_pylist(), ([(p["positive_score"], p["positive_id"]) for p in ps] for ps in a.column("positives").to_pylist()), strict=True))
        return _best_negatives(_Pair(pa.table(_one_row(a)), b), mine_, negatives, percent)

    hard = _meeting(asked, blocks, n_blocks, n_anchors, negatives_of, _NEGATIVES)
    return _first(hard, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    )
