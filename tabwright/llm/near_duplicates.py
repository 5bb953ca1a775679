"""Near-duplicates by MinHash: banding, check of the whole sets, connected components.

1. Each text becomes a set of word shingles and a signature of minima of universal hash
   functions, cut into bands. With 24 bands of 4 minima, two sets with a similarity of
   0.85 miss each other in all bands once in 40 million times.
2. Equal sets form a class, by a 128-bit sum over the set. Only the least id of a class
   goes on, so copies, however many, cost one row each.
3. Classes that agree in a band share a bucket, in which every member is compared with
   the least one, on the full sets of both texts. Links give components, and only pairs
   of different components are still open. Buckets of fewer than ``FEW`` members are then
   compared whole.
4. Larger buckets hold near copies, or texts around one passage that are not near. Their
   members are dealt anew: two sets of the wanted similarity must share one of the rarest
   shingles of each (as many as they may lack, and one). Rare is told by a table of
   counts of fixed size; any order gives whole results. In these groups, in which many
   members are near copies, every member is compared with one pivot.
   Then most are in one component, and the rest of each family of groups is compared
   with all of it, block by block: a block of texts is one sorted list of shingles that
   each of the others is counted against. So k near copies cost about k comparisons, and
   those outside their component one pass over it; no link between components is lost.

Defined cases: a NULL or blank text has an empty set and is linked with nothing; rows
with one id are one document with the links of all of them; a NULL id is linked with
nothing, has a NULL component and is kept; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabwright.llm.common import settle
from tabwright.llm.components import connected_components
from tabwright.llm.hashing import batched, mixed, shingles, word_hashes

SHINGLE = 5
PERCENT = 80
BANDS = 24
ROWS = 4
SEED = 2
_BLOCK = 2048
_PIVOT_ROUNDS = 1
_BLOCK_TEXTS = 500
#: From so many members on a bucket is dealt anew by rare shingles.
FEW = 12
_CELLS = 1 << 20


def _set_of(words: np.ndarray, n: int) -> np.ndarray:
    return np.unique(shingles(words, n))


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    factor = random.integers(0, 2**64, count, dtype=np.uint64) | np.uint64(1)
    return factor, random.integers(0, 2**64, count, dtype=np.uint64)


def minima(items: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The least value of each universal hash function over a set."""
    least = np.full(factor.size, np.uint64(2**64 - 1))
    for i in range(0, items.size, _BLOCK):
        block = items[i : i + _BLOCK]
        least = np.minimum(least, (factor[:, None] * block[None, :] + shift[:, None]).min(axis=1))
    return least


def _sign(batches: Iterator[pa.RecordBatch], n: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    factor, shift = _functions(bands * rows)
    band = np.arange(bands, dtype=np.uint64)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        sizes, sums, keys = [], [], []
        for words in batched(x.as_py() for x in texts):
            items = _set_of(words, n)
            sizes.append(items.size)
            if not items.size:
                sums.append((0, 0))
                keys.append(None)
                continue
            sums.append((int(mixed(items).sum()), int(mixed(items ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum())))
            least = minima(items, factor, shift).reshape(bands, rows)
            key = band
            for j in range(rows):
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + least[:, j])
            keys.append(key.view(np.int64))
        low, high = (np.array([s[i] for s in sums], np.uint64).view(np.int64) for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(low, pa.int64()),
                pa.array(high, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
            ],
            ["doc_id", "n_shingles", "sum1", "sum2", "bands"],
        )


def signatures(docs: DataFrame, n: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id``, ``n_shingles``, a 128-bit sum over the set and the keys of its bands."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        partial(_sign, n=n, bands=bands, rows=rows),
        "doc_id bigint, n_shingles bigint, sum1 bigint, sum2 bigint, bands array<bigint>",
    )


def _compare(batches: Iterator[pa.RecordBatch], n: int, percent: int) -> Iterator[pa.RecordBatch]:
    known: dict[int, np.ndarray] = {}
    for batch in batches:
        ids = [batch.column(c).to_pylist() for c in ("a", "b")]
        texts = [batch.column(c).cast(pa.binary()) for c in ("text_a", "text_b")]
        linked = []
        for i in range(batch.num_rows):
            pair = []
            for side in (0, 1):
                name = (side, ids[side][i])
                if known.get(side, (None,))[0] != name:
                    known[side] = (name, _set_of(word_hashes(texts[side][i].as_py() or b""), n))
                pair.append(known[side][1])
            small, large = sorted(pair, key=len)
            shared = 0
            if 100 * small.size >= percent * large.size:
                shared = np.intersect1d(small, large, assume_unique=True).size
            linked.append(100 * shared >= percent * (small.size + large.size - shared))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"]
        )


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Settled: ids and texts of the documents whose id is in the only column of ``wanted``."""
    ids = wanted.toDF("id").distinct()
    return settle(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(ids, F.col("doc_id") == F.col("id"), "left_semi")
    )


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose numbers of shingles allow the similarity; no text is met for the others."""
    size = lambda s: classes.select(F.col("least").alias(f"id_{s}"), F.col("n_shingles").alias(f"n_{s}"))
    met = pairs.join(size("a"), F.col("a") == F.col("id_a")).join(size("b"), F.col("b") == F.col("id_b"))
    return met.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b")


def _links(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are near enough."""
    side = lambda s: texts.select(F.col("doc_id").alias(f"id_{s}"), F.col("text").alias(f"text_{s}"))
    met = pairs.join(side("a"), F.col("a") == F.col("id_a")).join(side("b"), F.col("b") == F.col("id_b"))
    return (
        met.select("a", "b", "text_a", "text_b")
        .mapInArrow(partial(_compare, n=n, percent=percent), "a bigint, b bigint, linked boolean")
        .where("linked")
        .select("a", "b")
    )


def _members(classes: DataFrame) -> DataFrame:
    """``bucket`` and ``doc`` for the buckets with two classes or more."""
    each = classes.select(F.col("least").alias("doc"), F.explode("bands").alias("bucket"))
    shared = each.groupBy(F.col("bucket").alias("shared")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return each.join(shared.select("shared"), F.col("bucket") == F.col("shared")).select("bucket", "doc")


def _placed(members: DataFrame, components: DataFrame | None) -> DataFrame:
    """Members with their component, in buckets that still have several of them."""
    if components is None:
        return members.withColumn("component", F.col("doc"))
    named = members.join(components, F.col("doc") == F.col("node"), "left").select(
        "bucket", "doc", F.coalesce("component", "doc").alias("component")
    )
    open_buckets = (
        named.groupBy(F.col("bucket").alias("open"))
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("held"))
        .where("low < high")
    )
    return named.join(open_buckets.select("open", "held"), F.col("bucket") == F.col("open")).drop("open")


def _cells(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """How often shingles are met in a batch of texts, by cell of a table."""
    for batch in batches:
        items = [_set_of(w, n) for w in batched(x.as_py() for x in batch.column("text").cast(pa.binary()))]
        cells = np.concatenate(items) % np.uint64(_CELLS) if items else np.empty(0, np.uint64)
        values, times = np.unique(cells.astype(np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(times)], ["cell", "times"])


def _rarest(batches: Iterator[pa.RecordBatch], n: int, percent: int, table: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, tokens = [], []
        texts = (x.as_py() for x in batch.column("text").cast(pa.binary()))
        for doc, words in zip(batch.column("doc_id").to_pylist(), batched(texts), strict=True):
            items = _set_of(words, n)
            order = np.lexsort((items, table[(items % np.uint64(_CELLS)).astype(np.int64)]))
            # A set of the wanted similarity lacks at most (100 - percent) % of these.
            prefix = items.size - -(-percent * items.size // 100) + 1
            tokens.append(items[order[:prefix]].view(np.int64))
            docs.append(np.full(tokens[-1].size, doc))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(tokens) if tokens else [], pa.int64()), pa.array(np.concatenate(docs) if docs else [], pa.int64())],
            ["bucket", "doc"],
        )


def _by_rare_shingles(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """``bucket`` (a rare shingle) and ``doc``, for shingles rare in two texts or more."""
    counted = texts.mapInArrow(partial(_cells, n=n), "cell bigint, times bigint").groupBy("cell").agg(F.sum("times").alias("times"))
    found = counted.toPandas()  # at most _CELLS rows
    table = np.zeros(_CELLS, np.int64)
    table[found["cell"].to_numpy(np.int64)] = found["times"].to_numpy(np.int64)
    each = settle(texts.mapInArrow(partial(_rarest, n=n, percent=percent, table=table), "bucket bigint, doc bigint"))
    shared = each.groupBy(F.col("bucket").alias("shared")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return each.join(shared.select("shared"), F.col("bucket") == F.col("shared")).select("bucket", "doc")


def _open_pairs(placed: DataFrame) -> int:
    return (
        placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inside"))
        .agg(F.sum((F.col("n") * F.col("n") - F.col("inside")) / 2))
        .first()[0]
        or 0
    )


def _pairs(placed: DataFrame, turn: int | None) -> DataFrame:
    """Pairs of different components: with the pivot of ``turn``, or all in a bucket."""
    other = placed.select(
        F.col("bucket").alias("b_bucket"), F.col("doc").alias("other"), F.col("component").alias("b_component")
    )
    if turn is not None:
        order = F.col("other") if turn == 0 else F.xxhash64("other", F.lit(turn))
        first = F.min_by(F.struct("other", "b_component"), order)
        other = other.groupBy("b_bucket").agg(first.alias("p")).select("b_bucket", "p.*")
    return (
        placed.join(other, F.col("bucket") == F.col("b_bucket"))
        .where(F.col("component") != F.col("b_component"))
        .select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b"))
        .distinct()
    )


def _compare_block(frame: pd.DataFrame, n: int, percent: int) -> pd.DataFrame:
    """Links of the block's seekers with its others, one for each component of these."""
    rest, seekers = frame[~frame["seeks"]], frame[frame["seeks"]]
    sets = [_set_of(w, n) for w in batched((t or "").encode() for t in rest["text"])]
    sizes = np.array([s.size for s in sets])
    items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    order = np.argsort(items)
    items, owner = items[order], np.repeat(np.arange(len(sets)), sizes)[order]
    docs, components = rest["doc"].to_numpy(), rest["component"].to_numpy()
    a, b = [], []
    for doc, component, words in zip(
        seekers["doc"], seekers["component"], batched((t or "").encode() for t in seekers["text"]), strict=True
    ):
        mine = _set_of(words, n)
        low, high = np.searchsorted(items, mine, "left"), np.searchsorted(items, mine, "right")
        size = high - low
        at = np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)
        shared = np.bincount(owner[at], minlength=len(sets))
        near = (100 * shared >= percent * (mine.size + sizes - shared)) & (components != component)
        _, first = np.unique(components[near], return_index=True)
        for other in docs[near][first]:
            a.append(min(doc, other))
            b.append(max(doc, other))
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _family_links(placed: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """All links between components of a family: groups that share members, directly or not."""
    least = placed.groupBy(F.col("bucket").alias("of")).agg(F.min("doc").alias("b"))
    ties = placed.join(least, F.col("bucket") == F.col("of")).select(F.col("doc").alias("a"), "b").distinct()
    families = connected_components(ties).select("node", F.col("component").alias("family"))
    members = settle(
        placed.select("doc", "component").distinct()
        .join(families, F.col("doc") == F.col("node")).select("family", "doc", "component")
    )
    by_component = members.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = settle(
        by_component.groupBy(F.col("family").alias("f")).agg(
            F.sum("n").alias("all"), F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("in_main")
        )
    )
    met = members.join(largest, F.col("family") == F.col("f")).withColumns(
        {
            "rows": F.expr(f"cast((all - 1) div {_BLOCK_TEXTS} as int)"),
            "columns": F.expr(f"cast((all - in_main) div {_BLOCK_TEXTS} as int)"),
            "h": F.xxhash64("doc"),
        }
    )
    kept = ["family", "doc", "component"]
    others = met.select(
        *kept, F.lit(False).alias("seeks"), F.pmod("h", F.col("rows") + 1).cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("columns"))).alias("column"),
    )
    seekers = met.where("component <> main").select(
        *kept, F.lit(True).alias("seeks"), F.explode(F.sequence(F.lit(0), F.col("rows"))).alias("row"),
        F.pmod("h", F.col("columns") + 1).cast("int").alias("column"),
    )
    named = texts.select(F.col("doc_id").alias("id"), "text")
    return (
        others.unionByName(seekers).join(named, F.col("doc") == F.col("id"))
        .groupBy("family", "row", "column")
        .applyInPandas(partial(_block_links, n=n, percent=percent), "a bigint, b bigint")
        .distinct()
    )


def _block_links(frame: pd.DataFrame, n: int, percent: int) -> pd.DataFrame:
    return _compare_block(frame, n, percent)


def find_links(classes: DataFrame, docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame | None:
    """Components (``node``, ``component``) of the classes that are linked with others."""
    members = settle(_members(classes))
    if not members.limit(1).count():
        return None
    # The one time that all texts are dealt by id; later steps choose among these.
    texts = _texts_of(docs, members.select("doc"))
    found: list[DataFrame] = []
    components: DataFrame | None = None
    checked: DataFrame | None = None

    def check(pairs: DataFrame, source: DataFrame) -> bool:
        """Compare the pairs; whether a link was found."""
        nonlocal checked
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = settle(_possible(pairs, classes, percent))
        checked = pairs if checked is None else checked.unionByName(pairs)
        return add(_links(pairs, source, n, percent))

    def add(new: DataFrame) -> bool:
        nonlocal components
        new = settle(new)
        if not new.limit(1).count():
            return False
        found.append(new)
        components = settle(connected_components(reduce(DataFrame.unionByName, found)))
        return True

    check(_pairs(members.withColumn("component", F.col("doc")), 0), texts)
    left = settle(_placed(members, components if components is not None else _no_components(members)))
    few = _pairs(left.where(F.col("held") < FEW), None)
    crowded = _texts_of(texts, left.where(F.col("held") >= FEW).select("doc"))
    dealt = settle(_by_rare_shingles(crowded, n, percent))
    size = dealt.count()
    check(few, _texts_of(texts, left.where(F.col("held") < FEW).select("doc")))
    for turn in range(1, _PIVOT_ROUNDS + 2):
        placed = settle(_placed(dealt, components if components is not None else _no_components(members)))
        still = _open_pairs(placed)
        if not still:
            break
        if still <= size:
            check(_pairs(placed, None), crowded)
            break
        if turn > _PIVOT_ROUNDS or not check(_pairs(placed, turn), crowded):
            add(_family_links(placed, crowded, n, percent))
            break
    return components


def _no_components(members: DataFrame) -> DataFrame:
    return members.select(F.col("doc").alias("node"), F.col("doc").alias("component")).where("false")


def near_duplicates(
    docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    Texts are linked if ``100 * shared >= percent * together`` of their ``n``-word
    shingles; ``component_id`` is the least id that links lead to.
    """
    signed = settle(signatures(docs, n, bands, rows))
    classes = settle(
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("sum1", "sum2", "n_shingles")
        .agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"))
    )
    found = find_links(classes, docs, n, percent)
    named = classes.select(*[F.col(c).alias(f"c_{c}") for c in ("sum1", "sum2", "n_shingles")], "least")
    if found is not None:
        named = named.join(found, F.col("least") == F.col("node"), "left").withColumn(
            "least", F.coalesce("component", "least")
        ).drop("node", "component")
    same = (F.col("sum1") == F.col("c_sum1")) & (F.col("sum2") == F.col("c_sum2")) & (F.col("n_shingles") == F.col("c_n_shingles"))
    return signed.drop("bands").join(named, same, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("least", "doc_id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are kept; of rows with one id, the one with the least text."""
    kept = near_duplicates(docs, **settings).where("kept and doc_id is not null").select(F.col("doc_id").alias("__kept")).distinct()
    first = W.partitionBy("doc_id").orderBy("text")
    with_id = (
        docs.join(kept, F.col("doc_id") == F.col("__kept"), "left_semi")
        .withColumn("__nth", F.row_number().over(first))
        .where("__nth = 1")
        .drop("__nth")
    )
    return with_id.unionByName(docs.where("doc_id is null"))
