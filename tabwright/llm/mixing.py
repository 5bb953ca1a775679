"""Mixing sources to target weights, in fixed-length blocks.

The words of each source form one stream (documents in a fixed pseudorandom order) that
is cut into blocks of a fixed number of words. The mix is a row of slots, dealt to output
shards of equal length. A keyed permutation of all slots decides which source a slot
belongs to: the sources of a shard are then a multinomial draw given the totals, so the
totals meet their targets exactly while the shards vary. The k-th slot of a source takes
the block at place k of a keyed permutation of that source's block numbers, going round
again (with another key) when the source is used more than once. Slots and documents meet
by an equi-join on (source, block number).

Permutations are swap-or-not ciphers: bijections of any range made of a few hashes, so
any task can compute any slot and a rerun gives the same mix. No text moves to decide the
mix: only sizes do. A source, however large, is spread over buckets and blocks.

Defined cases: NULL and blank texts have size 0 and are taken 0 times; NULL is a source
of its own and the last one; rows with the same id and text are documents of their own
and are ordered by their columns; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabwright.llm.common import BLANKS, numbered, settle, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 256
SLOTS_PER_SHARD = 1024
SEED = 20
BUCKETS = 1024
_ROUNDS = 24
_TASK_SLOTS = 50_000


def permuted(index: Column, size: Column, *key: Column | int) -> Column:
    """Where ``index`` goes in the permutation of 0 .. size-1 named by ``key``."""
    keys = [k if isinstance(k, Column) else F.lit(k) for k in key]

    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(F.xxhash64(r, *keys) - x, size)
        upper = F.greatest(x, partner)
        return F.when(F.pmod(F.xxhash64(upper, r, *keys), F.lit(2)) == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), index.cast("bigint"), swap)


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """One row per source (``source``, ``source_size``) with ``target``.

    Sources in order of code points, NULL last, get ``weights`` in turn. They share
    ``share`` of all words by weight; none gets more than ``most`` times its size, and
    what it would get beyond goes to the others by weight until none is above. Each step
    of that is one aggregate to two sums; nothing but those reaches the driver.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank, F.lit(len(weights))))
    table = settle(
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * float(most))
    )
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * level >= F.col("limit")
        n, spent, rest = table.agg(
            F.sum(above.cast("int")), F.sum(F.when(above, F.col("limit"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n is None or n == full or not rest:
            break
        full, level = n, (total - (spent or 0.0)) / rest
    return table.select(
        "source", "source_size", F.least(F.col("weight") * level, F.col("limit")).alias("target")
    )


def _plan(targets: DataFrame, block: int) -> DataFrame:
    """Per source: blocks, how often each is surely taken, and how many once more."""
    words = F.round("target").cast("bigint")
    rounds = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("bigint")
    n = F.ceil(F.col("source_size") / block).cast("bigint")
    rest = words - rounds * F.col("source_size")
    short = n * block - F.col("source_size")
    # Place of the last, shorter block in the permutation of the unfinished round.
    place = F.when(n > 0, permuted(n - 1, n, F.lit(SEED), F.col("source"), rounds)).otherwise(F.lit(0))
    first = F.ceil(rest / block).cast("bigint")
    drawn = F.when(place >= first, first).otherwise(F.ceil((rest + short) / block).cast("bigint"))
    before = (drawn - 1) * block - F.when(place < drawn - 1, short).otherwise(0)
    return (
        targets.withColumns({"blocks": n, "rounds": rounds, "rest": rest, "short": short})
        .withColumn("drawn", F.when(F.col("rest") > 0, drawn).otherwise(F.lit(0)).cast("bigint"))
        .withColumn("last_words", F.when(F.col("rest") > 0, F.col("rest") - before))
    )


def source_slots(targets: DataFrame, block: int = BLOCK_WORDS, shard: int = SLOTS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """One row per slot of the mix: ``slot``, ``shard``, ``source``, ``round``, ``block`` and
    ``words``, how many words of the block (from its start) the slot takes."""
    plan = _plan(targets, block).withColumn("slots", F.col("rounds") * F.col("blocks") + F.col("drawn"))
    by_source = W.orderBy(F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    plan = plan.withColumn("first_slot", F.sum("slots").over(by_source) - F.col("slots"))
    plan = settle(plan.withColumn("all_slots", F.sum("slots").over(W.partitionBy())))
    # A source's draws are made in runs of at most one shard's length, spread over tasks.
    total = plan.agg(F.sum("slots")).first()[0] or 0
    runs = plan.where("slots > 0").select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(slots - 1) div {shard}"))).alias("run")
    ).repartition(1 + total // _TASK_SLOTS, "source", "run")
    draws = runs.select(
        "*",
        F.explode(
            F.sequence(F.col("run") * shard, F.least((F.col("run") + 1) * shard, F.col("slots")) - 1)
        ).alias("draw"),
    )
    position = F.col("draw") % F.col("blocks")
    turn = F.expr("draw div blocks")
    # The inverse of a swap-or-not cipher is the same rounds backwards; a slot's source is
    # given by the inverse, so here the draw names the slot it lands on.
    return (
        draws.withColumns(
            {
                "slot": permuted(F.col("first_slot") + F.col("draw"), F.col("all_slots"), seed),
                "round": turn,
                "block": unpermuted(position, F.col("blocks"), F.lit(seed), F.col("source"), turn),
            }
        )
        .withColumn("shard", F.expr(f"slot div {shard}"))
        .withColumn(
            "words",
            F.when(
                (F.col("round") == F.col("rounds")) & (position == F.col("drawn") - 1), F.col("last_words")
            ).otherwise(F.lit(block).cast("bigint") - F.when(F.col("block") == F.col("blocks") - 1, F.col("short")).otherwise(0)),
        )
        .select("slot", "shard", "source", "round", "block", "words")
    )


def unpermuted(index: Column, size: Column, *key: Column | int) -> Column:
    """The inverse of ``permuted``."""
    keys = [k if isinstance(k, Column) else F.lit(k) for k in key]

    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(F.xxhash64(r, *keys) - x, size)
        upper = F.greatest(x, partner)
        return F.when(F.pmod(F.xxhash64(upper, r, *keys), F.lit(2)) == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(_ROUNDS), F.lit(1), F.lit(-1)), index.cast("bigint"), swap)


def source_streams(docs: DataFrame, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """Settled: ``doc_id``, ``source``, ``size``, ``text_hash`` and ``start``, the words of the
    source before the document."""
    light = settle(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            F.xxhash64("text").alias("text_hash"),
        ).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), F.lit(buckets)).cast("int"))
    )
    order = [F.col("doc_id"), F.col("text_hash"), F.col("size")]
    return numbered(light, ["source"], "bucket", order, F.col("size"), "start").select(
        "doc_id", "source", "size", "text_hash", "start"
    )


def mix(docs: DataFrame, block: int = BLOCK_WORDS, seed: int = SEED, **targets) -> DataFrame:
    """What the mix takes of each document.

    Returns ``doc_id``, ``source``, ``size``, ``text_hash``, ``source_size``, ``target``,
    ``taken`` and ``spans``: for each round of its source that takes words of it, the
    sorted (round, first word, words) in the document.
    """
    streams = settle(source_streams(docs, seed))
    goals = settle(source_targets(streams, **targets))
    # Settled, so that Spark knows its size: it grows with the words.
    slots = settle(source_slots(goals, block, seed=seed)).select(
        F.col("source").alias("__s"), F.col("block").alias("__b"), "round", "words"
    )
    last = F.expr(f"(start + greatest(size, 1) - 1) div {block}")
    pieces = streams.where("size > 0").select(
        "*", F.explode(F.sequence(F.expr(f"start div {block}"), last)).alias("block")
    )
    met = pieces.join(slots, F.col("source").eqNullSafe(F.col("__s")) & (F.col("block") == F.col("__b")))
    begin = F.greatest(F.col("start"), F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("words"))
    taken = (
        met.select("doc_id", "source", "text_hash", "start", "round", begin.alias("from"), (end - begin).alias("n"))
        .where("n > 0")
        .groupBy("doc_id", "source", "text_hash", "start")
        .agg(
            F.sum("n").alias("taken"),
            F.sort_array(
                F.collect_list(F.struct("round", (F.col("from") - F.col("start")).alias("first"), F.col("n").alias("words")))
            ).alias("spans"),
        )
    )
    keys = ["doc_id", "source", "text_hash", "start"]
    named = taken.select(*[F.col(k).alias(f"__{k}") for k in keys], "taken", "spans")
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    goal = goals.select(F.col("source").alias("__goal"), "source_size", "target")
    return (
        streams.join(named, same & (F.col("size") > 0), "left")
        .join(goal, F.col("source").eqNullSafe(F.col("__goal")))
        .select(
            *keys, "size", "source_size", "target",
            F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"), "spans",
        )
    )


def mixed_documents(docs: DataFrame, block: int = BLOCK_WORDS, seed: int = SEED, **targets) -> DataFrame:
    """The documents of the mix: one row per document and round that takes words of it.

    ``text`` keeps the words taken, each with the blanks before it; ``n_chars``, if there,
    is counted anew. Other columns stay. A document of which nothing is taken goes.
    """
    plan = mix(docs, block, seed, **targets).select(
        F.col("doc_id").alias("__doc"), F.col("source").alias("__src"), F.col("text_hash").alias("__hash"), "start",
        F.col("spans").alias("__spans"),
    )
    # Copies with one id and text share their plan's rows in order.
    name = lambda i, f, h: F.concat_ws("|", F.coalesce(i.cast("string"), F.lit("-")), h.cast("string"), F.coalesce(f, F.lit("-")))
    plan = plan.groupBy(name(F.col("__doc"), F.col("__src"), F.col("__hash")).alias("__key")).agg(
        F.array_sort(F.collect_list(F.struct("start", "__spans"))).alias("__plans")
    )
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row")).select(
        "row", name(F.col("row.doc_id"), F.col("row.source"), F.xxhash64("row.text")).alias("__name")
    )
    mine = W.partitionBy("__name").orderBy(F.lit(0))
    met = (
        whole.withColumn("__n", F.row_number().over(mine))
        .join(plan, F.col("__name") == F.col("__key"))
        .withColumn("__spans", F.get("__plans", F.col("__n") - 1)["__spans"])
        .where(F.col("__spans").isNotNull())
    )
    pieces = F.expr("regexp_extract_all(row.text, '([\\\\x20\\\\x09-\\\\x0D]*[^\\\\x20\\\\x09-\\\\x0D]+)', 1)")
    turns = F.array_distinct(F.transform("__spans", lambda s: s["round"]))
    whole_words = F.size("__pieces")
    of_turn = F.filter("__spans", lambda s: s["round"] == F.col("__turn"))
    cut = F.array_join(
        F.transform(
            of_turn,
            lambda s: F.array_join(F.slice("__pieces", (s["first"] + 1).cast("int"), s["words"].cast("int")), ""),
        ),
        "",
    )
    all_words = F.aggregate(of_turn, F.lit(0).cast("bigint"), lambda a, s: a + s["words"]) == whole_words
    text = F.when(all_words, F.col("row.text")).otherwise(cut)
    out = met.withColumn("__pieces", pieces).withColumn("__turn", F.explode(turns)).withColumn("__text", text)
    changed = {"text": F.col("__text"), "n_chars": F.length("__text").cast("bigint")}
    return out.select(
        *[
            (changed[n].cast(docs.schema[n].dataType) if n in changed else F.col("row").getField(n)).alias(n)
            for n in names
        ]
    )
