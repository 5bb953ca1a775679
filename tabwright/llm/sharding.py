"""Sharding by histogram sort: shards of near equal bytes, in order of a text's hash.

Equal texts have one key (a 64-bit hash) and stay in one shard. Groups of copies that
weigh a noticeable part of a shard are placed first, largest first, on the shard with the
least. The room left in each shard then says how many bytes of the remaining keys should
lie below each boundary, and the boundaries are found by counting: the exact bytes in
each of 4,096 ranges of keys, then in 4,096 parts of only those ranges that hold a
boundary, until the range around every boundary weighs less than the tolerance. Each
count is one aggregate whose partial sums are combined before the shuffle; the driver
gets at most 4,096 numbers per boundary. Rows then know their shard from their own key,
and one exchange brings them there.

Defined cases: a NULL text weighs 8 bytes and has CRC 0; NULL and empty texts are one
group;
repeated rows are rows of their own; an empty table gives an empty table. A group of
copies heavier than a shard's share makes its shard heavier: it is not cut.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import numbered, settle

SHARDS = 24
TOLERANCE = 0.001
_BITS = 12
_SALTS = 16
#: A group of copies is placed by itself from this part of a shard's share on.
_HEAVY = 1 / 32


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint")


@dataclass(frozen=True)
class Splitters:
    """``bounds``: the least key of shard 1, 2, ...; ``heavy``: shard of a key placed by itself."""

    shards: int
    bounds: tuple[int, ...]
    heavy: dict[int, int]

    def shard(self, key: Column) -> Column:
        bounds = F.array(*[F.lit(b).cast("bigint") for b in self.bounds])
        found = F.size(F.filter(bounds, lambda b: b <= key)) if self.bounds else F.lit(0)
        if self.heavy:
            pairs = [F.lit(x) for k, s in self.heavy.items() for x in (k, s)]
            found = F.coalesce(F.try_element_at(F.create_map(*pairs), key), found)
        return found.cast("int")


def _room(loads: list[int], rest: int) -> list[float]:
    """How much of ``rest`` each shard takes so that all end as level as can be."""
    order = sorted(loads)
    level = 0.0
    for i in range(1, len(order) + 1):
        level = (rest + sum(order[:i])) / i
        if i == len(order) or level <= order[i]:
            break
    return [max(0.0, level - x) for x in loads]


def find_splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> Splitters:
    """Boundaries for ``keys`` (``key`` bigint, ``size`` bigint), which is read several times."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return Splitters(shards, (), {})
    # At most shards / _HEAVY groups can weigh that much.
    heavy = (
        keys.groupBy("key").agg(F.sum("size").alias("size"))
        .where(F.col("size") >= total / shards * _HEAVY)
        .collect()
    )
    loads, placed = [0] * shards, {}
    for row in sorted(heavy, key=lambda r: (-r["size"], r["key"])):
        at = loads.index(min(loads))
        loads[at] += row["size"]
        placed[row["key"]] = at
    rest = keys.where(~F.col("key").isin(*placed)) if placed else keys
    wanted, below = [], 0.0
    for room in _room(loads, total - sum(loads))[:-1]:
        below += room
        wanted.append(below)
    allowed = total / shards * tolerance
    # A range of keys is all keys with the same leading bits; (its first key, its width in bits).
    bounds = [2**63 - 1] * len(wanted)
    open_ranges: dict[int, tuple[int, list[int]]] = {-(2**63): (0, list(range(len(wanted))))}
    bits = 64
    while open_ranges:
        width = max(0, bits - _BITS)
        inside = rest if bits == 64 else rest.where(F.shiftright("key", bits).isin([s >> bits for s in open_ranges]))
        cells = (
            inside.groupBy(F.shiftright("key", width).alias("cell"))
            .agg(F.sum("size").alias("size"))
            .collect()
        )
        found = sorted((r["cell"] << width, r["size"]) for r in cells)
        following: dict[int, tuple[int, list[int]]] = {}
        for start, (before, here) in open_ranges.items():
            low = bisect_left(found, (start, -1))
            high = bisect_left(found, (start + 2**bits, -1))
            for i in here:
                at = before
                for first, size in found[low:high]:
                    if at + size >= wanted[i]:
                        if size <= allowed or width == 0:
                            near = first if wanted[i] - at <= at + size - wanted[i] else first + 2**width
                            bounds[i] = min(near, 2**63 - 1)
                        else:
                            following.setdefault(first, (at, []))[1].append(i)
                        break
                    at += size
        open_ranges, bits = following, width
    return Splitters(shards, tuple(sorted(bounds)), placed)


def assign_shards(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row of ``docs``."""
    light = settle(
        docs.select(
            "doc_id",
            text_size(F.col("text")).alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
            text_key(F.col("text")).alias("key"),
        )
    )
    split = find_splitters(light, shards, tolerance)
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS))
    placed = light.withColumns(
        {
            "shard": split.shard(F.col("key")),
            # Key order, with the copies of one text over several buckets.
            "bucket": F.shiftright("key", 64 - _BITS) * _SALTS + salt,
        }
    )
    order = [F.col("key"), F.col("doc_id"), F.col("size")]
    return numbered(placed, ["shard"], "bucket", order, F.lit(1).cast("bigint"), "slot").drop("bucket", "key")


def exchange(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``shard`` added, each shard in one partition and in order of keys."""
    keys = settle(docs.select(text_key(F.col("text")).alias("key"), text_size(F.col("text")).alias("size")))
    split = find_splitters(keys, shards, tolerance)
    return (
        docs.withColumn("shard", split.shard(text_key(F.col("text"))))
        .repartition(shards, "shard")
        .sortWithinPartitions("shard", text_key(F.col("text")))
    )
