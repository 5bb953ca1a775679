"""Connected components by alternating large-star and small-star.

Large-star links the larger neighbours of each node to its least neighbour, small-star
the smaller ones; repeated in turn they leave a star around the least node of every
component. A step is a minimum per node (combined before the shuffle) and a join back,
so a node with very many neighbours is never gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import settle


_FILE_EDGES = 200_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("bigint"))).first())


def _pointed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node ``u`` to the smaller one ``v``."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) for the nodes of ``links`` (``a``, ``b``)."""
    edges = settle(_pointed(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    before = _state(edges)
    files = 1 + before[0] // _FILE_EDGES
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        large = _pointed(
            both.where("v > u").join(least, F.col("u") == F.col("w")).select(
                F.col("v").alias("u"), F.least("m", "w").alias("v")
            )
        )
        small_least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        met = large.join(small_least, F.col("u") == F.col("w"))
        edges = settle(
            _pointed(
                met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                    small_least.select(F.col("w").alias("u"), F.col("m").alias("v"))
                )
            ).coalesce(files)
        )
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
