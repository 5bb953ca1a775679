"""Preparation of a training corpus: judge, deduplicate, trim, mix, pack.

Each stage takes (spark, docs, folder of the tables) and returns a table that is written
and read again before the next one. All but the last return the columns of ``documents``.
NULL and empty texts fail the quality rules and so end there; repeated rows with one id
become one document in the second stage; an empty table goes through all stages and
gives no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabwright.llm import mixing, near_duplicates, packing, quality_rules, suffix_dedup
from tabwright.llm.common import documents, settle

#: Passages of 50 words have 250 bytes and more in the languages at hand; chance and stock
#: phrases stay well below 200.
REPEATED = 200


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the plain rules and are near their language's histograms."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return near_duplicates.without_near_duplicates(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of ``REPEATED`` bytes that are met elsewhere."""
    return suffix_dedup.without_repeats(docs, REPEATED)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents a mix of the sources takes, once for each time it does."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2,048."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_dedup),
    ("suffix-array dedup", suffix_dedup_stage),
    ("mixing", mix),
    ("packing", pack),
]
#: Several stages are no SQL; the whole is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
