"""Document fingerprints: the k smallest hashes of a text's shingles.

A fingerprint (a sorted array of 64-bit hashes, at most ``K``) is a uniform sample of the
distinct shingles. Two of them, or one per part of a long text, are merged by taking the
smallest k of both. From it come the number of distinct shingles, the resemblance of two
texts (Jaccard) and the containment of one in another. Below k shingles all are exact.

A shingle is five words, lower-cased; a text with fewer words is one shingle; a text
without words or NULL has none and an empty fingerprint. Two empty fingerprints are equal
(resemblance 1), an empty and another share nothing (0). Everything is built-in functions
on one row; no text meets another to be fingerprinted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tabwright.llm.common import settle, words_of

K = 128
SHINGLE = 5
_LONGS = "array<bigint>"
#: About how many bytes of text one bucket of neighbours should hold.
_BUCKET_BYTES = 8 << 20
_MOST_BUCKETS = 10_000


def shingle_hashes(words: str, n: int = SHINGLE) -> Column:
    """Hashes of the shingles of a column of words (its name), repeats included."""
    size = F.size(words)
    runs = F.transform(
        F.slice(words, F.lit(1), F.greatest(size - (n - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, n)]),
    )
    return (
        F.when(size == 0, F.array().cast(_LONGS))
        .when(size < n, F.array(F.xxhash64(F.array_join(words, " "))))
        .otherwise(runs)
    )


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(left: Column, right: Column, k: int = K) -> Column:
    """Fingerprint of two parts together."""
    return F.slice(F.sort_array(F.array_union(left, right)), 1, k)


def resemblance(left: Column, right: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the two sets of shingles."""
    both = merged(left, right, k)
    shared = F.size(F.array_intersect(F.array_intersect(left, right), both))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def containment(left: Column, right: Column, k: int = K) -> Column:
    """Estimated part of the left set's shingles that the right set has; NULL if it has none."""
    both = merged(left, right, k)
    of_left = F.size(F.array_intersect(left, both))
    shared = F.size(F.array_intersect(F.array_intersect(left, right), both))
    return F.when(of_left > 0, shared / of_left)


def distinct_shingles(fingerprint: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    n = F.size(fingerprint)
    largest = F.get(fingerprint, F.lit(k - 1)).cast("double") + F.lit(2.0**63)
    return F.when(n < k, n.cast("double")).otherwise((k - 1) * F.lit(2.0**64) / largest)


def as_text(fingerprint: Column) -> Column:
    """16 hex digits per hash."""
    return F.array_join(F.transform(fingerprint, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """Add the fingerprint of a column of text."""
    return (
        df.withColumn("__words", words_of(F.lower(text)))
        .withColumn("__hashes", shingle_hashes("__words"))
        .withColumn(name, bottom(F.col("__hashes"), k))
        .drop("__words", "__hashes")
    )


def with_next(docs: DataFrame, carried: list[str], prepare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Add ``next_<c>`` for the carried columns: those of the next document, descending id.

    After the last comes the first. Documents are put into ranges of ids of about equal
    count; each range is ordered by itself, and the last of a range meets the first of
    the next range in a table with one row per range. Rows with one id are ordered by the
    carried columns, which ``prepare`` may add row by row; NULL is the smallest id.
    """
    rows, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    ranges = max(1, min(_MOST_BUCKETS, (size or 0) // _BUCKET_BYTES))
    cuts = []
    if ranges > 1:
        parts = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
        cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", parts, 100 * ranges)).first()[0] or []))
    found = (
        F.size(F.filter(F.array(*[F.lit(x).cast("bigint") for x in cuts]), lambda x: x < F.col("doc_id")))
        if cuts
        else F.lit(0)
    )
    ranged = docs.withColumn("__range", F.coalesce(F.when(F.col("doc_id").isNotNull(), found), F.lit(-1)))
    order = [F.col("doc_id").desc_nulls_last(), *[F.col(c) for c in carried]]
    payload = F.struct(*carried)
    inside = W.partitionBy("__range").orderBy(*order)
    # The first row of a range: the greatest id, then the smallest values.
    top = settle(
        ranged.groupBy(F.col("__range").alias("__r")).agg(F.max("doc_id").alias("__top"))
    )
    at_top = (F.col("__range") == F.col("__r")) & F.col("doc_id").eqNullSafe(F.col("__top"))
    firsts = settle(
        prepare(ranged.join(top, at_top)).groupBy("__range").agg(F.min(payload).alias("__first"))
    )
    around = W.orderBy(F.col("__range").desc())
    entries = firsts.select(
        F.col("__range").alias("__r"),
        F.coalesce(F.lead("__first").over(around), F.max_by("__first", "__range").over(W.partitionBy())).alias("__entry"),
    )
    return (
        prepare(ranged)
        .withColumn("__next", F.lead(payload).over(inside))
        .join(settle(entries), F.col("__range") == F.col("__r"))
        .withColumn("__next", F.coalesce("__next", "__entry"))
        .select("*", *[F.col("__next").getField(c).alias(f"next_{c}") for c in carried])
        .drop("__range", "__r", "__next", "__entry")
    )


def compare_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of each text and of an edit of it, and how near they are judged to be.

    The edit: the last third of the code points is replaced by as many (or all) of the
    first code points of the next document. Returns ``doc_id``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next``.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    met = with_next(texts, ["text", "sketch"], lambda df: with_fingerprint(df, "text", "sketch", k))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    out = with_fingerprint(met.withColumn("edited", edited), "edited", "edited_sketch", k)
    return out.select(
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )
