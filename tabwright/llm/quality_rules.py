"""Quality rules: how far a document's histograms are from those of its language.

Two histograms per document, one over classes of characters and one over the commonest
words of its language, are compared with those of all documents of that language. In these
references a document weighs by its length up to a bound, so that a few very long ones do
not set them.
The measure is the Jensen-Shannon distance (square root of the divergence to base 2, 0 to
1). Short documents have noisy histograms. The character distance says nothing below a
least length; the limit of the word distance is a share of the distance that a text without
any common word has in that language, plus what chance adds in so few words. All of it is
made of built-in functions row by row; the only shuffle carries one row per language and
task. ``judge_counts`` reads each text once: what it needs of it is written as a few numbers.

Defined cases: NULL and blank texts have no words and fail the plain rule; documents
without a language, or with one that no document with words has, are compared with the
characters of all documents and not by words; languages without a list of words are
compared by characters only; repeated rows are judged like others; an empty table gives an
empty table. Three-word windows of a text are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import settle, words_of

#: The commonest words of each language, most common first.
COMMON_WORDS: dict[str, list[str]] = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "on", "as"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist", "ein", "nicht"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "est", "que", "pour"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "del", "un", "por", "con", "para"],
}
#: Character classes, counted one after the other on what the ones before left over.
CLASSES = ["[a-z]+", "[A-Z]+", "[\\x20\\x09-\\x0D]+", "[0-9]+", "[.,;:!?'\"()-]+", "[#*$%&|<>]+", "\\p{L}+"]
LEAST_WORDS = 50
MOST_REPEATED = 50
CHARACTER_GUARD = 200
CHARACTER_DISTANCE = 0.35
#: The limit of word distances: a share of the distance of a text with none of the
#: language's common words, and what chance adds over the root of the words.
WORD_SHARE = 0.4
WORD_NOISE = 1.25
#: In the references a document weighs by its length, but not beyond these.
MOST_CHARACTERS, MOST_WORDS = 6000, 1000
#: Weighted counts are whole thousandths, so that sums are exact in any order.
PARTS = 1000


def _class_counts(df: DataFrame) -> DataFrame:
    """Add ``__classes``: characters per class, and those of no class at the end."""
    out = df.withColumn("__rest0", F.coalesce(F.col("__text"), F.lit("")))
    for i, pattern in enumerate(CLASSES):
        out = out.withColumn(f"__rest{i + 1}", F.regexp_replace(f"__rest{i}", pattern, ""))
    sizes = [F.length(f"__rest{i}") for i in range(len(CLASSES) + 1)]
    counts = [a - b for a, b in zip(sizes, sizes[1:], strict=False)] + [sizes[-1]]
    return out.withColumn("__classes", F.array(*[x.cast("bigint") for x in counts])).drop(
        *[f"__rest{i}" for i in range(len(CLASSES) + 1)]
    )


def _word_counts(df: DataFrame, common: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add ``__common``: words equal to each listed one of the language, then all others."""
    most = max(map(len, common.values()), default=0)
    lists = F.lit(None).cast("array<string>")
    for lang, listed in common.items():
        lists = F.when(F.col("__lang") == lang, F.array(*map(F.lit, listed))).otherwise(lists)
    found = F.filter(
        F.transform("__words", lambda w: F.array_position("__list", F.lower(w))), lambda i: i > 0
    )
    out = df.withColumn("__list", lists).withColumn(
        "__found", F.when(F.col("__list").isNull(), F.array().cast("array<bigint>")).otherwise(found)
    )
    # A second parameter of the function would be given the place in the array.
    equals = lambda k: lambda i: i == k
    each = [F.size(F.filter("__found", equals(k))).cast("bigint") for k in range(1, most + 1)]
    other = (F.size("__words") - F.size("__found")).cast("bigint")
    return out.withColumn("__common", F.array(*each, other)).drop("__found")


def jensen_shannon(left: Column, right: Column) -> Column:
    """Distance of two arrays of counts (0 to 1); NULL if one of them sums to 0."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    terms = F.zip_with(
        F.transform(left, lambda x: x / F.nullif(total(left), F.lit(0.0))),
        F.transform(right, lambda x: x / F.nullif(total(right), F.lit(0.0))),
        lambda p, q: (part(p, (p + q) / 2) + part(q, (p + q) / 2)) / 2,
    )
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def _none_common(counts: str) -> Column:
    """The word counts of a text with none of the listed words."""
    return F.transform(counts, lambda x, i: F.when(i == F.size(counts) - 1, 1).otherwise(0).cast("bigint"))


def _repeated_words(windows: str) -> Column:
    """Words inside windows found twice or more, from the array of a text's windows."""
    placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.array().cast("array<struct<w:bigint,i:int>>")).otherwise(placed)


def base_counts(df: DataFrame) -> DataFrame:
    """The plain counts of each text; expects ``__text``, ``__words`` and ``__classes``."""
    n = F.size("__words")
    lines = F.filter(F.split(F.coalesce("__text", F.lit("")), "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    windows = F.when(
        n < 3, F.array().cast("array<bigint>")
    ).otherwise(
        F.transform(
            F.slice("__words", F.lit(1), n - 2),
            lambda w, i: F.xxhash64(w, F.get("__words", i + 1), F.get("__words", i + 2)),
        )
    )
    out = (
        df.withColumn("__lines", lines)
        .withColumn("__windows", windows)
        .withColumn("__placed", _repeated_words("__windows"))
    )
    m = F.size("__placed")
    twice = F.zip_with(
        F.slice("__placed", F.lit(1), F.greatest(m - 1, F.lit(0))),
        F.slice("__placed", F.lit(2), F.greatest(m - 1, F.lit(0))),
        lambda a, b: F.when(a["w"] == b["w"], F.array(*[x["i"] + k for x in (a, b) for k in range(3)])).otherwise(
            F.array().cast("array<int>")
        ),
    )
    return out.withColumns(
        {
            "n_words": n.cast("bigint"),
            "word_chars": F.length(F.coalesce("__text", F.lit(""))).cast("bigint") - F.get("__classes", F.lit(2)),
            "n_symbols": F.get("__classes", F.lit(5)),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "n_repeat_words": F.size(F.array_distinct(F.flatten(twice))).cast("bigint"),
        }
    ).drop("__lines", "__windows", "__placed")


def _histograms(docs: DataFrame, common: Mapping[str, Sequence[str]]) -> DataFrame:
    df = docs.withColumns({"__text": F.col("text"), "__lang": F.col("lang")})
    return _word_counts(_class_counts(df.withColumn("__words", words_of(F.col("__text")))), common)


def _weighted(counts: str, most: int) -> Column:
    """The counts in thousandths, as if the document had ``most`` of them if it has more."""
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, x: s + x)
    share = F.least(total, F.lit(most).cast("bigint")) * PARTS
    return F.transform(counts, lambda x: F.floor(F.coalesce(x * share / F.nullif(total, F.lit(0)), F.lit(0.0))))


def references_of(histograms: DataFrame) -> DataFrame:
    """One row per language, and one with NULL for all: both histograms, summed by weight.

    ``histograms`` has ``__lang``, ``__classes`` and ``__common``.
    """
    cells = F.posexplode(F.concat(_weighted("__classes", MOST_CHARACTERS), _weighted("__common", MOST_WORDS))).alias("__at", "__n")
    sums = settle(
        histograms.select("__lang", cells).groupBy("__lang", "__at").agg(F.sum("__n").alias("__n"))
    )
    n = len(CLASSES) + 1
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("__at", "__n"))), lambda x: x["__n"])
    whole = sums.groupBy("__at").agg(F.sum("__n").alias("__n")).agg(in_order.alias("__all"))
    return settle(
        sums.where(F.col("__lang").isNotNull())
        .groupBy(F.col("__lang").alias("reference"))
        .agg(in_order.alias("__all"))
        .unionByName(whole.select(F.lit(None).cast("string").alias("reference"), "__all"))
        .select(
            "reference",
            F.slice("__all", 1, n).alias("classes"),
            F.expr(f"slice(__all, {n + 1}, greatest(size(__all) - {n}, 0))").alias("common"),
        )
        .where(F.aggregate("classes", F.lit(0).cast("bigint"), lambda s, x: s + x) > 0)
    )


def language_references(docs: DataFrame, common: Mapping[str, Sequence[str]] = COMMON_WORDS) -> DataFrame:
    """``references_of`` the texts of ``docs``."""
    return references_of(_histograms(docs.select("text", "lang"), common))


def _judged(
    counted: DataFrame, references: DataFrame, character_guard: int, character_distance: float, word_share: float, word_noise: float
) -> DataFrame:
    """Distances and verdict for rows with their counts."""
    # Few languages have few rows: the known ones are met by name, the rest by NULL.
    known = references.where(F.col("reference").isNotNull()).select(
        F.col("reference").alias("__reference"), F.col("classes").alias("__ref_classes"), F.col("common").alias("__ref_common"),
        jensen_shannon(_none_common("common"), F.col("common")).alias("__without"),
    )
    whole = references.where(F.col("reference").isNull()).select(F.col("classes").alias("__all_classes")).first()
    everything = (
        F.array(*[F.lit(x).cast("bigint") for x in whole[0]]) if whole else F.lit(None).cast("array<bigint>")
    )
    judged = counted.join(known, F.col("__lang") == F.col("__reference"), "left").withColumns(
        {
            "character_distance": F.when(
                F.col("__size") >= character_guard,
                jensen_shannon(F.col("__classes"), F.coalesce("__ref_classes", everything)),
            ),
            "word_distance": F.when(F.col("__listed"), jensen_shannon(F.col("__common"), F.col("__ref_common"))),
            # A filter on this is pushed below columns that are all determined by the row,
            # and would there repeat the chain that makes them; the number keeps it above.
            "base_failed": (
                (F.col("n_words") < LEAST_WORDS)
                | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
            )
            & (F.monotonically_increasing_id() >= 0),
        }
    )
    word_limit = word_share * F.col("__without") + word_noise / F.sqrt(F.nullif(F.col("n_words"), F.lit(0)))
    near = F.coalesce(F.col("character_distance") <= character_distance, F.lit(True)) & F.coalesce(
        F.col("word_distance") <= word_limit, F.lit(True)
    )
    return judged.withColumn("kept", ~F.col("base_failed") & near).drop(
        *[c for c in judged.columns if c.startswith("__")]
    )


def _counted(docs: DataFrame, common: Mapping[str, Sequence[str]]) -> DataFrame:
    """``docs`` with all counts of each text."""
    return base_counts(_histograms(docs, common)).withColumns(
        {"__size": F.length(F.coalesce("__text", F.lit(""))), "__listed": F.col("__list").isNotNull() & (F.col("n_words") > 0)}
    )


def judge(
    docs: DataFrame,
    common: Mapping[str, Sequence[str]] = COMMON_WORDS,
    character_guard: int = CHARACTER_GUARD,
    character_distance: float = CHARACTER_DISTANCE,
    word_share: float = WORD_SHARE,
    word_noise: float = WORD_NOISE,
) -> DataFrame:
    """Every row of ``docs`` (``text``, ``lang``) with counts, distances and ``kept``.

    ``character_guard`` is the least number of characters from which the distance of that
    kind counts. The limit of the word distance is ``word_share`` of the distance that a
    text without any common word has in that language, plus ``word_noise`` over the root of
    the number of words. A document is kept if the plain rule (``base_failed``) holds
    nothing against it and neither distance is above its limit. The texts are read twice,
    as they are returned; ``judge_counts`` reads them once.
    """
    references = language_references(docs, common)
    return _judged(_counted(docs, common), references, character_guard, character_distance, word_share, word_noise)


def judge_counts(
    docs: DataFrame,
    common: Mapping[str, Sequence[str]] = COMMON_WORDS,
    character_guard: int = CHARACTER_GUARD,
    character_distance: float = CHARACTER_DISTANCE,
    word_share: float = WORD_SHARE,
    word_noise: float = WORD_NOISE,
) -> DataFrame:
    """What ``judge`` gives, without the texts: their counts are written once and used twice."""
    counted = _counted(docs, common)
    light = settle(counted.drop("text", "__text", "__words", "__list"))
    return _judged(light, references_of(light), character_guard, character_distance, word_share, word_noise)


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows that ``judge`` keeps, with the columns they had."""
    names = docs.columns
    plain = docs.select("text", "lang", F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"))
    # A filter is pushed below columns that are all determined by the row, and would there
    # repeat the whole chain that makes ``kept``. The running number keeps it above.
    judged = judge(plain, **limits).select("row", "kept", F.monotonically_increasing_id().alias("once"))
    return judged.where("kept and once >= 0").select(*[F.col("row").getField(n).alias(n) for n in names])
