"""One query per operator, over whole tables, with SQL for the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import conversation_repair, fingerprints, hard_negatives, language_id, language_model, license_scan, mixing, near_duplicates, packing, quality_rules, secret_scan, sharding, suffix_dedup
from tabwright.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every text without strings of 400 bytes met elsewhere."""
    return suffix_dedup.removal_report(documents(spark, folder))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of texts that share at least 85 % of their three-word shingles."""
    return near_duplicates.near_duplicates(documents(spark, folder), n=3, percent=85)


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
    ELSE list_distinct([[w[i], w[i + 1], w[i + 2]] FOR i IN range(1, len(w) - 1)]) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON doc_id = a
"""


def op3_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram and recurrent model scores of all documents."""
    return language_model.score(documents(spark, folder))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licences that lines, paragraphs or the whole of every text are near to."""
    return license_scan.scan_licenses(documents(spark, folder))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as token pieces, packed into sequences of 2,048."""
    return packing.pack(documents(spark, folder))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, distances from the language's histograms and the verdict for each document."""
    return quality_rules.judge_counts(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def _op6_sql() -> str:
    """The rules, histograms and distances of ``quality_rules`` for DuckDB."""
    rest = ["coalesce(text, '')"]
    for pattern in quality_rules.CLASSES:
        pattern = pattern.replace("'", "''")
        rest.append(f"regexp_replace({rest[-1]}, '{pattern}', '', 'g')")
    sizes = [f"length({r})" for r in rest]
    classes = ", ".join([f"{a} - {b}" for a, b in zip(sizes, sizes[1:], strict=False)] + [sizes[-1]])
    lists = " ".join(
        f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words)}]" for lang, words in quality_rules.COMMON_WORDS.items()
    )
    blank = "[^\\x20\\x09-\\x0D]"
    return f"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{blank}+') AS w,
    [{classes}] AS classes, CASE lang {lists} END AS listed
  FROM documents
), h AS (
  SELECT *, [list_position(listed, lower(x)) FOR x IN w] AS places FROM d
), c AS (
  SELECT *, [len(list_filter(places, lambda p: p = i)) FOR i IN range(1, 13)]
    || [len(list_filter(places, lambda p: coalesce(p, 0) = 0))] AS common
  FROM h
), cells AS (
  SELECT doc_id, lang, listed IS NOT NULL AS has_list, 0 AS kind, unnest(range(8)) AS i, unnest(classes) AS n FROM c
  UNION ALL
  SELECT doc_id, lang, listed IS NOT NULL, 1, unnest(range(13)), unnest(common) FROM c
), parts AS (
  SELECT *, coalesce(floor(n * least(total, CASE kind WHEN 0 THEN {quality_rules.MOST_CHARACTERS} ELSE {quality_rules.MOST_WORDS} END)
    * {quality_rules.PARTS} / nullif(total, 0)), 0)::BIGINT AS m
  FROM (SELECT *, (sum(n) OVER (PARTITION BY doc_id, kind))::BIGINT AS total FROM cells)
), refs AS (
  SELECT lang, kind, i, sum(m) AS n FROM parts WHERE lang IS NOT NULL GROUP BY ALL
), known AS (
  SELECT lang FROM refs WHERE kind = 0 GROUP BY lang HAVING sum(n) > 0
), everything AS (
  SELECT kind, i, sum(m) AS n FROM parts WHERE kind = 0 GROUP BY ALL
), used AS (
  SELECT r.* FROM refs r JOIN known USING (lang)
  UNION ALL
  SELECT '', kind, i, n FROM everything
), shares AS (
  SELECT c.doc_id, c.kind, c.n / nullif(sum(c.n) OVER (PARTITION BY c.doc_id, c.kind), 0) AS p,
    r.n / nullif(sum(r.n) OVER (PARTITION BY c.doc_id, c.kind), 0) AS q
  FROM cells c LEFT JOIN known k ON c.lang = k.lang
  JOIN used r ON coalesce(k.lang, '') = r.lang AND c.kind = r.kind AND c.i = r.i
), distances AS (
  SELECT doc_id, kind, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 0)) AS far
  FROM shares WHERE p IS NOT NULL GROUP BY doc_id, kind
), without AS (
  SELECT lang, sqrt(sum((CASE WHEN i = 12 THEN log2(2 / (1 + q)) + CASE WHEN q > 0 THEN q * log2(2 * q / (1 + q)) ELSE 0 END
    ELSE q END) / 2)) AS none
  FROM (SELECT lang, i, n / nullif(sum(n) OVER (PARTITION BY lang), 0) AS q FROM refs WHERE kind = 1) GROUP BY lang
), windows AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS pos FROM d
), again AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, w[pos], w[pos + 1], w[pos + 2]) AS times FROM windows
), repeats AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n FROM again, (SELECT unnest(range(3)) AS k) WHERE times > 1 GROUP BY doc_id
), counts AS (
  SELECT c.doc_id, len(w)::BIGINT AS n_words, (length(t) - classes[3])::BIGINT AS word_chars,
    classes[6]::BIGINT AS n_symbols,
    (len([x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '{blank}')])
      - len(list_distinct([x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '{blank}')])))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words, length(t) AS size, listed IS NOT NULL AS has_list, lang
  FROM c LEFT JOIN repeats r ON c.doc_id = r.doc_id
), judged AS (
  SELECT *, n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words AS base_failed
  FROM counts
)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
    AND coalesce(size < {quality_rules.CHARACTER_GUARD} OR a.far <= {quality_rules.CHARACTER_DISTANCE}, true)
    AND coalesce(NOT has_list OR b.far <= {quality_rules.WORD_SHARE} * none + {quality_rules.WORD_NOISE} / sqrt(n_words), true) AS kept
FROM judged j LEFT JOIN without w ON j.lang = w.lang
LEFT JOIN distances a ON j.doc_id = a.doc_id AND a.kind = 0
LEFT JOIN distances b ON j.doc_id = b.doc_id AND b.kind = 1
"""


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What a mix of all sources takes of each document."""
    return mixing.mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and of its edit, and their likeness."""
    return fingerprints.compare_edits(documents(spark, folder))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text, learned from four fifths of them."""
    return language_id.identify(documents(spark, folder))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard and place of every document, by bytes."""
    return sharding.assign_shards(documents(spark, folder)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """For one vector in a hundred, the rows of other labels just below each of its best five of its own."""
    label = F.col("label").cast("bigint")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(spark.read.parquet(f"{folder}/embeddings.parquet"), shifted, F.col("vec_id") % 100 == 0)


def op12_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets by form and by entropy in every text, as counts, a digest and spans."""
    return secret_scan.secret_report(documents(spark, folder))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Cheapest edits of damaged conversations to alternating turns, and what they give."""
    conversations = spark.read.parquet(f"{folder}/conversations.parquet")
    return conversation_repair.repair_report(conversations, conversation_repair.damage(conversations))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_suffix_dedup, op2_near_duplicates, op3_language_model, op4_license_scan, op5_packing, op6_quality_rules, op7_mixing, op8_fingerprints, op9_language_id, op10_sharding, op11_hard_negatives, op12_secret_scan, op13_conversation_repair)}
SQL: dict[str, str] = {"op2_near_duplicates": OP2_SQL, "op6_quality_rules": _op6_sql()}
