"""Queries that stay in DataFrame functions, next to their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import decontam, licenses, quality, urls
from tallywork.llm.registry import query, table

QUALITY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), m AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), win AS (
  SELECT rid, unnest(list_transform(range(1, len(words) - 3),
    lambda i: {'pos': i, 'key': array_to_string(words[i:i + 4], ' ')})) AS w
  FROM m WHERE len(words) >= 5
), twice AS (
  SELECT rid, w['pos'] AS pos FROM (SELECT rid, w, count(*) OVER (PARTITION BY rid, w['key']) AS n FROM win)
  WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT pos + k) AS n FROM twice, range(5) AS r(k) GROUP BY rid
), f AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM m LEFT JOIN covered USING (rid)
), b AS (
  SELECT *,
    CAST(n_words < 10 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 20 * n_words AS BIGINT)
    + 4 * CAST(10 * n_symbols > n_words AS BIGINT) + 8 * CAST(2 * n_dup_lines > n_lines AS BIGINT)
    + 16 * CAST(word_chars < 2 * n_words AS BIGINT) + 32 * CAST(word_chars > 20 * n_words AS BIGINT) AS failed
  FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed,
  (failed & 3) <> 0 AS base_failed, failed = 0 AS kept
FROM b
"""


@query("op10_quality_rules", QUALITY_SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its measurements, failure bits and the verdict of the policy `prose-1`."""
    marked = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed",
        (~quality.passes("base-1")).alias("base_failed"),
        quality.passes("prose-1").alias("kept"),
    )


def _same_sql(text: str) -> str:
    for other, one in licenses.SAME:
        text = f"replace({text}, '{other}', '{one}')"
    return text


def _joined_sql(text: str) -> str:
    return f"trim(regexp_replace({text}, '[ \\n]+', ' ', 'g'))"


def _lines_sql(text: str) -> str:
    bare = f"regexp_replace(lower(coalesce({text}, '')), '{licenses.COPYRIGHT}', '', 'g')"
    return _same_sql(f"regexp_replace({bare}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')")


_KNOWN_ROWS = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.NOTICES)

LICENSE_SQL = f"""
WITH known(license, text) AS (VALUES {_KNOWN_ROWS}), k AS (
  SELECT DISTINCT license, {_same_sql(_joined_sql(_lines_sql("text")))} AS unit FROM known
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_lines_sql("text")} AS text FROM documents
), u AS (
  SELECT rid, true AS whole, text AS unit FROM d
  UNION ALL SELECT rid, false, unnest(string_split(text, chr(10))) FROM d
  UNION ALL SELECT rid, false, unnest(regexp_split_to_array(text, '\\n *\\n')) FROM d
), c AS (
  SELECT rid, whole, {_same_sql(_joined_sql("unit"))} AS unit FROM u
), f AS (
  SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
    string_agg(DISTINCT license, ',' ORDER BY license) FILTER (WHERE whole) AS whole_license
  FROM c JOIN k USING (unit) GROUP BY rid
)
SELECT doc_id, whole_license, coalesce(licenses, '') AS licenses FROM d LEFT JOIN f USING (rid)
"""


@query("op1_license_scans", LICENSE_SQL)
def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licences whose texts it holds as a whole, a paragraph or a line."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.notices(spark))


_PLAIN_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    f"'{decontam.WORD}')"
)

DECONTAM_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_PLAIN_SQL} AS words FROM documents
), i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_PLAIN_SQL} AS words FROM benchmark
), k AS (
  SELECT DISTINCT item, least(len(words), 10) AS size,
    unnest(list_transform(range(1, greatest(len(words) - 9, 1) + 1),
      lambda n: array_to_string(words[n:n + 9], ' '))) AS key
  FROM i WHERE len(words) > 0
), sizes AS (
  SELECT DISTINCT size FROM k
), win AS (
  SELECT rid, size, unnest(list_transform(range(1, len(words) - size + 2),
    lambda n: {{'pos': n, 'key': array_to_string(words[n:n + size - 1], ' ')}})) AS w
  FROM d, sizes WHERE len(words) >= size
), hit AS (
  SELECT rid, w['pos'] AS pos, win.size AS size, item FROM win JOIN k ON win.size = k.size AND w['key'] = k.key
), n AS (
  SELECT rid, count(DISTINCT pos + r.step) AS n_hit FROM hit, range(10) AS r(step) WHERE r.step < size GROUP BY rid
), ids AS (
  SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hit GROUP BY rid
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN ids USING (rid)
"""


@query("op5_benchmark_decontamination", DECONTAM_SQL)
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words, hit words and the benchmark items found in it."""
    found = decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op6_url_filters")
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its host, path, rule and verdict."""
    model = urls.train(urls.labelled(spark))
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), model).drop("url")
