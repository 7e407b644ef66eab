"""Queries that find duplicates, write token files and pack."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import packing, simhash, substrings, tokens
from tallywork.llm.registry import query, table
from tallywork.llm.scratch import Scratch, shared_folder


@query("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the least doc_id of its group."""
    found = simhash.groups(table(spark, sf_dir, "documents"), Scratch(spark))
    return found.select("doc_id", simhash.hex_digits(F.col("print")).alias("fingerprint"), "component_id")


@query("op7_token_output")
def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written to token files and read back: place, number and checksum of its ids."""
    path = shared_folder(spark)
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    read = tokens.read_tokens(spark, path).select(
        "part", "shard", "place", "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
    )
    return tokens.starts(Scratch(spark).save(read)).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence; equal texts and equal sources are kept apart."""
    return packing.pack(packing.lengths(table(spark, sf_dir, "documents")), Scratch(spark))


SUBSTRING_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
  SELECT rid, doc_id, unnest(list_transform(range(1, len(words) - 48),
    lambda n: {'pos': n, 'key': array_to_string(words[n:n + 49], ' ')})) AS w
  FROM d WHERE len(words) >= 50
), later AS (
  SELECT rid, w['pos'] AS pos, doc_id > min(doc_id) OVER (PARTITION BY w['key']) AS again FROM win
), hit AS (
  SELECT DISTINCT rid, pos + r.step AS pos FROM later, range(50) AS r(step) WHERE again
), per_doc AS (
  SELECT rid, list(pos) AS gone FROM hit GROUP BY rid
), kept AS (
  SELECT doc_id, words, CASE WHEN gone IS NULL THEN words
    ELSE list_transform(list_sort(list_filter(range(1, len(words) + 1), lambda n: NOT list_contains(gone, n))),
      lambda n: words[n]) END AS rest
  FROM d LEFT JOIN per_doc USING (rid)
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - len(rest) AS BIGINT) AS n_removed,
  sha256(array_to_string(rest, ' ')) AS kept_sha256
FROM kept
"""


@query("op8_substring_dedup", SUBSTRING_SQL)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words, those taken out, and a digest of the rest."""
    found = substrings.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256")
    )
