"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes what the one before kept, written as Parquet and read again.
Stages keep the columns of `documents`; the last returns one row per packed
piece. Nulls, empty texts, repeated rows and empty tables are handled as the
operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import decontam, near, packing, quality, substrings
from tallywork.llm.scratch import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the policy `prose-1`."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints within two bits, or similarities of 0.8 and more, connect.

    Both are of shingles of five words.
    """
    return near.one_of_each(docs, Scratch(spark))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document holds are taken out.

    A document that loses nothing keeps its text as it is. One that loses all
    its words goes.
    """
    found = substrings.deduplicated(docs, Scratch(spark))
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.col("kept")).otherwise(F.col("text"))
    size = F.when(cut, F.char_length("kept").cast("long")).otherwise(F.col("n_chars"))
    found = found.filter(~cut | (F.col("n_removed") < F.col("n_words")))
    return found.withColumn("n_chars", size).withColumn("text", text).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a word window of a benchmark item."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with the sequence that each is packed in."""
    return packing.pack(packing.lengths(docs), Scratch(spark))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]
#: SQL has no XXH64 and no packing; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each but the last written and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
