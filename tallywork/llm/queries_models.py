"""Queries that train a model on the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import language, lm
from tallywork.llm.registry import query, table
from tallywork.llm.scratch import Scratch


def _in_fold(fold: int) -> Column:
    """Whether a document is in a fold; one without doc_id is in none, and models learn from it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == fold, F.lit(False))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the language that its text is predicted to have."""
    docs = table(spark, sf_dir, "documents")
    langs, matrix = language.train(docs.filter(~_in_fold(0)))
    return language.predict(spark, docs.select("doc_id", _in_fold(0).alias("held_out"), "text"), langs, matrix).drop("text")


@query("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the model that the documents outside fold 1 train."""
    docs = table(spark, sf_dir, "documents").select("doc_id", _in_fold(1).alias("held_out"), "text")
    model = lm.train(docs.filter(~F.col("held_out")), Scratch(spark))
    scored = lm.score(docs.select("doc_id", "held_out", F.col("text").alias("whole")), model, "whole")
    return scored.drop("whole", "perplexity")
