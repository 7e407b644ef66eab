"""Tokenising, word counts and top words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.text import WHITESPACE, java_split, java_trim


def tokens(
    lines: DataFrame,
    text: str = "value",
    *,
    trim: bool = True,
    drop_empty: bool = True,
    keep: list[str] = (),
) -> DataFrame:
    """One row per whitespace-separated token, in column `word`.

    Without `trim`, leading blanks give an empty token. Without `drop_empty`, a
    blank line gives one empty token.
    """
    source = F.col(text)
    if trim:
        parts = F.split(java_trim(source), r"\s+")
    else:
        parts = java_split(source, WHITESPACE, runs=True)
    words = lines.where(source.isNotNull()).select(*keep, F.explode(parts).alias("word"))
    return words.where(F.length("word") > 0) if drop_empty else words


def word_count(words: DataFrame, name: str = "cnt") -> DataFrame:
    """Rows per word."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias(name))


def top_words(counts: DataFrame, n: int = 3) -> DataFrame:
    """The n most frequent words as `(word, cnt)`; ties in word order."""
    return counts.select("word", "cnt").orderBy(F.desc("cnt"), F.asc("word")).limit(n)


def top_words_swapped(counts: DataFrame, n: int = 3) -> DataFrame:
    """The n most frequent words as `(cnt, word)`."""
    return counts.select("cnt", "word").orderBy(F.desc("cnt"), F.asc("word")).limit(n)
