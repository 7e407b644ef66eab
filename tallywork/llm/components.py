"""Connected components of a table of links, by alternating large and small stars.

Each round is two joins on a minimum per node; hubs are never gathered into a
list, though the links of one hub stream through one task. Rounds are saved in
the shared folder; the loop ends when a round changes no link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """`a` is the greater end of every link here."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.sum(F.xxhash64("b", "a", "a").cast("decimal(20,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """`links` has two long columns. Returns `node` and `least`, the least node it reaches, for all linked nodes."""
    left, right = (F.col(name) for name in links.columns)
    edges = links.filter(left != right).select(
        F.greatest(left, right).alias("a"), F.least(left, right).alias("b")
    ).distinct()
    edges = scratch.save(edges)
    before = _mark(edges)
    while before[0]:
        after_edges = scratch.save(_small_star(_large_star(edges)))
        after = _mark(after_edges)
        scratch.drop(edges)
        edges = after_edges
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("least")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("least")).union(roots)
