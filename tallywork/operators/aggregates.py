"""Whole-set and keyed aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_sum(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Sum per key, combined before the shuffle."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def keyed_count(df: DataFrame, keys: list[str], name: str = "cnt") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_sum(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """Sum of an expression per key."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def whole_set(df: DataFrame, value: str) -> DataFrame:
    """Reduce, count and extremes of one column, in one row."""
    column = F.col(value)
    return df.agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum(column).alias("total"),
        F.min(column).alias("lowest"),
        F.max(column).alias("highest"),
    )


def fold_with_zero(df: DataFrame, value: str, zero: int, partitions: int) -> DataFrame:
    """`fold(zero)(+)` over a set in `partitions` parts.

    The zero enters once per part and once in the final merge, so it is not
    neutral; the number of parts is stated by the caller, as a result must not
    depend on how Spark happens to split the input.
    """
    total = F.coalesce(F.sum(value), F.lit(0)) + F.lit(zero * (partitions + 1))
    return df.agg(total.alias("folded"))


def global_top(df: DataFrame, value: str, n: int = 2) -> DataFrame:
    """The n greatest values of a column, as one descending list.

    `orderBy.limit` keeps n rows per partition, so only those reach one task.
    """
    best = df.select(value).where(F.col(value).isNotNull()).orderBy(F.desc(value)).limit(n)
    return best.agg(F.sort_array(F.collect_list(value), asc=False).alias("top_values"))


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """Any n rows, in no order."""
    return df.limit(n)
