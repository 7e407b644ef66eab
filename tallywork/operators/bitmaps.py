"""Exact distinct counts as bitmaps that can be merged.

A value is a number from zero on. Its bitmap is cut into buckets of 2^15 bits, of
which a group keeps those that it has values in. Bitmaps of finer groups, or of
the batches of a window, are merged bucket by bucket with `or`; the count is the
number of bits. Partial bitmaps are built before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLASSES = 256  # ranges in which values are numbered at the same time


def numbered(df: DataFrame, column: str, name: str, classes: int = CLASSES) -> DataFrame:
    """Every row with the number of its value, dense over all values; null for a null.

    Values are dealt to classes by hash and numbered in order within each. The
    class is the last digit of the number, so that classes fill the numbers
    together, and numbering again gives the same.
    """
    part = F.pmod(F.xxhash64("_value"), F.lit(classes))
    values = df.select(F.col(column).alias("_value")).where(F.col(column).isNotNull()).distinct().withColumn("_class", part)
    place = F.row_number().over(Window.partitionBy("_class").orderBy("_value")) - 1
    numbers = values.select("_value", (place.cast("bigint") * classes + F.col("_class")).alias(name))
    return df.join(numbers, F.col(column) == F.col("_value"), "left").drop("_value")


def parts(df: DataFrame, keys: list[str], number: str, *beside: Column) -> DataFrame:
    """One row per key and bucket: `_bucket`, its `_bits`, and other aggregates of its rows.

    A null number sets no bit, but its key is there.
    """
    place = F.col(number).cast("bigint") + 1
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    return df.groupBy(*keys, F.bitmap_bucket_number(place).alias("_bucket")).agg(bits, *beside)


def merged(rows: DataFrame, keys: list[str], *beside: Column) -> DataFrame:
    """The bitmaps of several parts in one."""
    return rows.groupBy(*keys, "_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"), *beside)


def counts(rows: DataFrame, keys: list[str], name: str, *beside: Column) -> DataFrame:
    """Distinct values per key, of merged bitmaps."""
    total = F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0).cast("bigint")).alias(name)
    return rows.groupBy(*keys).agg(total, *beside)
