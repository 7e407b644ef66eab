"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Write a table and register it; `path` keeps the files outside the warehouse."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> None:
    """A table whose rows lie in buckets by key, sorted within each.

    Two tables with equal keys and number of buckets are joined or grouped by
    their keys without a shuffle. Rows are dealt before the write, so that a
    bucket is one file.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Take a table out of the catalog; files that were given a path of their own stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name."""
    return spark.table(name)


def query_table(spark: SparkSession, sql: str) -> DataFrame:
    """A catalog table by SQL text."""
    return spark.sql(sql)
