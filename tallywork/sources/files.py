"""File readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.operators.records import RATING_SCHEMA


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in column `value`; `.gz` and the like are decoded by extension."""
    return spark.read.text(path)


def read_delimited(
    spark: SparkSession, path: str, *, sep: str, schema: T.StructType | None = None
) -> DataFrame:
    """Delimited file: with a schema no header is expected, without one header and types are read.

    Finding types costs a second pass over the data, so give a schema if known.
    """
    if schema is not None:
        return spark.read.schema(schema).csv(path, sep=sep, header=False)
    return spark.read.csv(path, sep=sep, header=True, inferSchema=True)


def read_ratings(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Ratings file without header."""
    return read_delimited(spark, path, sep=sep, schema=RATING_SCHEMA)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines; a missing field is null. Without a schema the data is read twice."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet by name."""
    return spark.read.parquet(path)


def read_default(spark: SparkSession, path: str) -> DataFrame:
    """The session's default format, Parquet unless set otherwise."""
    return spark.read.load(path)


def local_range(spark: SparkSession, first: int, last: int, partitions: int) -> DataFrame:
    """The integers first..last in column `id`."""
    return spark.range(first, last + 1, 1, partitions)


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the program as a typed frame."""
    return spark.createDataFrame(rows, schema)


def write_pairs(df: DataFrame, path: str) -> None:
    """Two-column rows as `(a,b)` text lines; the directory must be new."""
    left, right = df.columns
    line = F.concat(
        F.lit("("), F.col(left).cast("string"), F.lit(","), F.col(right).cast("string"), F.lit(")")
    )
    df.select(line.alias("value")).write.text(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """`(a,b)` lines back as text columns; the last comma separates."""
    body = F.substring(F.col("value"), F.lit(2), F.length("value") - 2)
    return spark.read.text(path).select(
        F.regexp_extract(body, r"(?s)\A(.*),[^,]*\z", 1).alias("left"),
        F.substring_index(body, ",", -1).alias("right"),
    )


def key_value_lines(lines: DataFrame, separator: str = "\x01") -> DataFrame:
    """`key<separator>value` lines, by default with the byte 0x01 between."""
    parts = F.split("value", rf"\Q{separator}\E", 2)
    return lines.select(parts.getItem(0).cast("int").alias("key"), parts.getItem(1).alias("value"))
