"""Fields out of JSON text and log-record bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_fields(df: DataFrame, column: str, fields: list[str], keep: list[str] = ()) -> DataFrame:
    """Top-level JSON fields as text columns; a missing field or broken JSON is null.

    A field is named literally, dots and all. All are taken from one pass over the text.
    """
    return df.select(*keep, F.json_tuple(column, *fields).alias(*fields))


def utf8(raw: Column) -> Column:
    """Bytes to text."""
    return raw.cast("string")


def utf8_bytes(text: Column) -> Column:
    """Text to bytes."""
    return F.encode(text, "UTF-8")


def decode_records(records: DataFrame) -> DataFrame:
    """Log records with `key` and `value` bytes turned into text."""
    return records.withColumns({"key": utf8(F.col("key")), "value": utf8(F.col("value"))})


def record_view(records: DataFrame) -> DataFrame:
    """One line per log record: `topic-partition:offset = value`, with `null` for no value."""
    line = F.concat(
        F.col("topic"), F.lit("-"), F.col("partition").cast("string"),
        F.lit(":"), F.col("offset").cast("string"), F.lit(" = "),
        F.coalesce(utf8(F.col("value")), F.lit("null")),
    )
    return records.select(line.alias("line"))
