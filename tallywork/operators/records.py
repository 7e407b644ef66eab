"""Delimited text records to typed rows.

Input is a frame with the line in column `value`; further columns named in
`keep` are carried along. In strict mode a record that passes the arity guard
but cannot be read fails the job; otherwise it is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions.text import (
    WHITESPACE,
    computed_once,
    has_fields,
    java_trim,
    record_fields,
    typed,
)

RATING_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("movieId", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)


def valid_records(lines: DataFrame, delimiters: str, at_least: int) -> DataFrame:
    """Lines that are not null and have enough fields."""
    fields = record_fields(F.col("value"), delimiters)
    return lines.where(F.col("value").isNotNull() & (F.size(fields) >= at_least))


def _split(
    lines: DataFrame, fields: Column, keep: list[str], at_least: int, exactly: int | None, strict: bool
) -> DataFrame:
    """Rows with enough fields in `f`; the split itself runs once per line."""
    present = lines.where(F.col("value").isNotNull()).select(*keep, "value")
    rows = computed_once(present, "f", fields)
    size = F.size("f")
    if exactly is None:
        return rows.where(size >= at_least)
    if not strict:
        return rows.where(size == exactly)
    complaint = F.raise_error(F.concat(F.lit(f"expected {exactly} fields: "), F.col("value")))
    # A filter, because a check inside a column is skipped when nobody reads the column.
    return rows.where(
        F.when(size == exactly, True).when(size < at_least, False).otherwise(complaint.cast("boolean"))
    )


def _typed_rows(rows: DataFrame, keep: list[str], columns: list[tuple], strict: bool) -> DataFrame:
    """Select (name, position, type) triples; drop unreadable rows unless strict."""
    picked = []
    for name, position, type_name in columns:
        text = F.col("f").getItem(position)
        picked.append((text if type_name == "string" else typed(text, type_name, strict)).alias(name))
    out = rows.select(*keep, *picked)
    if strict:
        return out
    return out.dropna(subset=[name for name, _, type_name in columns if type_name != "string"])


def access_log(lines: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Web access lines: `ip`, `url` and `referrer`, positions 0, 6 and 10 of 11 or more."""
    rows = _split(lines, record_fields(F.col("value"), WHITESPACE), keep, 11, None, True)
    return _typed_rows(
        rows, keep, [("ip", 0, "string"), ("url", 6, "string"), ("referrer", 10, "string")], True
    )


def parse_orders(
    lines: DataFrame,
    *,
    province: str = "int",
    price: str = "double",
    strict: bool = True,
    keep: list[str] = (),
) -> DataFrame:
    """`orderId,provinceId,orderPrice`; shorter lines are skipped, longer ones are errors."""
    rows = _split(lines, record_fields(F.col("value"), ","), keep, 3, 3, strict)
    columns = [("order_id", 0, "string"), ("province_id", 1, province), ("order_price", 2, price)]
    return _typed_rows(rows, keep, columns, strict)


def parse_key_numbers(lines: DataFrame, *, number: str = "int", strict: bool = True) -> DataFrame:
    """`key number` lines, one blank between."""
    rows = _split(lines, record_fields(F.col("value"), WHITESPACE), [], 2, 2, strict)
    return _typed_rows(rows, [], [("key", 0, "string"), ("number", 1, number)], strict)


def parse_ratings(lines: DataFrame, *, strict: bool = True) -> DataFrame:
    """`userId::movieId::rating::timestamp`; only lines with exactly four fields count."""
    present = lines.where(F.col("value").isNotNull())
    parts = computed_once(present, "_parts", F.split(java_trim(F.col("value")), "::"))
    rows = parts.where(has_fields(F.col("_parts"), 4)).select(F.col("_parts").alias("f"))
    columns = [
        ("userId", 0, "int"), ("movieId", 1, "int"), ("rating", 2, "double"), ("timestamp", 3, "bigint"),
    ]
    return _typed_rows(rows, [], columns, strict)


def parse_ip_ranges(lines: DataFrame, *, strict: bool = True) -> DataFrame:
    """Pipe records of exactly 15 fields: start, end, and the last two as coordinates."""
    rows = _split(lines, record_fields(F.col("value"), "|"), [], 15, 15, False)
    columns = [
        ("start_ip", 2, "bigint"), ("end_ip", 3, "bigint"),
        ("longitude", 14, "string"), ("latitude", 13, "string"),
    ]
    return _typed_rows(rows, [], columns, strict)


def parse_ip_logs(lines: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Pipe records of two or more fields: the address is the second."""
    rows = _split(lines, record_fields(F.col("value"), "|"), keep, 2, None, True)
    return _typed_rows(rows, keep, [("ip", 1, "string")], True)
