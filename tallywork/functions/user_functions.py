"""User-defined functions and aggregates.

The native forms are what queries should use: Catalyst inlines them. The Arrow
forms show the same function as user Python code for logic that SQL cannot say.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions.text import BLANKS, java_trim


def to_lower(text: Column) -> Column:
    """Trim, then lower case."""
    return F.lower(java_trim(text))


def register_to_lower(spark: SparkSession, name: str = "to_lower") -> None:
    """Make `to_lower` callable from SQL text, as a SQL function that Catalyst inlines."""
    codes = ", ".join(f"char({ord(char)})" for char in BLANKS)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS STRING "
        f"RETURN lower(trim(BOTH concat({codes}) FROM text))"
    )


@F.pandas_udf(T.StringType())
def to_lower_arrow(text: pd.Series) -> pd.Series:
    """`to_lower` as vectorised Python over Arrow batches."""
    return text.str.strip(BLANKS).str.lower()


def average(value: Column) -> Column:
    """Average of a long column as a double: sum and count buffers, NaN on no input.

    Null input is skipped. Division is guarded, as ANSI mode would fail on 0/0.
    """
    total = F.sum(value.cast("bigint")).cast("double")
    count = F.count(value)
    return F.when(count == 0, F.lit(float("nan"))).otherwise(total / count)


def partial_sums(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Reduce every Arrow batch to one row per key: `_sum` and `_count` of a long column.

    Null values are skipped. The buffers still have to be merged per key.
    """
    fields = [df.schema[key] for key in keys]
    buffers = T.StructType(
        [*fields, T.StructField("_sum", T.LongType()), T.StructField("_count", T.LongType())]
    )

    def reduce_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table.filter(pc.is_valid(table[value]))
            if not table.num_rows:
                continue
            sums = table.group_by(keys, use_threads=False).aggregate([(value, "sum"), (value, "count")])
            ordered = sums.select([*keys, f"{value}_sum", f"{value}_count"])
            yield from ordered.rename_columns(buffers.fieldNames()).combine_chunks().to_batches()

    return df.select(*keys, F.col(value).cast("bigint").alias(value)).mapInArrow(reduce_batches, buffers)


def average_arrow(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """`average` with the update step in Python and the merge in Spark.

    The buffers of `partial_sums` are all that is shuffled, so no task ever
    holds a whole group; a grouped-aggregate UDF would.
    """
    count = F.sum("_count")
    merged = F.when(F.coalesce(count, F.lit(0)) == 0, F.lit(float("nan"))).otherwise(
        F.sum("_sum").cast("double") / count
    )
    return partial_sums(df, keys, value).groupBy(*keys).agg(merged.alias(name))
