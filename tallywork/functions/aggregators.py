"""User aggregates with buffers of their own.

An aggregate is a class with four steps: an empty buffer, an update with the
values of one key in one Arrow batch, a merge of two buffers, and the result.
A buffer is a tuple of Spark values, so that it may be numbers, text, binary or
arrays, and travels as columns.

Updates run where the rows lie: what is shuffled is one buffer per key and batch.
The buffers of a key are merged in a tree: in each round a task merges a share of
them, one at a time in memory, and the next round gets fewer. So no task sees all
rows of a hot key, nor all its buffers.
"""

from __future__ import annotations

import heapq
from abc import ABC, abstractmethod
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN = 64  # buffers of a key that one task merges in the last round
ROUNDS = 2


class Aggregator(ABC):
    """An aggregate of one column.

    `buffer` names the buffer's fields and `result` the result's type, as Spark
    types in text. Merging must not depend on the order of the buffers.
    """

    buffer: str
    result: str

    @abstractmethod
    def initialise(self) -> tuple:
        """The buffer of no values."""

    @abstractmethod
    def update(self, buffer: tuple, values: pa.Array) -> tuple:
        """The buffer with more values, which may be null."""

    @abstractmethod
    def merge(self, one: tuple, other: tuple) -> tuple:
        """The buffer of both."""

    @abstractmethod
    def evaluate(self, buffer: tuple) -> Any:
        """The result."""


def _fields(ddl: str) -> list[T.StructField]:
    return [T.StructField(f"_{field.name}", field.dataType) for field in T._parse_datatype_string(ddl).fields]


def _tables(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def partial_buffers(df: DataFrame, keys: list[str], value: str, aggregator: Aggregator) -> DataFrame:
    """One buffer per key and Arrow batch, and in `_lane` the number of its partition.

    A task that runs again sends its rows to the same lanes, whatever their order.
    """
    buffer = _fields(aggregator.buffer)
    schema = T.StructType([*(df.schema[key] for key in keys), *buffer])
    arrow = _arrow(schema)

    def updated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if not keys:
                yield _tables(arrow, [aggregator.update(aggregator.initialise(), table[value].combine_chunks())])
                continue
            groups = table.group_by(keys, use_threads=False).aggregate([(value, "list")])
            lists = groups[f"{value}_list"].combine_chunks()
            buffers = [aggregator.update(aggregator.initialise(), each.values) for each in lists]
            columns = [groups[key].combine_chunks() for key in keys]
            made = list(zip(*buffers))
            columns += [pa.array(values, field.type) for values, field in zip(made, list(arrow)[len(keys):])]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    found = df.select(*keys, value).mapInArrow(updated, schema)
    return found.withColumn("_lane", F.spark_partition_id().cast("bigint"))


def _merged(rows: DataFrame, by: list[str], kept: list[str], aggregator: Aggregator, last: T.StructField | None) -> DataFrame:
    """One buffer per group of `by`, or with `last` its result."""
    buffer = _fields(aggregator.buffer)
    names = [field.name for field in buffer]
    own = [rows.schema[name] for name in kept]
    schema = T.StructType([*own, *([last] if last else buffer)])
    arrow = _arrow(schema)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in names]
            for each in zip(*columns):
                held = each if held is None else aggregator.merge(held, each)
            if key is None:
                key = [batch.column(name).slice(0, 1) for name in kept]
        end = _tables(pa.schema(list(arrow)[len(kept):]), [(aggregator.evaluate(held),) if last else held])
        yield pa.RecordBatch.from_arrays([*key, *end.columns], schema=arrow)

    return rows.groupBy(*by).applyInArrow(merged, schema)


def aggregate(
    df: DataFrame, keys: list[str], value: str, aggregator: Aggregator, name: str, fan: int = FAN, rounds: int = ROUNDS
) -> DataFrame:
    """The aggregate of `value` per key, as `name`; without keys one row.

    A task of the last round merges `fan` buffers of a key at most; in the first
    round a task merges those of one in fan^(rounds - 1) input partitions. Keys
    are grouped as Spark groups them, a null key is a key. Without keys, no rows
    give the result of the empty buffer.
    """
    rows = partial_buffers(df, keys, value, aggregator)
    for left in range(rounds - 1, 0, -1):
        rows = rows.withColumn("_lane", F.pmod(F.col("_lane"), F.lit(fan**left)))
        rows = _merged(rows, [*keys, "_lane"], [*keys, "_lane"], aggregator, None)
    result = T.StructField(name, T._parse_datatype_string(aggregator.result))
    found = _merged(rows, keys, keys, aggregator, result)
    if keys:
        return found
    empty = df.sparkSession.createDataFrame([(0, aggregator.evaluate(aggregator.initialise()))], T.StructType([T.StructField("_n", T.IntegerType()), result]))
    both = empty.unionByName(found.withColumn("_n", F.lit(1)))
    return both.agg(F.max_by(name, "_n").alias(name))


class Average(Aggregator):
    """The mean of a numeric column as a double; NaN of no values. Buffers: sum and count."""

    buffer, result = "total double, cnt long", "double"

    def initialise(self) -> tuple:
        return 0.0, 0

    def update(self, buffer: tuple, values: pa.Array) -> tuple:
        return buffer[0] + float(pc.sum(values).as_py() or 0), buffer[1] + len(values) - values.null_count

    def merge(self, one: tuple, other: tuple) -> tuple:
        return one[0] + other[0], one[1] + other[1]

    def evaluate(self, buffer: tuple) -> float:
        return buffer[0] / buffer[1] if buffer[1] else float("nan")


class LongAverage(Average):
    """`Average` of a long column with an exact sum, however large: its buffer is a number in text."""

    buffer = "total string, cnt long"

    def initialise(self) -> tuple:
        return "0", 0

    def update(self, buffer: tuple, values: pa.Array) -> tuple:
        total = int(pc.sum(pc.cast(values, pa.decimal128(38, 0))).as_py() or 0)
        return str(int(buffer[0]) + total), buffer[1] + len(values) - values.null_count

    def merge(self, one: tuple, other: tuple) -> tuple:
        return str(int(one[0]) + int(other[0])), one[1] + other[1]

    def evaluate(self, buffer: tuple) -> float:
        return int(buffer[0]) / buffer[1] if buffer[1] else float("nan")


class Product(Aggregator):
    """The product of a long column modulo `modulus`; 1 of no values, null values are skipped."""

    buffer, result = "product long", "long"

    def __init__(self, modulus: int) -> None:
        self.modulus = modulus

    def initialise(self) -> tuple:
        return (1 % self.modulus,)

    def update(self, buffer: tuple, values: pa.Array) -> tuple:
        product = buffer[0]
        for value in pc.drop_null(values).to_pylist():
            product = product * value % self.modulus
        return (product,)

    def merge(self, one: tuple, other: tuple) -> tuple:
        return (one[0] * other[0] % self.modulus,)

    def evaluate(self, buffer: tuple) -> int:
        return buffer[0]


class TopValues(Aggregator):
    """The `n` greatest values of a long column, greatest first. The buffer is the list so far."""

    buffer, result = "greatest array<long>", "array<long>"

    def __init__(self, n: int) -> None:
        self.n = n

    def initialise(self) -> tuple:
        return ([],)

    def update(self, buffer: tuple, values: pa.Array) -> tuple:
        values = pc.drop_null(values)
        best = values.take(pc.select_k_unstable(values, self.n, [("", "descending")])) if len(values) > self.n else values
        return (heapq.nlargest(self.n, [*buffer[0], *best.to_pylist()]),)

    def merge(self, one: tuple, other: tuple) -> tuple:
        return (heapq.nlargest(self.n, [*one[0], *other[0]]),)

    def evaluate(self, buffer: tuple) -> list[int]:
        return list(buffer[0])
