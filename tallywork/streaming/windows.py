"""Sliding windows over a stream, by batches or by event time.

`batch_windows` adds up all batches of a window; `long_windows` keeps merged
pieces, so that a window costs the same however many batches it spans. Neither
takes anything away from a window, so any merge will do: sums, extremes, sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.operators.partitions import persisted
from tallywork.streaming.runner import BatchAction, BatchFunction, remove, stored_batches


def batch_windows(
    partials: str, output: str, count: BatchFunction, merge: BatchFunction, length: int = 2, slide: int = 1
) -> BatchAction:
    """Action that counts over the last `length` batches, every `slide` batches.

    Each batch is reduced once and its counts are kept under `partials`; a
    window adds up the counts of its batches. Raw rows are never read again, and
    only the window's own directories are read; older ones are removed. The
    first windows hold the batches there are. The counts stay in memory while
    they are stored and added up.
    """

    def action(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = max(0, batch_id - length + 1)
        with persisted(count(batch)) as counts:
            counts.write.mode("overwrite").parquet(f"{partials}/batch_id={batch_id}")
            if (batch_id + 1) % slide == 0:
                paths = [f"{partials}/batch_id={number}" for number in range(first, batch_id)]
                window = counts.unionByName(spark.read.schema(counts.schema).parquet(*paths)) if paths else counts
                merge(window).write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
        for number in stored_batches(spark, partials):
            if number < first:
                remove(spark, f"{partials}/batch_id={number}")

    return action


def pieces(first: int, last: int, block: int) -> list[tuple[str, int]]:
    """The stored pieces that make up the batches `first` to `last`.

    Blocks of `block` batches start at its multiples. `("prefix", n)` is batch n
    and those before it in its block; `("suffix", n)` is n and those after it.
    A range of at most two blocks and one batch takes three pieces at most.
    """
    found, at = [], first
    while at <= last:
        end = min(last, at - at % block + block - 1)
        if at % block and (end + 1) % block:
            raise ValueError(f"batches {at} to {end} are inside one block of {block}")
        found.append(("suffix", at) if at % block else ("prefix", end))
        at = end + 1
    return found


class _Pieces:
    """Stored prefixes and suffixes of blocks of batches."""

    def __init__(self, home: str, merge: BatchFunction, block: int) -> None:
        self.home, self.merge, self.block = home, merge, block

    def path(self, kind: str, number: int) -> str:
        return f"{self.home}/{kind}/batch_id={number}"

    def read(self, spark: SparkSession, schema: T.StructType, *parts: tuple[str, int]) -> DataFrame:
        return spark.read.schema(schema).parquet(*[self.path(*part) for part in parts])

    def store(self, spark: SparkSession, schema: T.StructType, kind: str, number: int, *parts: tuple[str, int]) -> None:
        """One piece from one or two others."""
        rows = self.read(spark, schema, *parts)
        rows = self.merge(rows).select(*schema.fieldNames()) if len(parts) > 1 else rows
        rows.write.mode("overwrite").parquet(self.path(kind, number))

    def add(self, counts: DataFrame, batch: int) -> T.StructType:
        """Store a batch, its prefix, and the next suffix of the block before; two merges at most."""
        spark, place = counts.sparkSession, batch % self.block
        counts.write.mode("overwrite").parquet(self.path("batch", batch))
        schema = spark.read.parquet(self.path("batch", batch)).schema
        self.store(spark, schema, "prefix", batch, *([("prefix", batch - 1)] if place else []), ("batch", batch))
        due = batch - 2 * place - 1  # from the end of the block before to its start, one for each batch
        if due >= 0:
            self.store(spark, schema, "suffix", due, ("batch", due), *([("suffix", due + 1)] if place else []))
        return schema

    def forget(self, spark: SparkSession, before: int) -> None:
        for kind in ("batch", "prefix", "suffix"):
            for number in stored_batches(spark, f"{self.home}/{kind}"):
                if number < before:
                    remove(spark, f"{self.home}/{kind}/batch_id={number}")


def long_windows(
    partials: str, output: str, count: BatchFunction, merge: BatchFunction, length: int, slide: int = 1,
    result: BatchFunction | None = None,
) -> BatchAction:
    """Action that reduces the last `length` batches, every `slide` batches, with three merges a batch at most.

    `count` reduces a batch, `merge` several reduced ones to one of the same
    columns, and `result` makes of the merged rows what is stored. Batches form
    blocks of half a window. A batch is merged into the prefix of its block, and
    one suffix of the block before is made, so that all are there when windows
    begin in that block. A window is a suffix, a whole block and a prefix.
    A repeated batch makes the same pieces again.
    """
    block = max(1, length // 2)
    stored = _Pieces(partials, merge, block)

    def action(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = stored.add(count(batch), batch_id)
        first = max(0, batch_id - length + 1)
        if (batch_id + 1) % slide == 0:
            parts = [("batch", batch_id)] if length == 1 else pieces(first, batch_id, block)
            rows = stored.read(spark, schema, *parts)
            rows = merge(rows) if len(parts) > 1 else rows
            (result(rows) if result else rows).write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
        stored.forget(spark, first - block)

    return action


def merge_counts(keys: list[str]) -> BatchFunction:
    """Add up counts of several batches."""

    def merge(window: DataFrame) -> DataFrame:
        return window.groupBy(*keys).agg(F.sum("cnt").alias("cnt"))

    return merge


def merge_counts_sql(key: str) -> BatchFunction:
    """`merge_counts` as SQL text."""

    def merge(window: DataFrame) -> DataFrame:
        text = f"SELECT {key}, sum(cnt) AS cnt FROM {{window_rows}} GROUP BY {key}"
        return window.sparkSession.sql(text, window_rows=window)

    return merge


def event_windows(
    df: DataFrame, time: str, length: str, slide: str, keys: list[str], measure: Column, lateness: str | None = None
) -> DataFrame:
    """Count or sum per sliding event-time window and key, as `window`, keys and `cnt`.

    Without a `lateness` every row counts and no window leaves the state; with
    one, `runner.late_rows` tells how many rows came after their window had gone.
    """
    return (df.withWatermark(time, lateness) if lateness else df).groupBy(F.window(time, length, slide), *keys).agg(measure.alias("cnt"))
