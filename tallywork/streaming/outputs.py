"""What a stream writes: keyed tables and offset logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions.clock import batch_time
from tallywork.operators.upsert import latest_per_key
from tallywork.sources.jdbc import upsert_table
from tallywork.streaming.runner import BatchAction, BatchFunction, remove, stored_batches


def keyed_table_action(path: str, keys: list[str], every: int = 20) -> BatchAction:
    """Action that upserts the rows of an `update`-mode stream by their key.

    A batch writes its changed rows under its number. Every `every` batches the
    table as it stands becomes a new base, and what the base before it had made
    superfluous is removed; that base and the changes since stay, so that a
    repeated batch finds what it needs. A reader meets one base and fewer than
    `every` changes.
    """

    def action(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
        if (batch_id + 1) % every:
            return
        bases = [number for number in stored_batches(spark, f"{path}/base") if number < batch_id]
        table = _newest(spark, path, keys, bases, batch_id)
        table.write.mode("overwrite").parquet(f"{path}/base/batch_id={batch_id}")
        if bases:
            for number in bases[:-1]:
                remove(spark, f"{path}/base/batch_id={number}")
            for number in stored_batches(spark, f"{path}/changes"):
                if number <= bases[-1]:
                    remove(spark, f"{path}/changes/batch_id={number}")

    return action


def _newest(spark: SparkSession, path: str, keys: list[str], bases: list[int], last: int | None = None) -> DataFrame:
    """The newest row per key of the last base and the changes after it."""
    base = bases[-1] if bases else -1
    stored = stored_batches(spark, f"{path}/changes")
    numbers = [number for number in stored if number > base and (last is None or number <= last)]
    parts = [f"{path}/base/batch_id={base}"] if bases else []
    parts += [f"{path}/changes/batch_id={number}" for number in numbers]
    rows = spark.read.option("basePath", f"{path}/changes").parquet(*parts) if not bases else _with_base(spark, path, base, parts)
    return latest_per_key(rows, keys, "batch_id").drop("batch_id")


def _with_base(spark: SparkSession, path: str, base: int, parts: list[str]) -> DataFrame:
    rows = spark.read.parquet(parts[0]).withColumn("batch_id", F.lit(base))
    if len(parts) == 1:
        return rows
    changes = spark.read.option("basePath", f"{path}/changes").parquet(*parts[1:])
    return rows.unionByName(changes)


def keyed_table(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The keyed table as it stands: per key the row of the newest batch."""
    return _newest(spark, path, keys, stored_batches(spark, f"{path}/base"))


def jdbc_upsert_action(
    url: str, table: str, staging: str, keys: list[str], properties: dict[str, str], dialect: str = "standard"
) -> BatchAction:
    """Action that upserts each batch into a JDBC table, by the statement of the database's `dialect`.

    A batch of an aggregating stream holds one row per key, and merging it again
    changes nothing, so a repeated batch is harmless.
    """

    chosen = {} if dialect == "standard" else {"dialect": dialect}

    def action(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch, url, table, staging, keys, properties, **chosen)

    return action


def stamped(function: BatchFunction, instant: str) -> BatchFunction:
    """A batch function whose rows also carry the time of their batch, in `batch_time`.

    The time is the latest `instant` of the batch's rows, so that a repeated
    batch gets the same one.
    """

    def with_time(batch: DataFrame) -> DataFrame:
        return function(batch).withColumn("batch_time", batch_time(batch.select(F.max(instant)).scalar()))

    return with_time


def offsets_action(output: BatchAction, offsets: str) -> BatchAction:
    """Action that stores the result first and the batch's offset ranges after it.

    If the job dies between the two, the batch runs again: results are written
    at least once, and offsets never run ahead of them.
    """

    def action(batch: DataFrame, batch_id: int) -> None:
        output(batch, batch_id)
        offset_ranges(batch).write.mode("overwrite").parquet(f"{offsets}/batch_id={batch_id}")

    return action


def offset_ranges(records: DataFrame) -> DataFrame:
    """First offset and the one after the last, per topic partition."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )
