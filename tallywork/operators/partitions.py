"""Work per partition, rows per partition, and explicit reuse."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import count

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def map_partitions(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Python code over each partition, one Arrow batch at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(run, schema)


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per partition of `df` as it stands; empty partitions do not show."""
    numbered = df.select(F.spark_partition_id().alias("partition_id"))
    return numbered.groupBy("partition_id").agg(F.count(F.lit(1)).alias("cnt"))


def in_partitions(df: DataFrame, number: Column, partitions: int) -> DataFrame:
    """Deal rows to the partition that a column of theirs numbers from zero; a null or a number outside fails the job."""
    named = F.coalesce(number.cast("string"), F.lit("null"))
    fails = F.raise_error(F.concat(F.lit("no such partition: "), named)).cast("int")
    right = F.when((number >= 0) & (number < partitions), number.cast("int")).otherwise(fails)
    return df.repartitionById(partitions, right)


class Counted:
    """Counts that a write makes in passing, with no job of their own.

    `rows` counts what is written, `rejected` the records that `bad` is true for,
    which are left out. With a number of partitions, `per_partition` has the rows
    of each, empty ones included. Read them after the write. A task that is run
    again counts once.
    """

    _names = count()

    def __init__(self, df: DataFrame, bad: Column | None = None, partitions: int = 0) -> None:
        self._partitions = partitions
        self._seen, self._kept = (Observation(f"counted-{next(self._names)}") for _ in range(2))
        wrong = F.lit(False) if bad is None else F.coalesce(bad, F.lit(False))
        marked = df.withColumn("_wrong", wrong).observe(self._seen, F.count_if("_wrong").alias("rejected"))
        good = marked.filter(~F.col("_wrong")).drop("_wrong").withColumn("_part", F.spark_partition_id())
        each = [F.count_if(F.col("_part") == n).alias(f"part_{n}") for n in range(partitions)]
        self.frame = good.observe(self._kept, F.count(F.lit(1)).alias("rows"), *each).drop("_part")

    def write(self, path: str, mode: str = "errorifexists") -> Counted:
        self.frame.write.mode(mode).parquet(path)
        return self

    @property
    def rows(self) -> int:
        return self._kept.get["rows"]

    @property
    def rejected(self) -> int:
        return self._seen.get["rejected"]

    @property
    def per_partition(self) -> list[int]:
        return [self._kept.get[f"part_{n}"] for n in range(self._partitions)]


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a frame while several actions use it, then release it."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
