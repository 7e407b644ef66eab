"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`; a local session without the setting gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='tallywork-')}"
    return f"{root.rstrip('/')}/tallywork-{uuid.uuid4().hex}"


class Scratch:
    """Tables of one job. Each is written once, so that lost executors cost no recomputation.

    Results are read from these tables: call `close` when they are not needed any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, shared_folder(spark)
        self.paths: dict[int, str] = {}
        self.count = 0

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(saved)] = path
        return saved

    def drop(self, saved: DataFrame) -> None:
        """Delete a saved table that nothing will read again."""
        self._delete(self.paths[id(saved)])

    def close(self) -> None:
        self._delete(self.folder)

    def _delete(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
