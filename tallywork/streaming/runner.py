"""Run streaming queries to the end of their input, with repeatable outputs.

Results go to one directory per batch, `batch_id=<n>`, which a repeated batch
overwrites. A batch that Spark runs again after a failure therefore leaves one
copy of its rows, and a stream that is restarted on its checkpoint goes on
where it stopped.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

BatchFunction = Callable[[DataFrame], DataFrame]
BatchAction = Callable[[DataFrame, int], None]
SHARED_DIR = "spark.checkpoint.dir"


def workspace(spark: SparkSession, name: str) -> str:
    """A new directory path for one run, below the shared folder the cluster names.

    A local session without that setting gets a temporary folder; on a cluster
    a machine-local folder would be invisible to the executors, so it is refused.
    """
    shared = spark.sparkContext.getConf().get(SHARED_DIR) or spark.conf.get(SHARED_DIR, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SHARED_DIR} to a folder that all executors share")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tallywork-")


def start(
    stream: DataFrame, action: BatchAction, checkpoint: str, mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Start a query and return it; it runs until it is stopped.

    `trigger` holds the arguments of Spark's trigger, such as
    `{"processingTime": "2 seconds"}` or `{"availableNow": True}`. Spark keeps
    the session's number of shuffle partitions in the checkpoint: set it for the
    state you expect before the first start.
    """
    writer = stream.writeStream.outputMode(mode).foreachBatch(action).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def run_available(stream: DataFrame, action: BatchAction, checkpoint: str, mode: str = "append") -> None:
    """Process everything that is there and stop; errors of any batch are raised."""
    start(stream, action, checkpoint, mode, {"availableNow": True}).awaitTermination()


def run_until_idle(
    stream: DataFrame, action: BatchAction, checkpoint: str, mode: str = "append", trigger: dict | None = None
) -> None:
    """Run until the source has nothing new."""
    query = start(stream, action, checkpoint, mode, trigger)
    try:
        query.processAllAvailable()
    finally:
        query.stop()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block; what was there before comes back."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a watermark has kept out of the state, in the batches that the query still remembers."""
    operators = (one for progress in query.recentProgress for one in progress["stateOperators"])
    return sum(one["numRowsDroppedByWatermark"] for one in operators)


def to_batch_dirs(path: str, function: BatchFunction | None = None) -> BatchAction:
    """Action that applies a batch function and stores its rows under the batch's directory."""

    def action(batch: DataFrame, batch_id: int) -> None:
        rows = batch if function is None else function(batch)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return action


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All stored batches with their number in `batch_id`.

    With a schema, a stream that has not stored anything yet gives no rows;
    without one its missing folder is an error.
    """
    if schema is None:
        rows = spark.read.parquet(path)
    else:
        stored = T.StructType([*schema.fields, T.StructField("batch_id", T.IntegerType())])
        rows = spark.read.schema(stored).parquet(path) if _exists(spark, path) else spark.createDataFrame([], stored)
    return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def _folder(spark: SparkSession, path: str):
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path


def _exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _folder(spark, path)
    return files.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of stored rows that nothing reads any more."""
    files, hadoop_path = _folder(spark, path)
    files.delete(hadoop_path, True)


def files_below(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with their bytes, which are 0 for folders; none if it is not there."""
    files, hadoop_path = _folder(spark, path)
    if not files.exists(hadoop_path):
        return {}
    return {status.getPath().getName(): status.getLen() for status in files.listStatus(hadoop_path)}


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that readers see whole or not at all; one of the same name is replaced."""
    files, target = _folder(spark, path)
    _, made = _folder(spark, f"{path}.tmp")
    stream = files.create(made, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    files.delete(target, False)
    if not files.rename(made, target):
        raise OSError(f"cannot rename to {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    files, hadoop_path = _folder(spark, path)
    stream = files.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def stored_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose folders are complete, in order; no rows are read."""
    files, hadoop_path = _folder(spark, path)
    if not files.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(hadoop_path)]
    numbers = sorted(int(name.split("=")[1]) for name in names if name.startswith("batch_id="))
    return [number for number in numbers if _exists(spark, f"{path}/batch_id={number}/_SUCCESS")]


def latest_batch(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the last stored batch, which may be none; other folders are not opened."""
    return spark.read.parquet(f"{path}/batch_id={stored_batches(spark, path)[-1]}")


class Arrivals:
    """An input directory that is filled slice by slice, with a run after each.

    This is how scheduled jobs see a stream: files arrive, the query runs on
    its checkpoint, takes what is new as one batch, and stops. Batch n is slice
    n, so results per batch are repeatable.
    """

    def __init__(self, spark: SparkSession, name: str, schema: T.StructType) -> None:
        self.spark = spark
        self.schema = schema
        self.home = workspace(spark, name)
        self.input = f"{self.home}/input"
        self.checkpoint = f"{self.home}/checkpoint"
        self.output = f"{self.home}/output"

    def deliver(self, rows: DataFrame) -> None:
        """Add one slice; readers see its files only when all are written."""
        rows.select(*self.schema.fieldNames()).write.mode("append").parquet(self.input)

    def stream(self) -> DataFrame:
        """The directory as a stream."""
        return self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.input)

    def run_slices(
        self,
        rows: DataFrame,
        slice_column: str,
        slices: int,
        query: Callable[[DataFrame], DataFrame],
        action: BatchAction,
        mode: str = "append",
    ) -> None:
        """Let slices 0 .. slices-1 of `rows` arrive in turn and run the query after each.

        `rows` is computed and written once; a slice arrives when its folder is
        renamed. Rows without a slice number come with the first one, and a
        number outside the range fails.
        """
        number = F.coalesce(F.col(slice_column).cast("int"), F.lit(0))
        wrong = F.raise_error(F.concat(F.lit("no such slice: "), number.cast("string"))).cast("int")
        checked = F.when((number >= 0) & (number < slices), number).otherwise(wrong)
        staged = f"{self.home}/staged"
        columns = self.schema.fieldNames()
        rows.withColumn("_slice", checked).select(*columns, "_slice").write.partitionBy("_slice").parquet(staged)
        for number in range(slices):
            files, source = _folder(self.spark, f"{staged}/_slice={number}")
            _, target = _folder(self.spark, f"{self.input}/{number}")
            files.mkdirs(target.getParent())
            if files.exists(source):
                files.rename(source, target)
            run_available(query(self.stream()), action, self.checkpoint, mode)
