"""File directories as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: str | None = None) -> DataFrame:
    """Text files of a directory as a stream of lines in column `value`.

    Files already there are read too. `max_files` caps a trigger.
    """
    return _capped(spark, max_files, max_bytes).text(path)


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None, max_bytes: str | None = None
) -> DataFrame:
    """Parquet files as a stream; only the columns of `schema` are read.

    `path` may be a directory, a single file or a glob. The file source wants a
    directory or a glob, so one bracket makes a glob of a file's name.
    """
    path = path.rstrip("/") or "/"
    glob = path if any(char in path for char in "*?[{") or _is_folder(spark, path) else f"{path[:-1]}[{path[-1]}]"
    return _capped(spark, max_files, max_bytes).schema(schema).parquet(glob)


def _is_folder(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(context._jsc.hadoopConfiguration())
    return files.exists(place) and files.getFileStatus(place).isDirectory()


def _capped(spark: SparkSession, max_files: int | None, max_bytes: str | None):
    """A reader whose batches take so many files, or files of so many bytes (such as `64m`) and one more; not both."""
    if max_files is not None and max_bytes is not None:
        raise ValueError("cap a batch by files or by bytes")
    reader = spark.readStream
    if max_bytes is not None:
        return reader.option("maxBytesPerTrigger", max_bytes)
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)
