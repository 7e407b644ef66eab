"""Kafka topics.

The connector is not part of a plain PySpark installation; this builder is thin
and has not been run. What it delivers has the columns of `RECORD_SCHEMA`, and
all decoding is tested on frames of that shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def topic_options(
    servers: str, topics: list[str], start: str = "latest", max_records: int | None = None
) -> dict[str, str]:
    """Connector options; `max_records` caps a trigger over all partitions together."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start,
    }
    if max_records is not None:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def read_topics(
    spark: SparkSession, servers: str, topics: list[str], start: str = "latest", max_records: int | None = None
) -> DataFrame:
    """Stream of log records."""
    options = topic_options(servers, topics, start, max_records)
    return spark.readStream.format("kafka").options(**options).load()
