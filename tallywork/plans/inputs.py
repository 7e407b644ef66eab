"""Input shapes of the jobs, derived from the given tables by Spark.

The tables hold columns; the jobs read text lines, log records and cells. Each
builder here has a SQL counterpart in `*_SQL` for the oracle side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions.clock import utc_instant
from tallywork.functions.fields import utf8_bytes

MONEY = "decimal(18,2)"
TEXT_SCHEMA = T.StructType([T.StructField("text", T.StringType())])
LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def table_path(sf_dir: str, name: str) -> str:
    """Where a given table lies."""
    return f"{sf_dir}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(table_path(sf_dir, name))


# Address of an event: three of its numbers as octets.
IP_SQL = "'10.' || (event_id % 256) || '.' || (user_id % 256) || '.' || (event_id % 7)"


def with_ip(events: DataFrame) -> DataFrame:
    """Events with a dotted address in `ip`."""
    octets = [F.col("event_id") % 256, F.col("user_id") % 256, F.col("event_id") % 7]
    parts = [octet.cast("string") for octet in octets]
    return events.withColumn("ip", F.concat_ws(".", F.lit("10"), *parts))


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web access lines from events and page urls, one per event.

    Error events lack the referrer and so have too few fields; a user without
    a page leaves the url blank.
    """
    events = with_ip(table(spark, sf_dir, "events"))
    urls = table(spark, sf_dir, "pages").select(F.col("page_id").alias("user_id"), "url")
    site = F.concat(
        F.lit("http://"), F.col("event_type"), F.lit(".example.org/"), F.get_json_object("props", "$.k")
    )
    line = F.concat_ws(
        " ",
        F.col("ip"), F.lit("-"), F.lit("-"), F.lit("[01/Jan/2024"), F.lit("+0000]"), F.lit('"GET'),
        F.coalesce(F.col("url"), F.lit("")), F.lit('HTTP/1.1"'), F.lit("200"), F.lit("512"),
        F.when(F.col("event_type") != "error", site),
    )
    return events.join(urls, "user_id", "left").select("event_id", line.alias("value"))


ACCESS_LOG_SQL = f"""
    SELECT event_id, {IP_SQL} AS ip, coalesce(url, '') AS url,
           'http://' || event_type || '.example.org/' || json_extract_string(props, '$.k') AS referrer
    FROM events LEFT JOIN pages ON page_id = user_id
    WHERE event_type <> 'error'
"""


def ip_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe records with the address second, one per event."""
    events = with_ip(table(spark, sf_dir, "events"))
    stamp = F.col("event_id").cast("string")
    return events.select("event_id", F.concat_ws("|", stamp, F.col("ip"), F.col("event_type")).alias("value"))


def ip_range_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe records of 15 fields: one address block per nation, with gaps between."""
    nation = F.col("n_nationkey").cast("bigint")
    start = F.lit(10 << 24).cast("bigint") + nation * (10 << 16)
    fields = [
        nation.cast("string"), F.col("n_name"), start.cast("string"),
        (start + ((8 << 16) - 1)).cast("string"), *[F.lit("x")] * 9,
        F.concat((nation + 20).cast("string"), F.lit(".25")),
        F.concat((nation + 100).cast("string"), F.lit(".5")),
    ]
    return table(spark, sf_dir, "nation").select(F.concat_ws("|", *fields).alias("value"))


IP_RANGES_SQL = """
    SELECT 167772160 + n_nationkey::BIGINT * 655360 AS start_ip,
           167772160 + n_nationkey::BIGINT * 655360 + 524287 AS end_ip,
           (n_nationkey + 100) || '.5' AS longitude, (n_nationkey + 20) || '.25' AS latitude
    FROM nation
"""
IP_LOGS_SQL = f"""
    SELECT event_id, {IP_SQL} AS ip,
           10 * 16777216::BIGINT + (event_id % 256) * 65536 + (user_id % 256) * 256 + event_id % 7 AS ip_number
    FROM events
"""


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orderId,provinceId,orderPrice` lines with the order key beside them."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    joined = table(spark, sf_dir, "orders").join(customers, "o_custkey")
    return joined.select("o_orderkey", order_line().alias("value"))


def order_line():
    """The order record as text, from order and customer columns."""
    return F.concat_ws(
        ",",
        F.col("o_orderkey").cast("string"),
        F.col("c_nationkey").cast("string"),
        F.col("o_totalprice").cast(MONEY).cast("string"),
    )


ORDERS_SQL = """
    SELECT o_orderkey, c_nationkey AS province_id, o_totalprice::DECIMAL(18,2) AS order_price
    FROM orders JOIN customer ON c_custkey = o_custkey
"""


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`userId::movieId::rating::timestamp` lines."""
    shipped = F.unix_seconds(utc_instant(F.col("l_shipdate")))
    fields = ["l_suppkey", "l_partkey", "l_quantity"]
    texts = [F.col(name).cast("string") for name in fields]
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("::", *texts, shipped.cast("string")).alias("value")
    )


RATINGS_SQL = """
    SELECT l_suppkey::INTEGER AS "userId", l_partkey::INTEGER AS "movieId", l_quantity AS rating,
           epoch(l_shipdate)::BIGINT AS "timestamp"
    FROM lineitem
"""


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ratings as columns."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("movieId"), F.col("l_quantity").alias("rating")
    )


def member_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three grouping keys and a price."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return (
        table(spark, sf_dir, "orders")
        .join(customers, "o_custkey")
        .select(
            F.col("c_mktsegment").alias("area"),
            F.col("o_orderstatus").alias("member_type"),
            F.col("o_orderpriority").alias("product"),
            F.col("o_totalprice").cast(MONEY).alias("price"),
        )
    )


MEMBER_ORDERS_SQL = """
    SELECT c_mktsegment AS area, o_orderstatus AS member_type, o_orderpriority AS product,
           o_totalprice::DECIMAL(18,2) AS price
    FROM orders JOIN customer ON c_custkey = o_custkey
"""


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log records."""
    return as_log_records(table(spark, sf_dir, "events"))


def as_log_records(events: DataFrame, keep: list[str] = (), separator: str = ",") -> DataFrame:
    """Records of one topic in three partitions; the event number is the offset."""
    return events.select(
        *keep,
        utf8_bytes(F.col("user_id").cast("string")).alias("key"),
        utf8_bytes(F.concat_ws(separator, F.col("event_type"), F.col("props"))).alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        utc_instant(F.col("ts")).alias("timestamp"),
    )


LOG_RECORDS_SQL = """
    SELECT user_id::VARCHAR AS "key", event_type || ',' || props AS "value", 'events' AS topic,
           (user_id % 3)::INTEGER AS "partition", event_id AS "offset"
    FROM events
"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts as lines."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("value"))


def time_slices(df: DataFrame, time: str, slices: int) -> DataFrame:
    """Number the rows 0 .. slices-1 in `slice` by equal parts of the time span."""
    micros = F.unix_micros(utc_instant(F.col(time)))
    low, high = df.agg(F.coalesce(F.min(micros), F.lit(0)), F.coalesce(F.max(micros), F.lit(0))).first()
    part = F.floor((micros - F.lit(low)) * slices / F.lit(high - low + 1))
    return df.withColumn("slice", part.cast("int"))


TIME_SLICE_SQL = """
    CAST(floor((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) * 3
        / ((SELECT max(epoch_us(ts)) - min(epoch_us(ts)) + 1 FROM events))::DOUBLE) AS BIGINT)
"""
TRIMMED_SQL = r"regexp_replace({column}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def words_sql(table_name: str, column: str = "text", keep: str = "") -> str:
    """SQL for the non-empty words of a text column."""
    trimmed = TRIMMED_SQL.format(column=column)
    return rf"""
        SELECT {keep} word FROM (
            SELECT {keep} unnest(string_split_regex({trimmed}, '\s+')) AS word FROM {table_name}
        ) WHERE length(word) > 0
    """
