"""Queries on text lines: tokens, words, records, access log, addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions.clock import batch_time, millis_to_midnight
from tallywork.functions.fields import decode_records, json_fields, record_view
from tallywork.functions.network import ip_to_long
from tallywork.functions.text import WHITESPACE
from tallywork.operators import ranges, records, traffic, words
from tallywork.plans import inputs
from tallywork.plans.registry import query

WORDS = inputs.words_sql("documents")
COUNTS = f"SELECT word, count(*) AS cnt FROM ({WORDS}) GROUP BY word"


@query(
    "tokens_raw",
    r"""
    SELECT doc_id, word FROM (
        SELECT doc_id, unnest(string_split_regex(regexp_replace(text, '\s+$', ''), '\s+')) AS word
        FROM documents WHERE regexp_replace(text, '\s+$', '') <> '' OR text = ''
    )
    """,
)
def tokens_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.tokens(inputs.documents(spark, sf_dir), trim=False, drop_empty=False, keep=["doc_id"])


@query(
    "tokens_trim",
    rf"""
    SELECT doc_id, unnest(string_split_regex({inputs.TRIMMED_SQL.format(column="text")}, '\s+')) AS word
    FROM documents
    """,
)
def tokens_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.tokens(inputs.documents(spark, sf_dir), drop_empty=False, keep=["doc_id"])


@query("tokens", inputs.words_sql("documents", keep="doc_id,"))
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.tokens(inputs.documents(spark, sf_dir), keep=["doc_id"])


@query("word_count", COUNTS)
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(words.tokens(inputs.documents(spark, sf_dir)))


@query("top_words", f"SELECT word, cnt FROM ({COUNTS}) ORDER BY cnt DESC, word LIMIT 3")
def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.top_words(word_count(spark, sf_dir), 3)


@query("top_words_swapped", f"SELECT cnt, word FROM ({COUNTS}) ORDER BY cnt DESC, word LIMIT 3")
def top_words_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.top_words_swapped(word_count(spark, sf_dir), 3)


@query("top10_words", f"SELECT word, cnt FROM ({COUNTS}) ORDER BY cnt DESC, word LIMIT 10")
def top10_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.top_words(word_count(spark, sf_dir), 10)


@query("valid_records", f"SELECT count(*) AS cnt, count(DISTINCT event_id) AS events FROM ({inputs.ACCESS_LOG_SQL})")
def valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = records.valid_records(inputs.access_lines(spark, sf_dir), WHITESPACE, 11)
    return kept.agg(F.count(F.lit(1)).alias("cnt"), F.count_distinct("event_id").alias("events"))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.access_log(inputs.access_lines(spark, sf_dir), keep=["event_id"])


@query("access_log_fields", inputs.ACCESS_LOG_SQL)
def access_log_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir)


@query("pv", f"SELECT count(*) AS pv FROM ({inputs.ACCESS_LOG_SQL}) WHERE url <> ''")
def pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.page_views(_log(spark, sf_dir))


@query("uv", f"SELECT count(DISTINCT ip) AS uv FROM ({inputs.ACCESS_LOG_SQL})")
def uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.unique_visitors(_log(spark, sf_dir))


@query("distinct_visitors", f"SELECT DISTINCT ip FROM ({inputs.ACCESS_LOG_SQL})")
def distinct_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.visitors(_log(spark, sf_dir))


REFERRERS = f"""
    SELECT referrer, count(*) AS cnt FROM ({inputs.ACCESS_LOG_SQL})
    GROUP BY referrer ORDER BY cnt DESC, referrer LIMIT 10
"""


@query("top_referrers", REFERRERS)
def top_referrers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.top_referrers(_log(spark, sf_dir))


@query(
    "traffic_report",
    f"""
    SELECT 'pv' AS metric, '' AS item, count(*) AS cnt FROM ({inputs.ACCESS_LOG_SQL}) WHERE url <> ''
    UNION ALL SELECT 'uv', '', count(DISTINCT ip) FROM ({inputs.ACCESS_LOG_SQL})
    UNION ALL SELECT 'referrer', referrer, cnt FROM ({REFERRERS})
    """,
)
def traffic_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.traffic_report(_log(spark, sf_dir))


@query("ip_log_records", f"SELECT event_id, ip FROM ({inputs.IP_LOGS_SQL})")
def ip_log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_ip_logs(inputs.ip_log_lines(spark, sf_dir), keep=["event_id"])


@query("ip_range_records", inputs.IP_RANGES_SQL)
def ip_range_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_ip_ranges(inputs.ip_range_lines(spark, sf_dir))


@query("ip_to_long", f"SELECT event_id, ip, ip_number FROM ({inputs.IP_LOGS_SQL})")
def ip_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ip_log_records(spark, sf_dir).withColumn("ip_number", ip_to_long(F.col("ip")))


LOOKUP = f"""
    SELECT event_id, ip, longitude, latitude FROM ({inputs.IP_LOGS_SQL}) AS l
    JOIN ({inputs.IP_RANGES_SQL}) AS r ON ip_number BETWEEN start_ip AND end_ip
"""
LOCATED = ["event_id", "ip", "longitude", "latitude"]


@query("range_lookup", LOOKUP)
def range_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = ip_range_records(spark, sf_dir)
    return ranges.range_lookup(ip_log_records(spark, sf_dir), table, spread_by=["event_id"]).select(*LOCATED)


@query("range_lookup_bucketed", LOOKUP)
def range_lookup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = ip_range_records(spark, sf_dir)
    probe = ip_log_records(spark, sf_dir)
    return ranges.range_lookup(probe, table, rows_per_split=100).select(*LOCATED)


@query("geo_heat", f"SELECT longitude, latitude, count(*) AS total_count FROM ({LOOKUP}) GROUP BY ALL")
def geo_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.geo_heat(ip_log_records(spark, sf_dir), ip_range_records(spark, sf_dir))


@query("json_extract", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_fields(inputs.table(spark, sf_dir, "events"), "props", ["k"], keep=["event_id"])


@query(
    "json_fields",
    """
    SELECT event_id, event_id::VARCHAR AS id, event_type AS type, CAST(value > 50 AS VARCHAR) AS public,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at
    FROM events
    """,
)
def json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.struct(
        F.col("event_id").alias("id"), F.col("event_type").alias("type"), (F.col("value") > 50).alias("public"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )
    lines = inputs.table(spark, sf_dir, "events").select("event_id", F.to_json(event).alias("value"))
    return json_fields(lines, "value", ["id", "type", "public", "created_at"], keep=["event_id"])


@query("decode_records", inputs.LOG_RECORDS_SQL)
def decoded_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_records(inputs.log_records(spark, sf_dir)).drop("timestamp")


@query(
    "record_view",
    f"""
    SELECT topic || '-' || "partition" || ':' || "offset" || ' = ' || "value" AS line
    FROM ({inputs.LOG_RECORDS_SQL})
    """,
)
def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_view(inputs.log_records(spark, sf_dir))


@query("batch_time_format", "SELECT event_id, strftime(ts, '%Y/%m/%d %H:%M:%S') AS batch_time FROM events")
def batch_time_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select("event_id", batch_time(F.col("ts")).alias("batch_time"))


@query(
    "millis_to_midnight",
    """
    SELECT event_id, 86400000 - (epoch_us(ts) // 1000) % 86400000 AS millis FROM events
    """,
)
def midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", millis_to_midnight(F.col("ts")).alias("millis")
    )
