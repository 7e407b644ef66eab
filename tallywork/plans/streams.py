"""Streaming queries, run to the end of the given tables.

Where the result does not depend on how the input falls into batches, the
stream reads the given table itself. Where it is a result per batch, the rows
arrive in three slices that together are the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions.clock import utc_instant, utc_text
from tallywork.functions.fields import decode_records, record_view
from tallywork.operators import bitmaps, orders, records, words
from tallywork.plans import inputs
from tallywork.plans.batch_text import COUNTS
from tallywork.plans.registry import query
from tallywork.session import SETTINGS
from tallywork.sources.streams import stream_lines, stream_parquet
from tallywork.streaming import buckets, outputs, totals, windows
from tallywork.streaming.runner import (
    Arrivals,
    latest_batch,
    read_batches,
    run_available,
    run_until_idle,
    settings,
    to_batch_dirs,
    workspace,
)

SLICES = 3
# Files per trigger when a stream reads a given table: bounds the size of a batch.
MAX_FILES = 1000


def _stream(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    schema = inputs.table(spark, sf_dir, name).select(*columns).schema
    return stream_parquet(spark, inputs.table_path(sf_dir, name), schema, MAX_FILES)


def _stream_words(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return words.tokens(_stream(spark, sf_dir, name, ["text"]), "text")


# --- word counts ---------------------------------------------------------------------------------

TALK_WORDS = inputs.words_sql("conversations", keep="conv_id % 3 AS batch_id,").replace(
    "SELECT conv_id % 3 AS batch_id, word", "SELECT batch_id, word"
)


def _talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation texts in three slices."""
    return inputs.table(spark, sf_dir, "conversations").select(
        F.col("text").alias("value"), F.expr(f"pmod(conv_id, {SLICES})").alias("slice")
    )


def _count_words(batch: DataFrame) -> DataFrame:
    return words.word_count(words.tokens(batch))


@query("stream_batch_word_count", f"SELECT batch_id, word, count(*) AS cnt FROM ({TALK_WORDS}) GROUP BY batch_id, word")
def stream_batch_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = Arrivals(spark, "batch-words", inputs.LINE_SCHEMA)
    action = to_batch_dirs(arrivals.output, _count_words)
    arrivals.run_slices(_talk(spark, sf_dir), "slice", SLICES, lambda stream: stream, action)
    return read_batches(spark, arrivals.output)


@query(
    "stream_transform",
    f"""
    SELECT batch_id, word, cnt FROM (
        SELECT batch_id, word, count(*) AS cnt,
               row_number() OVER (PARTITION BY batch_id ORDER BY count(*) DESC, word) AS rn
        FROM ({TALK_WORDS}) GROUP BY batch_id, word
    ) WHERE rn <= 3
    """,
)
def stream_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = Arrivals(spark, "batch-top-words", inputs.LINE_SCHEMA)
    action = to_batch_dirs(arrivals.output, lambda batch: words.top_words(_count_words(batch), 3))
    arrivals.run_slices(_talk(spark, sf_dir), "slice", SLICES, lambda stream: stream, action)
    return read_batches(spark, arrivals.output)


@query(
    "stream_union",
    f"""
    SELECT word, count(*) AS cnt
    FROM ({inputs.words_sql("documents")} UNION ALL {inputs.words_sql("conversations")}) GROUP BY word
    """,
)
def stream_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = workspace(spark, "union-words")
    both = _stream_words(spark, sf_dir, "documents").union(_stream_words(spark, sf_dir, "conversations"))
    action = outputs.keyed_table_action(f"{home}/output", ["word"])
    run_available(words.word_count(both), action, f"{home}/checkpoint", "update")
    return outputs.keyed_table(spark, f"{home}/output", ["word"])


@query("stream_wc_update", COUNTS)
def stream_wc_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = workspace(spark, "words-update")
    counts = words.word_count(_stream_words(spark, sf_dir, "documents"))
    run_available(counts, outputs.keyed_table_action(f"{home}/output", ["word"]), f"{home}/checkpoint", "update")
    return outputs.keyed_table(spark, f"{home}/output", ["word"])


@query("stream_wc_complete", COUNTS)
def stream_wc_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = workspace(spark, "words-complete")
    counts = words.word_count(_stream_words(spark, sf_dir, "documents"))
    every_second = {"processingTime": "1 second"}
    run_until_idle(counts, to_batch_dirs(f"{home}/output"), f"{home}/checkpoint", "complete", every_second)
    return latest_batch(spark, f"{home}/output")


@query("stream_upsert", f"SELECT word, count(*) AS cnt FROM ({TALK_WORDS}) GROUP BY word")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = Arrivals(spark, "words-upsert", inputs.LINE_SCHEMA)
    action = outputs.keyed_table_action(arrivals.output, ["word"], every=2)
    arrivals.run_slices(_talk(spark, sf_dir), "slice", SLICES, _count_words, action, "update")
    return outputs.keyed_table(spark, arrivals.output, ["word"])


@query("stream_upsert_buckets", f"SELECT word, count(*) AS cnt FROM ({TALK_WORDS}) GROUP BY word")
def stream_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed table in hash buckets, of which a batch writes anew only those that have changed much."""
    arrivals = Arrivals(spark, "words-buckets", inputs.LINE_SCHEMA)
    table = buckets.BucketTable(spark, arrivals.output, ["word"], buckets=16)
    arrivals.run_slices(_talk(spark, sf_dir), "slice", SLICES, _count_words, buckets.bucket_table_action(table), "update")
    return table.rows()


FILES = 4


@query(
    "stream_rate_cap",
    f"SELECT {FILES} AS batches, 1 AS files_per_batch, count(*) AS cnt FROM ({inputs.ORDERS_SQL})",
)
def stream_rate_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per trigger: as many batches as files."""
    home = workspace(spark, "rate-cap")
    lines = inputs.order_lines(spark, sf_dir).select("value")
    lines.repartition(FILES).write.text(f"{home}/input")
    stream = stream_lines(spark, f"{home}/input", max_files=1).withColumn("file", F.col("_metadata.file_name"))
    run_available(stream, to_batch_dirs(f"{home}/output"), f"{home}/checkpoint")
    per_batch = read_batches(spark, f"{home}/output").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("cnt"), F.count_distinct("file").alias("files")
    )
    return per_batch.agg(
        F.count(F.lit(1)).cast("int").alias("batches"), F.max("files").cast("int").alias("files_per_batch"),
        F.sum("cnt").alias("cnt"),
    )


RECORD_WORDS = inputs.words_sql("(SELECT event_type || ' ' || props AS record FROM events)", "record")


def _record_arrivals(spark: SparkSession, sf_dir: str, name: str) -> tuple[Arrivals, DataFrame]:
    """Log records whose bytes are words, in three slices by time."""
    events = inputs.time_slices(inputs.table(spark, sf_dir, "events"), "ts", SLICES)
    rows = inputs.as_log_records(events, keep=["slice"], separator=" ")
    return Arrivals(spark, name, rows.drop("slice").schema), rows


def _record_words(records_in: DataFrame) -> DataFrame:
    return words.word_count(words.tokens(decode_records(records_in), "value"))


@query("stream_record_word_count", f"SELECT word, count(*) AS cnt FROM ({RECORD_WORDS}) GROUP BY word")
def stream_record_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals, rows = _record_arrivals(spark, sf_dir, "record-words")
    action = outputs.keyed_table_action(arrivals.output, ["word"])
    arrivals.run_slices(rows, "slice", SLICES, _record_words, action, "update")
    return outputs.keyed_table(spark, arrivals.output, ["word"])


@query(
    "stream_batch_time",
    f"""
    WITH s AS (SELECT {inputs.TIME_SLICE_SQL} AS batch_id, event_type, props, ts FROM events)
    SELECT batch_id, count(*) AS cnt, strftime(max(ts), '%Y/%m/%d %H:%M:%S') AS batch_time FROM s GROUP BY batch_id
    """,
)
def stream_batch_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch's records, with the time of the batch."""
    arrivals, rows = _record_arrivals(spark, sf_dir, "batch-time")

    def count(batch: DataFrame) -> DataFrame:
        return batch.agg(F.count(F.lit(1)).alias("cnt"))

    action = to_batch_dirs(arrivals.output, outputs.stamped(count, "timestamp"))
    arrivals.run_slices(rows, "slice", SLICES, lambda stream: stream, action)
    return read_batches(spark, arrivals.output)


# --- running totals --------------------------------------------------------------------------------

BY_BATCH = f"""
    SELECT o_orderkey % 3 AS batch_id, province_id, sum(order_price) AS amount, count(*) AS cnt
    FROM ({inputs.ORDERS_SQL}) GROUP BY ALL
"""


def _order_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.order_lines(spark, sf_dir)
    return lines.select("value", F.expr(f"pmod(o_orderkey, {SLICES})").alias("slice"))


def _parse(stream: DataFrame) -> DataFrame:
    return records.parse_orders(stream, price=inputs.MONEY)


def _total(stream: DataFrame) -> DataFrame:
    return totals.running_total(_parse(stream), ["province_id"], "order_price")


def _run_totals(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    arrivals = Arrivals(spark, f"totals-{mode}", inputs.LINE_SCHEMA)
    action = to_batch_dirs(arrivals.output)
    arrivals.run_slices(_order_slices(spark, sf_dir), "slice", SLICES, _total, action, mode)
    rows = read_batches(spark, arrivals.output)
    return rows.withColumn("amount", F.col("amount").cast("double"))


@query(
    "stream_total_complete",
    f"""
    WITH s AS ({BY_BATCH})
    SELECT b.batch_id, s.province_id, sum(s.amount)::DOUBLE AS amount
    FROM (SELECT DISTINCT batch_id FROM s) AS b JOIN s ON s.batch_id <= b.batch_id
    GROUP BY b.batch_id, s.province_id
    """,
)
def stream_total_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_totals(spark, sf_dir, "complete")


@query(
    "stream_total_update",
    f"""
    SELECT batch_id, province_id,
           (sum(amount) OVER (PARTITION BY province_id ORDER BY batch_id))::DOUBLE AS amount
    FROM ({BY_BATCH})
    """,
)
def stream_total_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_totals(spark, sf_dir, "update")


@query(
    "stream_total_stateful",
    f"""
    SELECT batch_id, province_id,
           (sum(amount) OVER (PARTITION BY province_id ORDER BY batch_id))::DOUBLE AS amount
    FROM ({BY_BATCH})
    """,
)
def stream_total_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = Arrivals(spark, "totals-stateful", inputs.LINE_SCHEMA)

    def in_cents(stream: DataFrame) -> DataFrame:
        cents = (F.col("order_price") * 100).cast("bigint")
        rows = _parse(stream).select("province_id", cents.alias("cents"))
        return totals.running_total_stateful(rows, "province_id", "cents")

    action = to_batch_dirs(arrivals.output)
    arrivals.run_slices(_order_slices(spark, sf_dir), "slice", SLICES, in_cents, action, "update")
    rows = read_batches(spark, arrivals.output)
    amount = (F.col("total").cast("decimal(20,0)") / 100).cast("double").alias("amount")
    return rows.select("batch_id", "province_id", amount)


@query(
    "stream_file_lines",
    f"SELECT province_id::VARCHAR AS province_id, count(*) AS cnt FROM ({inputs.ORDERS_SQL}) GROUP BY province_id",
)
def stream_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = workspace(spark, "file-lines")
    inputs.order_lines(spark, sf_dir).select("value").write.text(f"{home}/input")
    lines = stream_lines(spark, f"{home}/input", MAX_FILES)
    counts = orders.province_count(records.parse_orders(lines, province="string"))
    run_available(counts, outputs.keyed_table_action(f"{home}/output", ["province_id"]), f"{home}/checkpoint", "update")
    return outputs.keyed_table(spark, f"{home}/output", ["province_id"])


EVENT_SCHEMA = T.StructType([T.StructField("event_type", T.StringType())])


@query(
    "stream_resume",
    f"""
    SELECT batch_id, event_type, (sum(cnt) OVER (PARTITION BY event_type ORDER BY batch_id))::BIGINT AS cnt
    FROM (SELECT {inputs.TIME_SLICE_SQL} AS batch_id, event_type, count(*) AS cnt FROM events GROUP BY ALL)
    """,
)
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = Arrivals(spark, "resume", EVENT_SCHEMA)
    events = inputs.time_slices(inputs.table(spark, sf_dir, "events"), "ts", SLICES)

    def counts(stream: DataFrame) -> DataFrame:
        return stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))

    arrivals.run_slices(events, "slice", SLICES, counts, to_batch_dirs(arrivals.output), "update")
    return read_batches(spark, arrivals.output)


DAILY_SCHEMA = T.StructType(
    [
        T.StructField("instant", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("amount_in", T.DecimalType(18, 2)),
    ]
)


@query(
    "daily_running_total",
    """
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS day, event_type,
           sum(value::DECIMAL(18,2))::DOUBLE AS amount, count(*) AS cnt
    FROM events GROUP BY ALL
    """,
)
def daily_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = Arrivals(spark, "daily", DAILY_SCHEMA)
    events = inputs.time_slices(inputs.table(spark, sf_dir, "events"), "ts", SLICES).select(
        utc_instant(F.col("ts")).alias("instant"), "event_type",
        F.col("value").cast(inputs.MONEY).alias("amount_in"), "slice",
    )

    def daily(stream: DataFrame) -> DataFrame:
        sums = totals.daily_total(stream, "instant", ["event_type"], "amount_in")
        return sums.select(F.col("day_window.start").alias("start"), "event_type", "amount", "cnt")

    action = outputs.keyed_table_action(arrivals.output, ["start", "event_type"])
    arrivals.run_slices(events, "slice", SLICES, daily, action, "update")
    rows = outputs.keyed_table(spark, arrivals.output, ["start", "event_type"])
    return rows.select(
        utc_text(F.col("start")).alias("day"), "event_type", F.col("amount").cast("double").alias("amount"), "cnt"
    )


@query(
    "daily_timer_total",
    """
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS day, event_type,
           sum(value::DECIMAL(18,2))::DOUBLE AS amount, count(*) AS cnt
    FROM events GROUP BY ALL
    """,
)
def daily_timer_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per day whose state ends with the day. Each slice has rows of all days, so most rows come late."""
    schema = T.StructType([T.StructField("instant", T.TimestampType()), T.StructField("event_type", T.StringType()), T.StructField("cents", T.LongType())])
    arrivals = Arrivals(spark, "daily-timers", schema)
    rows = inputs.table(spark, sf_dir, "events").select(
        utc_instant(F.col("ts")).alias("instant"), "event_type", (F.col("value").cast(inputs.MONEY) * 100).cast("bigint").alias("cents"),
        F.expr(f"pmod(event_id, {SLICES})").alias("slice"),
    )
    table = buckets.BucketTable(spark, arrivals.output, ["event_type", "day"], buckets=8)

    def daily(stream: DataFrame) -> DataFrame:
        return totals.day_totals(stream, "instant", "event_type", "cents", "6 hours")

    with settings(spark, {"spark.sql.streaming.stateStore.providerClass": SETTINGS["spark.sql.streaming.stateStore.providerClass"]}):
        arrivals.run_slices(rows, "slice", SLICES, daily, totals.day_table_action(table), "update")
    amount = (F.col("amount").cast("decimal(20,0)") / 100).cast("double")
    return table.rows().select(utc_text(F.timestamp_millis("day")).alias("day"), "event_type", amount.alias("amount"), "cnt")


# --- windows -----------------------------------------------------------------------------------------

WINDOW_SQL = f"""
    WITH s AS ({BY_BATCH})
    SELECT b.batch_id, s.province_id, sum(s.cnt)::BIGINT AS cnt
    FROM (SELECT DISTINCT batch_id FROM s) AS b JOIN s ON s.batch_id BETWEEN b.batch_id - 1 AND b.batch_id
    GROUP BY b.batch_id, s.province_id
"""
WINDOW_TEXT_SQL = f"SELECT batch_id, province_id::VARCHAR AS province_id, cnt FROM ({WINDOW_SQL})"


def _run_windows(spark: SparkSession, sf_dir: str, name: str, count, merge) -> DataFrame:
    arrivals = Arrivals(spark, name, inputs.LINE_SCHEMA)
    action = windows.batch_windows(f"{arrivals.home}/partials", arrivals.output, count, merge)
    arrivals.run_slices(_order_slices(spark, sf_dir), "slice", SLICES, lambda stream: stream, action)
    return read_batches(spark, arrivals.output)


@query("stream_window_batches", WINDOW_TEXT_SQL)
def stream_window_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(batch: DataFrame) -> DataFrame:
        return orders.province_count(records.parse_orders(batch, province="string"))

    return _run_windows(spark, sf_dir, "window-count", count, windows.merge_counts(["province_id"]))


@query("stream_reduce_window", WINDOW_TEXT_SQL)
def stream_reduce_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(batch: DataFrame) -> DataFrame:
        ones = records.parse_orders(batch, province="string").withColumn("one", F.lit(1).cast("bigint"))
        return ones.groupBy("province_id").agg(F.sum("one").alias("cnt"))

    return _run_windows(spark, sf_dir, "window-reduce", count, windows.merge_counts(["province_id"]))


@query("stream_window_sql", WINDOW_SQL)
def stream_window_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(batch: DataFrame) -> DataFrame:
        rows = records.parse_orders(batch)
        text = "SELECT province_id, count(1) AS cnt FROM {rows} GROUP BY province_id"
        return batch.sparkSession.sql(text, rows=rows)

    return _run_windows(spark, sf_dir, "window-sql", count, windows.merge_counts_sql("province_id"))


LONG, LONG_SLICES = 4, 6
LONG_SQL = f"""
    WITH s AS (SELECT o_orderkey % {LONG_SLICES} AS batch_id, c_nationkey AS province_id, o_custkey, o_totalprice::DECIMAL(18,2) AS price
               FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT b.batch_id, s.province_id, max(s.price)::DOUBLE AS top_price, count(DISTINCT s.o_custkey) AS customers
    FROM (SELECT DISTINCT batch_id FROM s) AS b JOIN s ON s.batch_id BETWEEN b.batch_id - {LONG - 1} AND b.batch_id
    GROUP BY b.batch_id, s.province_id
"""


@query("stream_window_long", LONG_SQL)
def stream_window_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest price and the number of customers over four batches: nothing that could be taken away from a window."""
    schema = T.StructType([T.StructField("province_id", T.LongType()), T.StructField("customer", T.LongType()), T.StructField("price", T.DecimalType(18, 2))])
    arrivals = Arrivals(spark, "window-long", schema)
    customers = inputs.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("province_id"))
    rows = inputs.table(spark, sf_dir, "orders").join(customers, "o_custkey").select(
        "province_id", F.col("o_custkey").cast("bigint").alias("customer"), F.col("o_totalprice").cast(inputs.MONEY).alias("price"),
        F.expr(f"pmod(o_orderkey, {LONG_SLICES})").alias("slice"),
    )

    def count(batch: DataFrame) -> DataFrame:
        return bitmaps.parts(batch, ["province_id"], "customer", F.max("price").alias("top_price"))

    def merge(window: DataFrame) -> DataFrame:
        return bitmaps.merged(window, ["province_id"], F.max("top_price").alias("top_price"))

    def result(window: DataFrame) -> DataFrame:
        return bitmaps.counts(window, ["province_id"], "customers", F.max("top_price").cast("double").alias("top_price"))

    action = windows.long_windows(f"{arrivals.home}/partials", arrivals.output, count, merge, LONG, result=result)
    arrivals.run_slices(rows, "slice", LONG_SLICES, lambda stream: stream, action)
    return read_batches(spark, arrivals.output)


@query(
    "stream_window_event_time",
    """
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS cnt FROM (
        SELECT unnest([time_bucket(INTERVAL 2 HOURS, ts), time_bucket(INTERVAL 2 HOURS, ts) - INTERVAL 2 HOURS]) AS w,
               event_type
        FROM events
    ) GROUP BY ALL
    """,
)
def stream_window_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = workspace(spark, "window-event-time")
    events = _stream(spark, sf_dir, "events", ["ts", "event_type"])
    events = events.select(utc_instant(F.col("ts")).alias("instant"), "event_type")
    counts = windows.event_windows(events, "instant", "4 hours", "2 hours", ["event_type"], F.count(F.lit(1)))
    rows = counts.select(F.col("window.start").alias("start"), "event_type", "cnt")
    run_available(rows, outputs.keyed_table_action(f"{home}/output", ["start", "event_type"]), f"{home}/checkpoint", "update")
    table = outputs.keyed_table(spark, f"{home}/output", ["start", "event_type"])
    return table.select(utc_text(F.col("start")).alias("window_start"), "event_type", "cnt")


# --- offsets -------------------------------------------------------------------------------------------


@query(
    "offset_ranges",
    f"""
    SELECT {inputs.TIME_SLICE_SQL} AS batch_id, 'events' AS topic, (user_id % 3)::INTEGER AS "partition",
           min(event_id) AS from_offset, max(event_id) + 1 AS until_offset
    FROM events GROUP BY ALL
    """,
)
def offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = inputs.time_slices(inputs.table(spark, sf_dir, "events"), "ts", SLICES)
    rows = inputs.as_log_records(slices, keep=["slice"])
    arrivals = Arrivals(spark, "offsets", rows.drop("slice").schema)
    offsets = f"{arrivals.home}/offsets"

    action = outputs.offsets_action(to_batch_dirs(arrivals.output, record_view), offsets)
    arrivals.run_slices(rows, "slice", SLICES, lambda stream: stream, action)
    return read_batches(spark, offsets)


@query(
    "offsets_with_result",
    f"""
    WITH s AS (SELECT {inputs.TIME_SLICE_SQL} AS slice, * FROM events)
    SELECT 'events' AS topic, (user_id % 3)::INTEGER AS "partition", min(event_id) AS from_offset, max(event_id) + 1 AS until_offset,
           (SELECT count(DISTINCT user_id) FROM events) AS users, (SELECT count(*) FROM events) AS records
    FROM s WHERE slice = (SELECT max(slice) FROM s) GROUP BY ALL
    """,
)
def offsets_with_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per user, and the offsets of the batch that they are as of, which one file commits together."""
    slices = inputs.time_slices(inputs.table(spark, sf_dir, "events"), "ts", SLICES)
    rows = inputs.as_log_records(slices, keep=["slice"])
    arrivals = Arrivals(spark, "offsets-result", rows.drop("slice").schema)
    table = buckets.BucketTable(spark, arrivals.output, ["key"], buckets=8)

    def counts(batch: DataFrame) -> DataFrame:
        return batch.groupBy("key").agg(F.count(F.lit(1)).alias("cnt"))

    def action(batch: DataFrame, batch_id: int) -> None:
        now = counts(batch)
        both = table.rows_before(batch_id, now).unionByName(now).groupBy("key").agg(F.sum("cnt").alias("cnt"))
        offsets = outputs.offset_ranges(batch).collect()
        table.commit(both, batch_id, [row.asDict() for row in offsets])

    arrivals.run_slices(rows, "slice", SLICES, lambda stream: stream, action)
    kind = 'topic string, partition int, from_offset long, until_offset long'
    ranges = spark.createDataFrame([tuple(each[name] for name in ("topic", "partition", "from_offset", "until_offset")) for each in table.note() or []], kind)
    counted = table.rows()
    return ranges.select(
        "*", counted.agg(F.count(F.lit(1))).scalar().alias("users"), counted.agg(F.sum("cnt")).scalar().alias("records")
    )
