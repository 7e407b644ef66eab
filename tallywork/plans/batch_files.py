"""Queries that write a given table in some format and read it back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.operators import aggregates, records, words
from tallywork.plans import inputs
from tallywork.plans.batch_text import COUNTS, word_count
from tallywork.plans.registry import query
from tallywork.sources import catalog, files
from tallywork.streaming.runner import workspace

SCAN = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders"


@query("scan_parquet", SCAN)
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.table_path(sf_dir, "orders")
    return files.read_parquet(spark, path).select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("scan_load", SCAN)
def scan_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.table_path(sf_dir, "orders")
    return files.read_default(spark, path).select("o_orderkey", "o_totalprice", "o_orderstatus")


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_ratings(inputs.rating_lines(spark, sf_dir))


@query("csv_header_scan", inputs.RATINGS_SQL)
def csv_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "ratings-header")
    _ratings(spark, sf_dir).write.csv(path, sep="\t", header=True)
    found = files.read_delimited(spark, path, sep="\t")
    return found.withColumn("timestamp", F.col("timestamp").cast("bigint"))


@query("csv_schema_scan", inputs.RATINGS_SQL)
def csv_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "ratings-plain")
    _ratings(spark, sf_dir).write.csv(path, sep="\t")
    return files.read_ratings(spark, path)


@query("ratings_file_scan", inputs.RATINGS_SQL)
def ratings_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "ratings-lines")
    inputs.rating_lines(spark, sf_dir).write.text(path)
    return records.parse_ratings(files.read_lines(spark, path))


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("public", T.BooleanType()),
        T.StructField("created_at", T.StringType()),
    ]
)
EVENT_JSON = """
    SELECT event_id AS id, event_type AS type, event_type <> 'error' AS public,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at
    FROM events
"""


def _write_events(spark: SparkSession, sf_dir: str) -> str:
    path = workspace(spark, "events-json")
    made = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at")
    rows = inputs.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("type"),
        (F.col("event_type") != "error").alias("public"), made,
    )
    rows.write.json(path, compression="gzip")
    return path


@query("json_scan", EVENT_JSON)
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_json(spark, _write_events(spark, sf_dir)).select("id", "type", "public", "created_at")


@query("json_schema_scan", EVENT_JSON)
def json_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_json(spark, _write_events(spark, sf_dir), EVENT_SCHEMA)


@query("text_sink", COUNTS)
def text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "word-pairs")
    files.write_pairs(word_count(spark, sf_dir), path)
    pairs = files.read_pairs(spark, path)
    return pairs.select(F.col("left").alias("word"), F.col("right").cast("bigint").alias("cnt"))


@query("text_lines", "SELECT count(*) AS cnt, count(DISTINCT event_id || '|' || event_type) AS kinds FROM events")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "event-lines")
    line = F.concat_ws("|", F.col("event_id").cast("string"), "event_type").alias("value")
    inputs.table(spark, sf_dir, "events").select(line).write.text(path)
    lines = files.read_lines(spark, path)
    return lines.agg(F.count(F.lit(1)).alias("cnt"), F.count_distinct("value").alias("kinds"))


def _customer_table(spark: SparkSession, sf_dir: str) -> str:
    name = f"customers_{uuid.uuid4().hex[:12]}"
    customers = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    catalog.save_table(customers, name, workspace(spark, name))
    return name


@query("catalog_table", "SELECT c_custkey, c_name FROM customer")
def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _customer_table(spark, sf_dir)
    rows = catalog.read_table(spark, name)
    catalog.drop_table(spark, name)  # its files stay
    return rows


@query("catalog_sql", "SELECT c_custkey, c_name FROM customer")
def catalog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _customer_table(spark, sf_dir)
    rows = catalog.query_table(spark, f"SELECT c_custkey, c_name FROM {name}")
    catalog.drop_table(spark, name)
    return rows


@query(
    "bucketed_join",
    "SELECT c_mktsegment, count(*) AS cnt, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment",
)
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables bucketed by the same key: joined without moving a row of either."""
    home = workspace(spark, "bucketed")
    names = {name: f"tallywork_{name}_{uuid.uuid4().hex[:12]}" for name in ("orders", "customer")}
    orders = inputs.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").cast(inputs.MONEY).alias("price"))
    customers = inputs.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    for name, rows in (("orders", orders), ("customer", customers)):
        catalog.save_bucketed(rows, names[name], ["k"], 8, f"{home}/{name}")
    both = catalog.read_table(spark, names["orders"]).join(catalog.read_table(spark, names["customer"]), "k")
    for name in names.values():
        catalog.drop_table(spark, name)
    sums = both.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("cnt"), F.sum("price").cast("double").alias("total"))
    return sums


@query(
    "first_rows",
    f"""
    WITH w AS (SELECT DISTINCT word FROM ({inputs.words_sql("documents")}))
    SELECT least(count(*), 10) AS taken, least(count(*), 10) AS found FROM w
    """,
)
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows are first is open: how many there are, and how many of them the source holds."""
    every = words.tokens(inputs.documents(spark, sf_dir)).select("word").distinct()
    some = aggregates.first_rows(every, 10)
    held = every.withColumn("held", F.lit(1))
    return some.join(held, "word", "left").agg(F.count(F.lit(1)).alias("taken"), F.count("held").alias("found"))
