"""Queries on typed rows: aggregates, groupings, ratings, cells, user functions, partitions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions import aggregators, user_functions
from tallywork.operators import aggregates, cells, grouping, matching, orders, partitions, ratings, records, topk, upsert
from tallywork.plans import inputs
from tallywork.plans.registry import query
from tallywork.sources import files
from tallywork.streaming.runner import workspace

# --- whole set and keyed aggregates ---------------------------------------------------------


@query(
    "range_stats",
    """
    SELECT count(*) AS cnt, sum(o_orderkey)::BIGINT AS total, min(o_orderkey) AS lowest,
           max(o_orderkey) AS highest
    FROM orders
    """,
)
def range_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.whole_set(inputs.table(spark, sf_dir, "orders"), "o_orderkey")


@query("fold_with_zero", "SELECT (sum(o_orderkey) + 100 * 3)::BIGINT AS folded FROM orders")
def fold_with_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.fold_with_zero(inputs.table(spark, sf_dir, "orders"), "o_orderkey", 100, 2)


@query(
    "global_top2",
    """
    SELECT rn AS position, l_extendedprice AS value FROM (
        SELECT l_extendedprice, row_number() OVER (ORDER BY l_extendedprice DESC) AS rn FROM lineitem
    ) WHERE rn <= 2
    """,
)
def global_top2(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = aggregates.global_top(inputs.table(spark, sf_dir, "lineitem"), "l_extendedprice", 2)
    listed = best.select(F.posexplode("top_values").alias("position", "value"))
    return listed.select((F.col("position") + 1).cast("bigint").alias("position"), "value")


@query("count_by_key", "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.keyed_count(inputs.table(spark, sf_dir, "events"), ["event_type"])


@query("keyed_sum", "SELECT user_id, sum(event_id)::BIGINT AS total FROM events GROUP BY user_id")
def keyed_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.keyed_sum(inputs.table(spark, sf_dir, "events"), ["user_id"], "event_id", "total")


@query("map_partitions", "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def map_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    def to_pairs(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(one=1)

    events = inputs.table(spark, sf_dir, "events").select("event_type")
    pairs = partitions.map_partitions(events, to_pairs, "event_type string, one bigint")
    return aggregates.keyed_sum(pairs, ["event_type"], "one", "cnt")


@query("union_all", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT p_type FROM part")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    def names(table: str, column: str) -> DataFrame:
        return inputs.table(spark, sf_dir, table).select(F.col(column).alias("name"))

    return names("nation", "n_name").unionByName(names("region", "r_name")).unionByName(names("part", "p_type"))


# --- top k per key ---------------------------------------------------------------------------

TOP3 = """
    SELECT l_returnflag, l_extendedprice, rn FROM (
        SELECT l_returnflag, l_extendedprice,
               row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS rn
        FROM lineitem
    ) WHERE rn <= 3
"""


@query("group_topk_rank", TOP3)
def group_topk_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = topk.group_topk_rank(inputs.table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", 3)
    return top.withColumn("rn", F.col("rn").cast("bigint"))


@query("group_topk_list", TOP3)
def group_topk_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = topk.group_topk_list(inputs.table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", 3)
    listed = top.select("l_returnflag", F.posexplode("top_values").alias("rn", "l_extendedprice"))
    return listed.withColumn("rn", (F.col("rn") + 1).cast("bigint"))


@query("key_number_top3", TOP3.replace("l_extendedprice", "number").replace("l_returnflag", "key").replace(
    "FROM lineitem", "FROM (SELECT l_returnflag AS key, floor(l_extendedprice)::INTEGER AS number FROM lineitem)"))
def key_number_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.floor("l_extendedprice").cast("string")
    lines = inputs.table(spark, sf_dir, "lineitem").select(F.concat_ws(" ", "l_returnflag", price).alias("value"))
    top = topk.group_topk_rank(records.parse_key_numbers(lines), ["key"], "number", 3)
    return top.withColumn("rn", F.col("rn").cast("bigint"))


# --- subtotals --------------------------------------------------------------------------------

LEVEL_KEYS = ["area", "member_type", "product"]


def _rows() -> dict:
    return {"cnt": grouping.count_rows()}


def _price() -> dict:
    return {"total_price": grouping.total("price")}


def _level_sql(levels: str, measure: str) -> str:
    return f"""
        SELECT area, member_type, product, {measure},
               grouping_id(area, member_type, product)::BIGINT AS level_id
        FROM ({inputs.MEMBER_ORDERS_SQL}) GROUP BY {levels}
    """


SETS = "GROUPING SETS ((area), (area, member_type), (area, member_type, product))"
KEYS_SQL = "area, member_type, product"
COUNT_SQL = "count(*) AS cnt"
SUM_SQL = "sum(price)::DOUBLE AS total_price"


def _as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("total_price", F.col("total_price").cast("double"))


@query("grouping_sets", _level_sql(SETS, COUNT_SQL))
def grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = [LEVEL_KEYS[:1], LEVEL_KEYS[:2], LEVEL_KEYS]
    levels = grouping.grouping_sets(inputs.member_orders(spark, sf_dir), LEVEL_KEYS, sets, _rows())
    return grouping.in_key_order(levels, LEVEL_KEYS)


@query("rollup_count", _level_sql(f"ROLLUP ({KEYS_SQL})", COUNT_SQL))
def rollup_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.rollup(inputs.member_orders(spark, sf_dir), LEVEL_KEYS, _rows())


@query("rollup_sum", _level_sql(f"ROLLUP ({KEYS_SQL})", SUM_SQL))
def rollup_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(grouping.rollup(inputs.member_orders(spark, sf_dir), LEVEL_KEYS, _price()))


@query("cube_count", _level_sql(f"CUBE ({KEYS_SQL})", COUNT_SQL))
def cube_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.cube(inputs.member_orders(spark, sf_dir), LEVEL_KEYS, _rows())


@query("cube_sum", _level_sql(f"CUBE ({KEYS_SQL})", SUM_SQL))
def cube_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(grouping.cube(inputs.member_orders(spark, sf_dir), LEVEL_KEYS, _price()))


@query(
    "rollup_average",
    _level_sql(
        f"ROLLUP ({KEYS_SQL})",
        "sum(price)::DOUBLE / count(price) AS avg_price, max(price)::DOUBLE AS top_price, min(price)::DOUBLE AS low_price",
    ),
)
def rollup_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {
        "avg_price": grouping.average("price"), "top_price": grouping.highest("price"), "low_price": grouping.lowest("price"),
    }
    levels = grouping.rollup(inputs.member_orders(spark, sf_dir), LEVEL_KEYS, measures)
    return levels.withColumns({name: F.col(name).cast("double") for name in ("top_price", "low_price")})


@query("cube_distinct", _level_sql("CUBE (area, member_type, product)", "count(DISTINCT price) AS prices"))
def cube_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct prices as bitmaps: the cube multiplies those of the finest level, not the orders."""
    return grouping.cube(inputs.member_orders(spark, sf_dir), LEVEL_KEYS, {"prices": grouping.distinct_of("price")})


@query("rollup_distinct", _level_sql("ROLLUP (area, member_type, product)", "count(*) AS cnt, count(DISTINCT price) AS prices"))
def rollup_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {"cnt": grouping.count_rows(), "prices": grouping.distinct_of("price")}
    return grouping.rollup(inputs.member_orders(spark, sf_dir), LEVEL_KEYS, measures)


@query("group_sum", f"SELECT {KEYS_SQL}, {SUM_SQL} FROM ({inputs.MEMBER_ORDERS_SQL}) GROUP BY {KEYS_SQL}")
def group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = aggregates.group_sum(inputs.member_orders(spark, sf_dir), LEVEL_KEYS, F.col("price"), "total_price")
    return grouping.in_key_order(_as_double(sums), LEVEL_KEYS)


@query(
    "subtotals_union",
    f"""
    WITH m AS ({inputs.MEMBER_ORDERS_SQL})
    SELECT '' AS area, '' AS member_type, '' AS product, count(*) AS cnt FROM m
    UNION ALL SELECT area, '', '', count(*) FROM m GROUP BY area
    UNION ALL SELECT area, member_type, '', count(*) FROM m GROUP BY area, member_type
    UNION ALL SELECT area, member_type, product, count(*) FROM m GROUP BY area, member_type, product
    """,
)
def subtotals_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.subtotals_union(inputs.member_orders(spark, sf_dir), LEVEL_KEYS, _rows())


# --- ratings ------------------------------------------------------------------------------------

STATS = """
    SELECT l_partkey AS "movieId", count(*) AS cnt,
           round(avg(l_quantity)::DECIMAL(38,10), 2)::DOUBLE AS avg_rating
    FROM lineitem GROUP BY l_partkey
"""
TOP10 = f"""SELECT * FROM ({STATS}) WHERE cnt > 30 ORDER BY cnt DESC, avg_rating DESC, "movieId" LIMIT 10"""


@query("ratings_parse", inputs.RATINGS_SQL)
def ratings_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_ratings(inputs.rating_lines(spark, sf_dir))


@query("ratings_stats", STATS)
def ratings_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.ratings_stats(inputs.ratings(spark, sf_dir))


@query("ratings_top10", TOP10)
def ratings_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.ratings_top(inputs.ratings(spark, sf_dir), more_than=30)


@query("ratings_top10_sql", TOP10)
def ratings_top10_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.ratings_top_sql(inputs.ratings(spark, sf_dir), more_than=30)


@query("ratings_top10_by_avg", TOP10.replace("cnt DESC, avg_rating DESC", "avg_rating DESC, cnt DESC"))
def ratings_top10_by_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.ratings_top(inputs.ratings(spark, sf_dir), more_than=30, best_average=True)


# --- orders ---------------------------------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_orders(inputs.order_lines(spark, sf_dir), price=inputs.MONEY)


@query("order_parse", f"SELECT o_orderkey::VARCHAR AS order_id, province_id, order_price::DOUBLE AS order_price FROM ({inputs.ORDERS_SQL})")
def order_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_orders(inputs.order_lines(spark, sf_dir))


@query("province_amount", f"SELECT province_id, sum(order_price)::DOUBLE AS amount FROM ({inputs.ORDERS_SQL}) GROUP BY province_id")
def province_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = orders.province_amount(_orders(spark, sf_dir))
    return sums.withColumn("amount", F.col("amount").cast("double"))


@query("province_count", f"SELECT province_id::VARCHAR AS province_id, count(*) AS cnt FROM ({inputs.ORDERS_SQL}) GROUP BY province_id")
def province_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.province_count(records.parse_orders(inputs.order_lines(spark, sf_dir), province="string"))


# --- cells and upserts ------------------------------------------------------------------------------


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of every customer; the second lacks the name."""
    customer = inputs.table(spark, sf_dir, "customer")
    money = F.col("c_acctbal").cast(inputs.MONEY)
    first = customer.select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), money.alias("balance")
    )
    second = customer.select(
        "c_custkey", F.lower("c_mktsegment").alias("segment"), (money + 1).cast(inputs.MONEY).alias("balance")
    )
    older = cells.wide_to_cells(first, "c_custkey", "info", F.lit(1))
    return older.unionByName(cells.wide_to_cells(second, "c_custkey", "info", F.lit(2)))


CELLS = """
    SELECT c_custkey::VARCHAR AS row_key, 'info' AS family, u.qualifier AS qualifier, u.cell AS "value",
           u.version::BIGINT AS version
    FROM (SELECT c_custkey, unnest([
        {'qualifier': 'name', 'cell': c_name, 'version': 1},
        {'qualifier': 'segment', 'cell': c_mktsegment, 'version': 1},
        {'qualifier': 'balance', 'cell': c_acctbal::DECIMAL(18,2)::VARCHAR, 'version': 1},
        {'qualifier': 'segment', 'cell': lower(c_mktsegment), 'version': 2},
        {'qualifier': 'balance', 'cell': (c_acctbal::DECIMAL(18,2) + 1)::DECIMAL(18,2)::VARCHAR, 'version': 2}
    ]) AS u FROM customer)
"""


@query("wide_to_cells", CELLS)
def wide_to_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir)


@query(
    "cells_to_wide",
    """
    SELECT c_custkey::VARCHAR AS row_key, c_name AS info_name, lower(c_mktsegment) AS info_segment,
           (c_acctbal::DECIMAL(18,2) + 1)::DECIMAL(18,2)::VARCHAR AS info_balance
    FROM customer
    """,
)
def cells_to_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [("info", "name"), ("info", "segment"), ("info", "balance")]
    return cells.cells_to_wide(_cells(spark, sf_dir), columns)


@query(
    "latest_cells",
    f"""
    SELECT row_key, family, qualifier, arg_max("value", version) AS "value", max(version) AS version
    FROM ({CELLS}) GROUP BY row_key, family, qualifier
    """,
)
def latest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.latest_cells(_cells(spark, sf_dir))


@query("row_key_count", "SELECT count(DISTINCT c_custkey) AS row_keys FROM customer")
def row_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.count_row_keys(_cells(spark, sf_dir))


@query(
    "cell_lines",
    f"""
    SELECT row_key, family || ':' || qualifier || ' = ' || arg_max("value", version)
           || ', version -> ' || max(version) AS line
    FROM ({CELLS}) WHERE row_key IN (SELECT DISTINCT c_custkey::VARCHAR AS k FROM customer ORDER BY k LIMIT 5)
    GROUP BY row_key, family, qualifier
    """,
)
def cell_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.cell_lines(_cells(spark, sf_dir))


@query(
    "cell_lines_sorted",
    f"""
    SELECT row_key, family || ':' || qualifier || ' = ' || arg_max("value", version)
           || ', version -> ' || max(version) AS line
    FROM ({CELLS}) WHERE row_key IN (SELECT DISTINCT c_custkey::VARCHAR AS k FROM customer ORDER BY k LIMIT 5)
    GROUP BY row_key, family, qualifier
    """,
)
def cell_lines_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From cells stored in key order: only the files of the first keys are opened."""
    stored = cells.SortedCells(spark, workspace(spark, "cells")).write(_cells(spark, sf_dir), 16)
    return cells.cell_lines(stored.first_rows(5))


@query(
    "upsert_latest",
    """
    WITH base AS (SELECT c_custkey AS k, c_mktsegment AS label, 0::BIGINT AS version FROM customer),
    updates AS (SELECT o_custkey AS k, o_orderpriority AS label, o_orderkey AS version FROM orders),
    newest AS (SELECT k, arg_max(label, version) AS label, max(version) AS version FROM updates GROUP BY k)
    SELECT * FROM base WHERE k NOT IN (SELECT k FROM newest) UNION ALL SELECT * FROM newest
    """,
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = inputs.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("label"), F.lit(0).cast("bigint").alias("version")
    )
    updates = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("label"), F.col("o_orderkey").alias("version")
    )
    return upsert.upsert(base, updates, ["k"], "version")


# --- user functions -----------------------------------------------------------------------------------

LOWER = "SELECT c_name, lower(trim(c_name)) AS name FROM customer"
AVERAGE = "sum(floor(c_acctbal)::BIGINT)::DOUBLE / count(*) AS avg_balance"


@query("udf_sql", LOWER)
def udf_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    user_functions.register_to_lower(spark)
    customers = inputs.table(spark, sf_dir, "customer")
    return spark.sql("SELECT c_name, to_lower(c_name) AS name FROM {customers}", customers=customers)


@query("udf_dsl", LOWER)
def udf_dsl(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = inputs.table(spark, sf_dir, "customer")
    return customers.select("c_name", user_functions.to_lower(F.col("c_name")).alias("name"))


@query("udf_arrow", LOWER)
def udf_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = inputs.table(spark, sf_dir, "customer")
    return customers.select("c_name", user_functions.to_lower_arrow("c_name").alias("name"))


def _balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "customer").select(
        "c_mktsegment", F.floor("c_acctbal").cast("bigint").alias("balance")
    )


@query("udaf_avg", f"SELECT {AVERAGE} FROM customer")
def udaf_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _balances(spark, sf_dir).agg(user_functions.average(F.col("balance")).alias("avg_balance"))


@query("udaf_avg_grouped", f"SELECT c_mktsegment, {AVERAGE} FROM customer GROUP BY c_mktsegment")
def udaf_avg_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    average = user_functions.average(F.col("balance")).alias("avg_balance")
    return _balances(spark, sf_dir).groupBy("c_mktsegment").agg(average)


@query("udaf_avg_arrow", f"SELECT c_mktsegment, {AVERAGE} FROM customer GROUP BY c_mktsegment")
def udaf_avg_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_functions.average_arrow(_balances(spark, sf_dir), ["c_mktsegment"], "balance", "avg_balance")


TOP = 3


@query("udaf_buffers_avg", f"SELECT c_mktsegment, {AVERAGE} FROM customer GROUP BY c_mktsegment")
def udaf_buffers_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The average with a user's own buffers, merged in a tree."""
    return aggregators.aggregate(_balances(spark, sf_dir), ["c_mktsegment"], "balance", aggregators.LongAverage(), "avg_balance")


@query(
    "udaf_buffers_product",
    """
    SELECT l_returnflag, l_linestatus, list_reduce(list(l_quantity::BIGINT), lambda a, b: a * b % 1000003) AS product
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def udaf_buffers_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantities = inputs.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("bigint").alias("quantity"))
    return aggregators.aggregate(quantities, ["l_returnflag", "l_linestatus"], "quantity", aggregators.Product(1_000_003), "product")


@query(
    "udaf_buffers_top",
    f"SELECT o_orderpriority, list_sort(list((o_totalprice * 100)::BIGINT), 'DESC')[1:{TOP}] AS cents FROM orders GROUP BY o_orderpriority",
)
def udaf_buffers_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = inputs.table(spark, sf_dir, "orders").select("o_orderpriority", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    return aggregators.aggregate(prices, ["o_orderpriority"], "cents", aggregators.TopValues(TOP), "cents")


# --- partitions and local data -----------------------------------------------------------------------------


LINES = 7


@query("partition_counts", "SELECT l_linenumber - 1 AS partition_id, count(*) AS cnt FROM lineitem GROUP BY l_linenumber")
def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition, of rows that were dealt to stated ones."""
    lines = inputs.table(spark, sf_dir, "lineitem").select((F.col("l_linenumber") - 1).cast("int").alias("n"))
    return partitions.partition_counts(partitions.in_partitions(lines, F.col("n"), LINES))


@query("observed_write", "SELECT l_linenumber - 1 AS partition_id, count(*) AS cnt FROM lineitem WHERE l_discount <= 0.08 GROUP BY l_linenumber")
def observed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts, made by the write itself; lines with a great discount are rejected."""
    lines = inputs.table(spark, sf_dir, "lineitem").select((F.col("l_linenumber") - 1).cast("int").alias("n"), "l_discount")
    dealt = partitions.in_partitions(lines, F.col("n"), LINES)
    counted = partitions.Counted(dealt, F.col("l_discount") > 0.08, LINES).write(workspace(spark, "observed"))
    rows = [(n, cnt) for n, cnt in enumerate(counted.per_partition) if cnt]
    return spark.createDataFrame(rows, "partition_id int, cnt long")


SIDES_SQL = """
    SELECT CASE WHEN c_custkey IS NULL THEN 'left' WHEN o_orderkey IS NULL THEN 'right' ELSE 'both' END AS side,
           count(*) AS cnt, sum(o_orderkey)::BIGINT AS orders, sum(c_custkey)::BIGINT AS customers
    FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 10 = 1 THEN -o_custkey ELSE o_custkey END AS k, o_orderkey FROM orders)
    FULL JOIN customer ON c_custkey = k GROUP BY side
"""


@query("matched_sides", SIDES_SQL)
def matched_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customers: those that meet, and those of either side that do not. A third of the orders have one customer."""
    own, key = F.col("o_custkey"), F.col("o_orderkey")
    orders_of = inputs.table(spark, sf_dir, "orders").select(
        F.when(key % 3 == 0, F.lit(1)).when(key % 10 == 1, -own).otherwise(own).alias("k"), "o_orderkey"
    )
    customers = inputs.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    found = matching.matched_sides(orders_of, customers, ["k"], hot=1000)
    return found.groupBy("side").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("left.o_orderkey").alias("orders"), F.sum("right.k").alias("customers")
    )


@query(
    "local_range",
    "SELECT n AS id, count(o_orderkey) AS cnt FROM range(0, 7) AS r(n) LEFT JOIN orders ON o_orderkey % 7 = n GROUP BY n",
)
def local_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = files.local_range(spark, 0, 6, 2)
    keys = inputs.table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 7).alias("id"), F.lit(1).alias("one"))
    return numbers.join(keys.groupBy("id").agg(F.count("one").alias("cnt")), "id", "left").fillna(0, ["cnt"])


RANKS = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]


@query(
    "local_rows",
    f"""
    SELECT rank, count(*) AS cnt FROM orders
    JOIN (VALUES {", ".join(map(str, RANKS))}) AS r(priority, rank) ON o_orderpriority = priority GROUP BY rank
    """,
)
def local_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = files.local_rows(spark, RANKS, "priority string, rank int")
    orders_of = inputs.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"))
    return aggregates.keyed_count(orders_of.join(ranks, "priority"), ["rank"])
