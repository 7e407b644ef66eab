"""Order statistics by province; input is the frame of `records.parse_orders`.

Both functions take batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def province_amount(orders: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Sales amount per province."""
    return orders.groupBy(*keep, "province_id").agg(F.sum("order_price").alias("amount"))


def province_count(orders: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Orders per province."""
    return orders.groupBy(*keep, "province_id").agg(F.count(F.lit(1)).alias("cnt"))
