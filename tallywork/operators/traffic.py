"""Page views, unique visitors and referrers of a web access log.

Input is the frame of `records.access_log`: `ip`, `url`, `referrer`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.text import non_blank


def page_views(log: DataFrame) -> DataFrame:
    """Requests with a non-blank url."""
    return log.where(non_blank(F.col("url"))).agg(F.count(F.lit(1)).alias("pv"))


def visitors(log: DataFrame) -> DataFrame:
    """Distinct non-blank addresses."""
    return log.where(non_blank(F.col("ip"))).select("ip").distinct()


def unique_visitors(log: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct visitors; `approximate` trades exactness for one small sketch."""
    rows = log.where(non_blank(F.col("ip")))
    count = F.approx_count_distinct("ip") if approximate else F.count_distinct("ip")
    return rows.agg(count.alias("uv"))


def top_referrers(log: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent non-blank referrers; ties in name order."""
    counts = log.where(non_blank(F.col("referrer"))).groupBy("referrer").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), F.asc("referrer")).limit(n)


def traffic_report(log: DataFrame, n: int = 10) -> DataFrame:
    """All three results from one pass over the log, as `(metric, item, cnt)`.

    Instead of caching the parsed log for three jobs, every row contributes two
    keys, its address and its referrer, to one keyed sum. Both result branches
    read that sum's shuffle output. They use no filter below their own
    aggregate or limit: one would be pushed into the scan and split the plan
    into two passes again.
    """
    hit = non_blank(F.col("url")).cast("bigint")
    contributions = F.array(
        F.struct(F.lit(True).alias("by_ip"), F.col("ip").alias("item"), hit.alias("n")),
        F.struct(F.lit(False).alias("by_ip"), F.col("referrer").alias("item"), F.lit(1).cast("bigint").alias("n")),
    )
    sums = (
        log.select(F.inline(contributions))
        .groupBy("by_ip", "item")
        .agg(F.sum("n").alias("n"))
    )
    totals = sums.agg(
        F.coalesce(F.sum(F.when(F.col("by_ip"), F.col("n"))), F.lit(0)).alias("pv"),
        F.count_if(F.col("by_ip") & non_blank(F.col("item"))).alias("uv"),
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("pv").alias("metric"), F.lit("").alias("item"), F.col("pv").alias("cnt")),
                F.struct(F.lit("uv").alias("metric"), F.lit("").alias("item"), F.col("uv").alias("cnt")),
            )
        )
    )
    is_referrer = ~F.col("by_ip") & non_blank(F.col("item"))
    ranked = sums.orderBy(F.when(is_referrer, F.col("n")).desc_nulls_last(), F.asc("item")).limit(n)
    referrers = ranked.where(is_referrer).select(
        F.lit("referrer").alias("metric"), "item", F.col("n").alias("cnt")
    )
    return totals.unionByName(referrers)
