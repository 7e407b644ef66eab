"""A full join that tells which rows have met, with frequent keys spread over tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT = 1_000_000  # rows of one key on the left side that one task joins


def _structs(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.select(*[F.col(key).alias(f"_{name}_{key}") for key in keys], F.struct("*").alias(name))


def matched_sides(left: DataFrame, right: DataFrame, keys: list[str], hot: int = HOT) -> DataFrame:
    """Rows of a full join as `left`, `right` and `side`, which is `both`, `left` or `right`.

    A null key meets nothing. Rows per key of the left side are counted first. A
    key with over `hot` rows is cut into as many lanes as it takes: its left rows
    are dealt to the lanes, its right rows are copied into each, which the right
    side should have few of. Copies could look unmatched in a lane, so the rows
    that the right side has alone come from a join with the left side's keys.
    """
    frequent = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot)
    lanes = F.ceil(F.col("_n") / hot).cast("int")
    # One row for each `hot` rows of the left side at most.
    frequent = frequent.select(*[F.col(key).alias(f"_hot_{key}") for key in keys], lanes.alias("_lanes"))

    def with_lanes(side: DataFrame, name: str) -> DataFrame:
        same = reduce(Column.__and__, [F.col(f"_{name}_{key}") == F.col(f"_hot_{key}") for key in keys])
        joined = side.join(frequent, same, "left").withColumn("_lanes", F.coalesce("_lanes", F.lit(1)))
        return joined.drop(*[f"_hot_{key}" for key in keys])

    ones = with_lanes(_structs(left, keys, "left"), "left")
    ones = ones.withColumn("_lane", F.pmod(F.xxhash64("left"), F.col("_lanes")).cast("int")).drop("_lanes")
    others = with_lanes(_structs(right, keys, "right"), "right")
    copies = others.withColumn("_right_lane", F.explode(F.sequence(F.lit(0), F.col("_lanes") - 1))).drop("_lanes")
    same = reduce(Column.__and__, [F.col(f"_left_{key}") == F.col(f"_right_{key}") for key in keys])
    met = ones.join(copies, same & (F.col("_lane") == F.col("_right_lane")), "left")
    met = met.select("left", "right", F.when(F.col("right").isNull(), F.lit("left")).otherwise(F.lit("both")).alias("side"))
    alone = _structs(right, keys, "right").join(left.select(*[F.col(key).alias(f"_left_{key}") for key in keys]).distinct(), same, "left_anti")
    nothing = F.lit(None).cast(met.schema["left"].dataType)
    return met.unionByName(alone.select(nothing.alias("left"), "right", F.lit("right").alias("side")))
