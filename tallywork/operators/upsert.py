"""Insert-or-replace by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the greatest `order` per key; ties go to the greatest row."""
    rest = [name for name in rows.columns if name not in keys and name != order]
    newest = F.max(F.struct(order, *rest)).alias("newest")
    picked = rows.groupBy(*keys).agg(newest).select(*keys, "newest.*")
    return picked.select(*rows.columns)


def upsert(base: DataFrame, updates: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The base with the last update of every key in place of its row, or added.

    The last update per key wins whatever the base holds. A null key is a key
    like any other. The base has one row per key. Each side is read once: only
    updates are grouped, and one full join tells which rows stay.
    """
    last = latest_per_key(updates, keys, order)
    old = base.select(F.struct(*base.columns).alias("_old"))
    new = last.select(F.struct(*base.columns).alias("_new"))
    same = reduce(Column.__and__, [F.col(f"_old.{key}").eqNullSafe(F.col(f"_new.{key}")) for key in keys])
    return old.join(new, same, "full").select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")
