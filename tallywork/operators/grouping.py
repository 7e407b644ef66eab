"""Subtotals on several grouping levels.

A plain `rollup` or `cube` multiplies every input row by the number of levels
before its first aggregation. Measures that can be merged are first aggregated
to the finest level here, and only the reduced rows are multiplied. A measure
states how: counts and sums add up, extremes take the extreme, averages come
from a sum and a count. Distinct counts are bitmaps over dense numbers, which
levels and windows join by `or`. Any other aggregate, given as a plain column,
goes through Spark's own grouping, and with it the measures beside it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.operators import bitmaps


@dataclass(frozen=True)
class Measure:
    """An aggregate in two steps.

    `parts` are aggregates over the input rows; `merge` gets as many columns,
    which hold the parts of finer groups, and aggregates them to the result.
    """

    parts: tuple[Column, ...]
    merge: Callable[..., Column]


@dataclass(frozen=True)
class Distinct:
    """The number of distinct values of a column; null is none.

    With `dense` the column itself holds numbers from zero on, close together.
    """

    column: str
    dense: bool = False


Measures = dict[str, "Measure | Distinct | Column"]


def count_rows() -> Measure:
    """The number of rows; none on empty input is 0."""
    return Measure((F.count(F.lit(1)),), lambda part: F.coalesce(F.sum(part), F.lit(0)))


def count_of(column: str) -> Measure:
    """The number of values that are not null."""
    return Measure((F.count(column),), lambda part: F.coalesce(F.sum(part), F.lit(0)))


def total(column: str) -> Measure:
    return Measure((F.sum(column),), F.sum)


def lowest(column: str) -> Measure:
    return Measure((F.min(column),), F.min)


def highest(column: str) -> Measure:
    return Measure((F.max(column),), F.max)


def average(column: str) -> Measure:
    """The mean as a double; null if there is no value."""
    return Measure(
        (F.sum(column), F.count(column)),
        lambda sums, counts: F.try_divide(F.sum(sums).cast("double"), F.sum(counts).cast("double")),
    )


def distinct_of(column: str, dense: bool = False) -> Distinct:
    return Distinct(column, dense)


def _level() -> Column:
    return F.grouping_id().cast("bigint").alias("level_id")


def _parts(measures: Measures) -> dict[str, list[str]] | None:
    """Names of the columns that hold each measure's parts; None if one cannot be merged."""
    if not all(isinstance(measure, Measure) for measure in measures.values()):
        return None
    return {name: [f"_{name}_{n}" for n in range(len(measure.parts))] for name, measure in measures.items()}


def _finest(df: DataFrame, keys: list[str], measures: Measures) -> DataFrame:
    parts = _parts(measures)
    columns = [part.alias(held) for name in measures for part, held in zip(measures[name].parts, parts[name])]
    return df.groupBy(*keys).agg(*columns)


def _merged(measures: Measures) -> list[Column]:
    parts = _parts(measures)
    return [measure.merge(*map(F.col, parts[name])).alias(name) for name, measure in measures.items()]


def _whole(measures: Measures) -> list[Column]:
    """The measures over input rows, for Spark's own grouping."""
    def aggregate(measure: Measure | Column) -> Column:
        if isinstance(measure, Column):
            return measure
        if len(measure.parts) == 1:
            return measure.parts[0]
        sums, counts = measure.parts
        return F.try_divide(sums.cast("double"), counts.cast("double"))

    return [aggregate(measure).alias(name) for name, measure in measures.items()]


def _distinct(df: DataFrame, keys: list[str], name: str, measure: Distinct, sets: list[list[str]]) -> DataFrame:
    """A distinct count on the given levels: only bitmaps of the finest level are multiplied.

    The bucket of a bitmap is a key of every level, so it is the last bit of the
    level's number and always 0.
    """
    numbered = (df.withColumn("_id", F.col(measure.column)) if measure.dense else bitmaps.numbered(df, measure.column, "_id"))
    parts = bitmaps.parts(numbered, keys, "_id")
    levels = parts.groupingSets([[*map(F.col, level), F.col("_bucket")] for level in sets], *keys, "_bucket")
    merged = levels.agg(F.bitmap_or_agg("_bits").alias("_bits"), F.shiftright(F.grouping_id(), 1).cast("bigint").alias("level_id"))
    counts = bitmaps.counts(merged, [*keys, "level_id"], name)
    if [] not in sets:
        return counts
    # Spark gives the grand total of no rows, but not when a bucket is a key beside it.
    none = [F.lit(None).cast(df.schema[key].dataType).alias(key) for key in keys]
    total = bitmaps.counts(merged.filter(F.col("level_id") == 2 ** len(keys) - 1), [], name).select(*none, F.lit(2 ** len(keys) - 1).cast("bigint").alias("level_id"), name)
    return counts.filter(F.col("level_id") != 2 ** len(keys) - 1).unionByName(total)


def _grouped(df: DataFrame, keys: list[str], measures: Measures, levels: Callable, sets: list[list[str]]) -> DataFrame:
    distinct = {name: measure for name, measure in measures.items() if isinstance(measure, Distinct)}
    rest = {name: measure for name, measure in measures.items() if name not in distinct}
    if distinct:
        tables = [_distinct(df, keys, name, measure, sets) for name, measure in distinct.items()]
        tables += [_grouped(df, keys, rest, levels, sets)] if rest else []
        return reduce(lambda one, other: _beside(one, other, keys), tables).select(*keys, *measures, "level_id")
    if _parts(measures) is None:
        return levels(df).agg(*_whole(measures), _level())
    return levels(_finest(df, keys, measures)).agg(*_merged(measures), _level())


def _beside(one: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Two results on the same levels in one; keys are null outside their level."""
    by = [*keys, "level_id"]
    other = other.withColumnsRenamed({name: f"_other_{name}" for name in by})
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_other_{name}")) for name in by])
    return one.join(other, same).drop(*[f"_other_{name}" for name in by])


def grouping_sets(
    df: DataFrame, keys: list[str], sets: list[list[str]], measures: Measures
) -> DataFrame:
    """Chosen levels; a key outside a level is null, `level_id` tells it from a real null."""
    columns = [[F.col(name) for name in level] for level in sets]
    return _grouped(df, keys, measures, lambda rows: rows.groupingSets(columns, *keys), sets)


def rollup(df: DataFrame, keys: list[str], measures: Measures) -> DataFrame:
    """Every prefix of the keys, down to the grand total."""
    return _grouped(df, keys, measures, lambda rows: rows.rollup(*keys), [keys[:n] for n in range(len(keys), -1, -1)])


def cube(df: DataFrame, keys: list[str], measures: Measures) -> DataFrame:
    """Every subset of the keys."""
    subsets = [[key for n, key in enumerate(keys) if chosen >> n & 1] for chosen in range(2 ** len(keys))]
    return _grouped(df, keys, measures, lambda rows: rows.cube(*keys), subsets)


def subtotals_union(df: DataFrame, keys: list[str], measures: Measures) -> DataFrame:
    """Rollup levels stacked by `UNION ALL`, with `''` where a level has no key.

    Measures that can be merged share the finest aggregation, which Spark
    computes once; others aggregate the input per level.
    """
    mergeable = _parts(measures) is not None
    rows = _finest(df, keys, measures) if mergeable else df
    columns = _merged(measures) if mergeable else _whole(measures)

    def level(depth: int) -> DataFrame:
        kept = keys[:depth]
        blanks = [F.lit("").alias(name) for name in keys[depth:]]
        return rows.groupBy(*kept).agg(*columns).select(*kept, *blanks, *measures)

    return reduce(DataFrame.unionByName, [level(depth) for depth in range(len(keys) + 1)])


def in_key_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """Ascending by all keys, nulls first."""
    return df.orderBy(*[F.asc_nulls_first(key) for key in keys])
