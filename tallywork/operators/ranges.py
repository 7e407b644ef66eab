"""Point-in-range lookup: which `[start, end]` holds an address, both ends included.

A join on BETWEEN alone compares every address with every range. Here ranges are
cut into pieces that lie in aligned blocks of addresses, with block sizes that
fit the pieces: a piece is at least as long as its block, so a block meets two
disjoint pieces at most. An address looks for its block on each level by an
equi-join; BETWEEN remains as a residual test on at most two candidates.

Ranges must be disjoint, so that an address has at most one match. This is
checked while the pieces are made and fails the job otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.network import ip_parts, parts_to_long
from tallywork.functions.text import computed_once

# Block sizes are 2**level addresses. Ranges are first cut at the largest block.
LEVELS = (16, 12, 8, 4, 0)
TOP = LEVELS[0]
# Probe rows of one address that one task should handle. The rows of an address
# with more are split, and the table of such addresses has one row per this many
# probe rows at most: 16 bytes each, 3 MB at 10**12 rows.
ROWS_PER_SPLIT = 5_000_000
HELPERS = ["_number", "_parts"]


def overlapping_ranges(ranges: DataFrame) -> DataFrame:
    """Parts of ranges, cut at the largest block, that start inside an earlier range."""
    cut = _cut(ranges)
    return cut.where(F.col("_covered") >= F.col("_piece_start")).select(*ranges.columns)


def _cut_at_top(ranges: DataFrame) -> DataFrame:
    """Ranges cut at the borders of the largest blocks."""
    first, last = F.shiftright("start_ip", TOP), F.shiftright("end_ip", TOP)
    cut = ranges.where(F.col("start_ip") <= F.col("end_ip")).withColumn(
        "_block", F.explode(F.sequence(first, last))
    )
    low = F.shiftleft("_block", TOP)
    return cut.withColumns(
        {
            "_piece_start": F.greatest("start_ip", low),
            "_piece_end": F.least("end_ip", low + ((1 << TOP) - 1)),
        }
    )


def _cut(ranges: DataFrame) -> DataFrame:
    """Cut ranges with the furthest end of the ranges before them in their block."""
    earlier = (
        Window.partitionBy("_block")
        .orderBy("_piece_start", "_piece_end")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return _cut_at_top(ranges).withColumn("_covered", F.max("_piece_end").over(earlier))


def _level() -> Column:
    """The largest level whose block is not longer than the piece."""
    length = F.col("_piece_end") - F.col("_piece_start") + 1
    level = F.lit(LEVELS[-1])
    for candidate in reversed(LEVELS[:-1]):
        level = F.when(length >= 1 << candidate, F.lit(candidate)).otherwise(level)
    return level


def _block_of(position: str, level: Column) -> Column:
    return F.call_function("shiftright", F.col(position), level)


def _key(block: Column, level: Column) -> Column:
    """Level and block number in one long, which Spark joins faster than two columns."""
    return F.shiftleft(block, 5).bitwiseOR(level.cast("bigint"))


def _pieces(ranges: DataFrame) -> DataFrame:
    """Pieces with their block key; reading them fails when two ranges overlap."""
    problem = F.concat(F.lit("overlapping range at "), F.col("_piece_start").cast("string"))
    overlaps = F.coalesce(F.col("_covered") >= F.col("_piece_start"), F.lit(False))
    start = F.when(overlaps, F.raise_error(problem).cast("bigint")).otherwise(F.col("_piece_start"))
    checked = _cut(ranges).withColumn("_piece_start", start).withColumn("_level", _level())
    level = F.col("_level")
    blocks = F.sequence(_block_of("_piece_start", level), _block_of("_piece_end", level))
    keyed = checked.withColumn("_block", F.explode(blocks)).withColumn("_key", _key(F.col("_block"), level))
    return keyed.drop("start_ip", "end_ip", "_block", "_covered", "_level")


def _numbered(probe: DataFrame, ip: str, strict: bool) -> DataFrame:
    split = computed_once(probe, "_parts", ip_parts(F.col(ip), strict))
    return computed_once(split, "_number", parts_to_long(F.col("_parts"))).drop("_parts")


def _located(counts: DataFrame, ranges: DataFrame) -> DataFrame:
    """Distinct addresses with the attributes of the range that holds them."""
    keys = [_key(F.shiftright("_number", level), F.lit(level)) for level in LEVELS]
    candidates = counts.withColumn("_key", F.explode(F.array(*keys))).join(_pieces(ranges), "_key")
    found = candidates.where(F.col("_number").between(F.col("_piece_start"), F.col("_piece_end")))
    return found.drop("_key", "_piece_start", "_piece_end")


def _address_counts(numbered: DataFrame) -> DataFrame:
    present = numbered.where(F.col("_number").isNotNull())
    return present.groupBy("_number").agg(F.count(F.lit(1)).alias("_hits"))


def range_lookup(
    probe: DataFrame,
    ranges: DataFrame,
    ip: str = "ip",
    *,
    spread_by: list[str] | None = None,
    rows_per_split: int = ROWS_PER_SPLIT,
    strict: bool = True,
) -> DataFrame:
    """Probe rows with the attributes of the range that holds their address.

    Unmatched rows are dropped, and an unreadable address fails the job, or is
    dropped if not strict. Each distinct address is located once; the largest
    block holds 2**16 addresses, so no join key is hot there, and Spark's own
    size estimate decides what is broadcast. The probe rows then fetch the
    result by their address. The rows of a frequent address are spread over
    several tasks by a hash of `spread_by`, all columns unless stated, and its
    one result row is repeated for each.
    """
    numbered = _numbered(probe, ip, strict)
    counts = _address_counts(numbered)
    splits = F.greatest(F.ceil(F.col("_hits") / rows_per_split), F.lit(1)).cast("bigint")
    busy = counts.where(F.col("_hits") > rows_per_split).select("_number", splits.alias("_splits"))
    salt = F.pmod(F.xxhash64(*(spread_by or probe.columns)), F.coalesce(F.col("_splits"), F.lit(1)))
    left = numbered.join(F.broadcast(busy), "_number", "left").withColumn("_salt", salt).drop("_splits")
    right = _located(counts, ranges).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), splits - 1))
    )
    return left.join(right.drop("_hits"), ["_number", "_salt"]).drop("_salt", *HELPERS)


def geo_heat(probe: DataFrame, ranges: DataFrame, ip: str = "ip", *, strict: bool = True) -> DataFrame:
    """Hits per `(longitude, latitude)`.

    Hits are first counted per address, and only the distinct addresses are located.
    """
    counts = _address_counts(_numbered(probe.select(ip), ip, strict))
    return _located(counts, ranges).groupBy("longitude", "latitude").agg(F.sum("_hits").alias("total_count"))
