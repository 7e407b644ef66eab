"""Versioned cells: a sparse wide table kept as one row per cell and version.

Columns: `row_key`, `family`, `qualifier`, `value` (text), `version` (long).
Putting a cell again adds a newer version; reading takes the latest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = ("row_key", "family", "qualifier", "version")


def wide_to_cells(wide: DataFrame, row_key: str, family: str, version: Column) -> DataFrame:
    """Every non-null column but the row key becomes a cell of `family`, as text."""
    key = F.col(row_key).cast("string").alias("row_key")
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("qualifier"), F.col(name).cast("string").alias("value"))
            for name in wide.columns
            if name != row_key
        ]
    )
    rows = wide.select(key, version.cast("bigint").alias("version"), F.inline(cells))
    return rows.where(F.col("value").isNotNull()).select(
        "row_key", F.lit(family).alias("family"), "qualifier", "value", "version"
    )


def latest_cells(cells: DataFrame) -> DataFrame:
    """The newest version of each cell; equal versions are settled by the greater value."""
    newest = F.max(F.struct("version", "value"))
    return (
        cells.groupBy("row_key", "family", "qualifier")
        .agg(newest.alias("newest"))
        .select("row_key", "family", "qualifier", "newest.value", "newest.version")
    )


def cells_to_wide(cells: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """One row per row key with the latest value of each `(family, qualifier)`.

    Picking the latest and pivoting are one grouped aggregate, hence one shuffle.
    Columns are named by the caller, so no extra job has to find them.
    """

    def latest(family: str, qualifier: str) -> Column:
        mine = (F.col("family") == family) & (F.col("qualifier") == qualifier)
        newest = F.max(F.when(mine, F.struct("version", "value")))
        return newest.getField("value").alias(f"{family}_{qualifier}")

    return cells.groupBy("row_key").agg(*[latest(*column) for column in columns])


def count_row_keys(cells: DataFrame) -> DataFrame:
    """Number of distinct row keys."""
    return cells.agg(F.count_distinct("row_key").alias("row_keys"))


class SortedCells:
    """Cells stored in row-key order below `path`, with a list of each file's first and last key.

    Files are ranges of (row key, family, qualifier, version), so a row with very
    many cells spans several. A scan of a key range, or of the first few keys,
    opens the files that hold them and no others; in a file, row groups are
    skipped by their statistics.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def write(self, cells: DataFrame, files: int) -> SortedCells:
        ranges = cells.repartitionByRange(files, *ORDER).sortWithinPartitions(*ORDER)
        ranges.write.parquet(f"{self.path}/cells")
        stored = self.spark.read.schema(cells.schema).parquet(f"{self.path}/cells")
        keys = stored.select(F.col("_metadata.file_name").alias("file"), "row_key").groupBy("file", "row_key").agg(F.lit(1).alias("one"))
        index = keys.groupBy("file").agg(F.min("row_key").alias("first"), F.max("row_key").alias("last"), F.count("row_key").alias("keys"))
        index.coalesce(1).write.parquet(f"{self.path}/index")
        return self

    def _read(self, index: list) -> DataFrame:
        every = self.spark.read.parquet(f"{self.path}/cells")
        return self.spark.read.schema(every.schema).parquet(*[f"{self.path}/cells/{row['file']}" for row in index]) if index else every.limit(0)

    def _index(self) -> list:
        """One entry per file, in key order."""
        return self.spark.read.parquet(f"{self.path}/index").where("last IS NOT NULL").orderBy("first", "last").collect()

    def scan(self, low: str, high: str) -> DataFrame:
        """All cells of the row keys from `low` to `high`, both included."""
        found = [row for row in self._index() if row["first"] <= high and row["last"] >= low]
        return self._read(found).where(F.col("row_key").between(low, high))

    def first_rows(self, n: int) -> DataFrame:
        """All cells of the first `n` row keys."""
        found, keys, last = [], 0, None
        for row in self._index():
            if keys >= n and row["first"] > last:  # a key may go on in the next file
                break
            keys += row["keys"] - (row["first"] == last)
            last = row["last"]
            found.append(row)
        cells = self._read(found)
        return cells.join(F.broadcast(cells.select("row_key").distinct().orderBy("row_key").limit(n)), "row_key", "left_semi")


def cell_lines(cells: DataFrame, rows: int = 5) -> DataFrame:
    """The latest cells of the first few row keys, one printable line per cell.

    The cells are read once. A row key's latest cells, which are as many as the
    table has columns, are gathered before the first keys are taken.
    """
    line = F.concat(
        F.col("family"), F.lit(":"), F.col("qualifier"), F.lit(" = "), F.col("value"),
        F.lit(", version -> "), F.col("version").cast("string"),
    )
    per_key = latest_cells(cells).groupBy("row_key").agg(F.collect_list(line).alias("lines"))
    return per_key.orderBy("row_key").limit(rows).select("row_key", F.explode("lines").alias("line"))
