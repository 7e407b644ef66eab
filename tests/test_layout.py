"""How rows are laid out and counted on the way: partitions, observed writes, sorted cells, bucketed tables, spread joins."""

from __future__ import annotations

import random
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rows import final_plan, rows
from tallywork.operators import cells, matching, partitions, ratings
from tallywork.sources import catalog
from tallywork.sources.streams import stream_lines
from tallywork.streaming import outputs
from tallywork.streaming.runner import read_batches, run_available, settings, to_batch_dirs, workspace


def jobs(spark, group):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


# --- partitions and counts


def test_rows_lie_in_the_stated_partitions(spark):
    df = spark.createDataFrame([(n % 3,) for n in range(10)], "n int")
    dealt = partitions.in_partitions(df, F.col("n"), 5)
    assert rows(partitions.partition_counts(dealt)) == [(0, 4), (1, 3), (2, 3)]
    assert dealt.filter(F.spark_partition_id() != F.col("n")).count() == 0
    for wrong in (None, 5, -1):
        with pytest.raises(Exception, match="no such partition"):
            partitions.in_partitions(spark.createDataFrame([(wrong,)], "n int"), F.col("n"), 5).collect()


def test_a_write_counts_in_one_job(spark, tmp_path):
    df = spark.range(0, 100, numPartitions=4).select(F.col("id"), F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 7).alias("v"))
    counted = partitions.Counted(df, F.col("v").isNull() | (F.col("v") == 3), 4)
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "write")
    counted.write(str(tmp_path / "out"))
    wanted = df.filter("v <> 3")
    assert jobs(spark, group) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (counted.rows, counted.rejected) == (wanted.count(), 100 - wanted.count())
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.columns == ["id", "v"] and rows(stored) == rows(wanted)
    by_file = rows(stored.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count(F.lit(1)).alias("n")))
    assert [n for _, n in by_file] == counted.per_partition
    nothing = partitions.Counted(df.limit(0), None, 2).write(str(tmp_path / "none"))
    assert (nothing.rows, nothing.rejected, nothing.per_partition) == (0, 0, [0, 0])


# --- cells in key order


def test_sorted_cells_open_few_files(spark):
    rng = random.Random(4)
    data = [(f"row{n % 300:04d}", "f", f"q{rng.randrange(4)}", f"v{n}", n) for n in range(6000)]
    data += [("row0002", "f", f"wide{n}", "x", n) for n in range(3000)]  # one row with a third of the cells
    table = spark.createDataFrame(data, "row_key string, family string, qualifier string, value string, version long")
    stored = cells.SortedCells(spark, workspace(spark, "cells")).write(table, 40)

    def opened(frame):
        return frame.select(F.col("_metadata.file_name")).distinct().count()

    assert rows(stored.first_rows(1)) == rows(table.filter("row_key = 'row0000'"))
    assert opened(stored._read([row for row in stored._index() if row["first"] <= "row0000"])) <= 4
    for low, high in (("row0100", "row0103"), ("row0002", "row0002"), ("a", "b"), ("row0299", "z")):
        found = stored.scan(low, high)
        assert rows(found) == rows(table.filter(F.col("row_key").between(low, high)))
    assert opened(stored.scan("row0100", "row0103")) <= 4
    for n in (3, 5, 400):
        assert rows(cells.cell_lines(stored.first_rows(n), n)) == rows(cells.cell_lines(table, n))
    assert opened(stored._read(stored._index())) >= 35


def test_sorted_cells_of_nothing(spark):
    none = spark.createDataFrame([], "row_key string, family string, qualifier string, value string, version long")
    stored = cells.SortedCells(spark, workspace(spark, "cells")).write(none, 4)
    assert stored.first_rows(5).count() == 0 and stored.scan("a", "z").count() == 0


# --- bucketed tables


def test_bucketed_tables_join_and_group_without_an_exchange(spark):
    home, names = workspace(spark, "bucketed"), [f"t_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    one = spark.range(2000).select((F.col("id") % 97).alias("k"), F.col("id").alias("a"))
    other = spark.range(97).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b"))
    for name, table in zip(names, (one, other)):
        catalog.save_bucketed(table, name, ["k"], 4, f"{home}/{name}")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        joined = catalog.read_table(spark, names[0]).join(catalog.read_table(spark, names[1]), "k")
        sums = joined.groupBy("k").agg(F.sum("a").alias("a"), F.max("b").alias("b"))
        assert rows(sums) == rows(one.join(other, "k").groupBy("k").agg(F.sum("a").alias("a"), F.max("b").alias("b")))
        assert "Exchange" not in final_plan(sums) and "SortMergeJoin" in final_plan(sums)
    for name in names:
        catalog.drop_table(spark, name)
    assert len(list(Path(f"{home}/{names[0]}".removeprefix("file://")).glob("*.parquet"))) == 4


# --- joins that tell the sides apart


@pytest.mark.parametrize("hot", [1, 40, 10**6])
def test_matched_sides_equal_a_full_join(spark, hot):
    rng = random.Random(hot)
    left = [(rng.choice([None, 1, 1, 1, 2, 3, 50]), n) for n in range(200)]
    right = [(rng.choice([None, 1, 2, 3, 60, 61]), f"r{n}") for n in range(12)]
    found = matching.matched_sides(spark.createDataFrame(left, "k int, a int"), spark.createDataFrame(right, "k int, b string"), ["k"], hot)
    wanted = [(one, other, "both") for one in left for other in right if one[0] is not None and one[0] == other[0]]
    wanted += [(one, None, "left") for one in left if one[0] is None or one[0] not in {key for key, _ in right}]
    wanted += [(None, other, "right") for other in right if other[0] is None or other[0] not in {key for key, _ in left}]
    got = [(each["left"] and tuple(each["left"]), each["right"] and tuple(each["right"]), each["side"]) for each in found.collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_a_hot_key_is_spread(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 10 < 3, 7).otherwise(F.col("id") + 100).cast("long").alias("k"), "id")
    right = spark.createDataFrame([(7, "x")], "k long, b string")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        found = matching.matched_sides(left, right, ["k"], hot=100).filter("side = 'both'")
        assert found.count() == 900
        assert found.select(F.spark_partition_id()).distinct().count() > 1


# --- statements and caps


def test_upserts_in_the_databases_dialect(monkeypatch, spark):
    seen = []
    monkeypatch.setattr("tallywork.sources.jdbc._execute", lambda spark, url, properties, statement: seen.append(statement))
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", lambda *args, **names: None)
    batch = spark.createDataFrame([("a", 1)], "word string, cnt int")
    for dialect, part in (("mysql", "ON DUPLICATE KEY UPDATE"), ("postgresql", "ON CONFLICT (word)"), ("standard", "MERGE INTO")):
        outputs.jdbc_upsert_action("url", "counts", "counts_new", ["word"], {}, dialect)(batch, 0)
        assert part in seen[-2] and seen[-1] == "DROP TABLE counts_new"


def test_batches_capped_by_bytes(spark, tmp_path):
    for n in range(4):
        (tmp_path / f"{n}.txt").write_text("x" * 1000 + "\n")
    home = workspace(spark, "bytes")
    run_available(stream_lines(spark, str(tmp_path), max_bytes="1500"), to_batch_dirs(f"{home}/out"), f"{home}/checkpoint")
    assert read_batches(spark, f"{home}/out").select("batch_id").distinct().count() == 4
    with pytest.raises(ValueError, match="files or by bytes"):
        stream_lines(spark, str(tmp_path), 1, "1k")


def test_having_names_the_alias(spark):
    films = spark.createDataFrame([(1, 3.0), (1, 4.0), (2, 5.0), (3, 1.0), (3, 2.0), (3, 3.0)], "movieId int, rating double")
    assert [tuple(row) for row in ratings.ratings_top_sql(films, more_than=1, n=5).collect()] == [(3, 3, 2.0), (1, 2, 3.5)]
