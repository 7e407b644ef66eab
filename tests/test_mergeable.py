"""What is merged from parts: user aggregates, bitmaps, long windows, bucketed tables, day totals."""

from __future__ import annotations

import datetime
import math
import random
from collections import defaultdict
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rows import rows
from tallywork.functions import aggregators
from tallywork.operators import bitmaps, grouping
from tallywork.session import SETTINGS
from tallywork.streaming import outputs, totals, windows
from tallywork.streaming.buckets import BucketTable, bucket_table_action
from tallywork.streaming.runner import Arrivals, files_below, run_available, settings, start, workspace

# --- user aggregates


@pytest.fixture(scope="module")
def keyed(spark):
    """A key with 60 % of the rows, a null key, null values, a key without values; many small batches."""
    key = F.when(F.col("id") % 10 > 3, "hot").when(F.col("id") % 10 == 3, None).otherwise(F.concat(F.lit("k"), F.col("id") % 7))
    value = F.when((F.col("id") % 11 > 0) & ~F.coalesce(key == "k2", F.lit(False)), F.col("id") - 5000)
    return spark.range(0, 20_000, numPartitions=7).select(key.alias("k"), value.alias("v"), F.lit("x").alias("_lane"))


def by_key(keyed):
    found = defaultdict(list)
    for key, value, _ in keyed.collect():
        found[key].append(value)
    return found


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_aggregators_equal_brute_force(spark, keyed, rounds):
    wanted = by_key(keyed)

    def product(values):
        found = 1
        for value in values:
            found = found * value % 1009
        return found

    cases = [
        (aggregators.Average(), lambda values: sum(values) / len(values) if values else math.nan),
        (aggregators.LongAverage(), lambda values: sum(values) / len(values) if values else math.nan),
        (aggregators.Product(1009), product),
        (aggregators.TopValues(3), lambda values: sorted(values, reverse=True)[:3]),
    ]
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "97"}):
        for aggregator, by_hand in cases:
            found = dict(aggregators.aggregate(keyed, ["k"], "v", aggregator, "out", fan=3, rounds=rounds).collect())
            for key, values in wanted.items():
                expected = by_hand([value for value in values if value is not None])
                assert found[key] == pytest.approx(expected, nan_ok=True)
            assert len(found) == len(wanted)


def test_no_task_sees_all_buffers_of_a_hot_key(spark, keyed):
    """Every merge of one round has a share of the buffers only; sizes are told by an aggregate that counts its merges."""

    class Merges(aggregators.Aggregator):
        buffer, result = "sizes array<long>, merged long", "array<long>"

        def initialise(self):
            return [], 1

        def update(self, buffer, values):
            return [len(values)], 1

        def merge(self, one, other):
            return [*one[0], *other[0]], one[1] + 1

        def evaluate(self, buffer):
            return [buffer[1], len(buffer[0])]

    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "100"}):
        once = aggregators.aggregate(keyed.repartition(12), [], "v", Merges(), "out", rounds=1).first()["out"]
        tree = aggregators.aggregate(keyed.repartition(12), [], "v", Merges(), "out", fan=4, rounds=2).first()["out"]
    assert once[0] == once[1] >= 200 and tree[1] >= 200 and tree[0] < 70


def test_aggregate_of_nothing(spark):
    none = spark.createDataFrame([], "k string, v long")
    average = aggregators.Average()
    assert aggregators.aggregate(none, ["k"], "v", average, "out").collect() == []
    assert math.isnan(aggregators.aggregate(none, [], "v", average, "out").first()["out"])
    assert aggregators.aggregate(none, [], "v", aggregators.TopValues(2), "out").first()["out"] == []
    assert aggregators.TopValues(2).update(([9],), pa.array([1, None, 8, 7])) == ([9, 8],)


# --- bitmaps


@pytest.mark.parametrize("level", [grouping.cube, grouping.rollup])
def test_distinct_counts_on_levels_equal_sparks(spark, level):
    rng = random.Random(3)
    data = [(rng.choice(["a", None, "b"]), rng.randrange(3), rng.choice([None, 1.5, 2.5, -0.5, 7.25]), rng.choice([None, *range(70_000, 70_050)]))
            for _ in range(400)] + [("only null", 1, None, None)]
    df = spark.createDataFrame(data, "x string, y int, price double, number long").repartition(5)
    measures = {"prices": grouping.distinct_of("price"), "cnt": grouping.count_rows(), "numbers": grouping.distinct_of("number", dense=True)}
    plain = {"prices": F.count_distinct("price"), "cnt": F.count(F.lit(1)), "numbers": F.count_distinct("number")}
    found = level(df, ["x", "y"], measures)
    assert found.columns == ["x", "y", "prices", "cnt", "numbers", "level_id"]
    assert rows(found) == rows(level(df, ["x", "y"], plain).select(*found.columns))
    none = df.limit(0)
    assert rows(level(none, ["x", "y"], measures)) == rows(level(none, ["x", "y"], plain).select(*found.columns))


def test_distinct_counts_multiply_no_input_rows(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("x"), (F.col("id") % 2).alias("y"), F.col("id").alias("v"))
    found = grouping.cube(df, ["x", "y"], {"n": grouping.distinct_of("v", dense=True)})
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    expand = plan[plan.index("Expand"):]
    assert "bitmap_construct_agg" in expand  # below the Expand: it gets the finest bitmaps


def test_numbers_are_dense_and_repeatable(spark):
    df = spark.createDataFrame([(f"v{n % 500}",) for n in range(3000)] + [(None,)], "v string")
    first, again = (bitmaps.numbered(frame, "v", "n", classes=8).select("v", "n").distinct() for frame in (df, df.repartition(7)))
    assert rows(first) == rows(again)
    numbers = [each["n"] for each in first.collect() if each["v"] is not None]
    assert len(set(numbers)) == 500 and max(numbers) < 900


# --- long windows


@pytest.mark.parametrize("length", range(1, 40))
def test_pieces_cover_a_window_by_three(length):
    block = max(1, length // 2)
    for last in range(4 * length):
        first, covered = max(0, last - length + 1), []
        if length == 1:
            continue
        found = windows.pieces(first, last, block)
        assert len(found) <= 3
        for kind, number in found:
            start = number - number % block
            covered += range(start, number + 1) if kind == "prefix" else range(number, start + block)
            # Stored by now: a batch makes its prefix and one suffix of the block before.
            made = number if kind == "prefix" else (start + block) + (start + block - 1 - number)
            assert made <= last
        assert covered == list(range(first, last + 1))


@pytest.mark.parametrize(("length", "slide"), [(1, 1), (2, 1), (5, 1), (6, 2)])
def test_long_windows_of_extremes_and_sets(spark, length, slide):
    rng, home, merges = random.Random(length), workspace(spark, "long"), []
    batches = [[(rng.choice("ab"), rng.randrange(100)) for _ in range(rng.randrange(0, 5))] for _ in range(13)]

    def count(batch):
        return batch.groupBy("k").agg(F.max("v").alias("top"), F.collect_set("v").alias("all"))

    def merge(window):
        merges.append(1)
        return window.groupBy("k").agg(F.max("top").alias("top"), F.array_distinct(F.flatten(F.collect_list("all"))).alias("all"))

    action = windows.long_windows(f"{home}/p", f"{home}/o", count, merge, length, slide, lambda rows: rows.withColumn("all", F.size("all")))
    for number, batch in enumerate(batches):
        for _ in range(1 + (number == 7)):  # one is repeated
            merges.clear()
            action(spark.createDataFrame(batch, "k string, v int"), number)
            assert len(merges) <= 3
        if (number + 1) % slide:
            continue
        wanted = defaultdict(list)
        for key, value in sum(batches[max(0, number - length + 1) : number + 1], []):
            wanted[key].append(value)
        stored = spark.read.parquet(f"{home}/o/batch_id={number}")
        assert {each["k"]: (each["top"], each["all"]) for each in stored.collect()} == {k: (max(v), len(set(v))) for k, v in wanted.items()}
    kept = sum(len(files_below(spark, f"{home}/p/{kind}")) for kind in ("batch", "prefix", "suffix"))
    assert kept <= 3 * (2 * length + 2)


# --- tables in buckets


def stored_files(path):
    return {str(each): (each.stat().st_mtime_ns, each.stat().st_size) for each in Path(path.removeprefix("file://")).rglob("base/**/*.parquet")}


def test_changes_rewrite_only_their_buckets(spark):
    path = workspace(spark, "buckets")
    table = BucketTable(spark, path, ["k"], buckets=100, share=0.5)
    everything = spark.range(50_000).select(F.concat(F.lit("key"), "id").alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    table.commit(everything, 0)
    before = stored_files(path)
    total = sum(size for _, size in before.values())
    bucket = table._bucket()
    one = everything.filter(bucket == 17).withColumn("v", F.col("v") + 1_000_000)
    table.commit(one, 1)
    after = stored_files(path)
    new = {name: size for name, (_, size) in after.items() if name not in before}
    assert all("_bucket=17" in name for name in new) and 0.005 * total < sum(new.values()) < 0.015 * total
    assert all(after[name] == before[name] for name in before)
    # One in a hundred keys of every bucket: no base is written anew.
    table.commit(everything.filter(F.col("v") % 100 == 3).withColumn("v", -F.col("v")), 2)
    assert not [name for name in stored_files(path) if "batch_id=2" in name]
    assert not [name for name in stored_files(path) if "batch_id=0" in name and "_bucket=17" in name]  # of no use now
    wanted = everything.withColumn("v", F.when(F.col("v") % 100 == 3, -F.col("v")).when(bucket == 17, F.col("v") + 1_000_000).otherwise(F.col("v")))
    assert table.rows().exceptAll(wanted).count() == 0 and table.rows().count() == 50_000


def test_bucket_table_may_repeat_and_fail(spark):
    path, wanted = workspace(spark, "buckets"), {}
    table = BucketTable(spark, path, ["k"], buckets=3, share=0.4)
    for number in range(9):
        changes = {f"k{number % 4}": number, f"k{number}": number, None: number}
        frame = spark.createDataFrame(list(changes.items()), "k string, v int")
        before = dict(wanted)
        # A run that dies before the commit leaves files that nobody reads.
        table._write(frame.withColumn("v", F.lit(-1)), "changes", number, dealt=True)
        if number:
            assert dict(rows(table.rows())) == before
        wanted |= changes
        for _ in range(2):
            table.commit(frame, number, {"at": number})
            assert dict(rows(table.rows())) == wanted and table.note() == {"at": number}
    assert len(files_below(spark, f"{path}/state")) <= 3


def test_no_table_yet(spark):
    with pytest.raises(ValueError, match="no batch"):
        BucketTable(spark, workspace(spark, "none"), ["k"]).rows()


def test_rows_and_offsets_are_committed_together(spark):
    records = spark.createDataFrame([("t", 0, 5, "a"), ("t", 0, 6, "b"), ("t", 1, 2, "a")], "topic string, partition int, offset long, k string")
    table = BucketTable(spark, workspace(spark, "offsets"), ["k"], buckets=2)
    action = bucket_table_action(table, lambda batch: batch.groupBy("k").agg(F.count(F.lit(1)).alias("n")), outputs.offset_ranges)
    action(records, 0)
    assert sorted((each["partition"], each["from_offset"], each["until_offset"]) for each in table.note()) == [(0, 5, 7), (1, 2, 3)]
    assert rows(table.rows()) == [("a", 2), ("b", 1)]


# --- days


def test_a_days_state_ends_and_no_row_is_lost(spark):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("instant", T.TimestampType()), T.StructField("units", T.LongType())])
    arrivals, rng, wanted, kept = Arrivals(spark, "days", schema), random.Random(2), defaultdict(lambda: [0, 0]), []
    table = BucketTable(spark, arrivals.output, ["k", "day"], buckets=2)
    name = "spark.sql.streaming.stateStore.providerClass"
    with settings(spark, {name: SETTINGS[name], "spark.sql.shuffle.partitions": "2"}):
        for number in range(8):
            midnight = datetime.datetime(2024, 2, 25, tzinfo=datetime.timezone.utc) + datetime.timedelta(days=number)
            data = [(rng.choice("ab"), midnight + datetime.timedelta(minutes=rng.randrange(1440)), rng.randrange(50)) for _ in range(30)]
            if number in (4, 7):  # late by days, for a stored key and for a new one
                data += [("a", midnight - datetime.timedelta(days=3), 1000), ("late", midnight - datetime.timedelta(days=2), 7), ("a", midnight, None)]
            for key, instant, units in data:
                if units is not None:
                    held = wanted[key, int(instant.timestamp()) // 86400 * 86_400_000]
                    held[0], held[1] = held[0] + units, held[1] + 1
            arrivals.deliver(spark.createDataFrame(data, schema))
            query = start(totals.day_totals(arrivals.stream(), "instant", "k", "units", "1 hour"), totals.day_table_action(table),
                          arrivals.checkpoint, "update", {"availableNow": True})
            query.awaitTermination()
            operators = [one for progress in query.recentProgress for one in progress["stateOperators"]]
            assert sum(one["numRowsDroppedByWatermark"] for one in operators) == 0
            kept.append(max(one["numRowsTotal"] for one in operators))
    assert {(each["k"], each["day"]): [each["amount"], each["cnt"]] for each in table.rows().collect()} == dict(wanted)
    assert max(kept) <= kept[1] and len(wanted) >= 17  # as many days in the state as at the second day


def test_upserts_of_a_stream_by_buckets(spark, lines):
    arrivals = Arrivals(spark, "bucket-words", T.StructType([T.StructField("value", T.StringType())]))
    table = BucketTable(spark, arrivals.output, ["value"], buckets=2)
    for batch in (["a", "b", "a"], ["b"], ["c"]):
        arrivals.deliver(lines(*batch))
        counts = arrivals.stream().groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        run_available(counts, bucket_table_action(table), arrivals.checkpoint, "update")
    assert rows(table.rows()) == [("a", 2), ("b", 2), ("c", 1)]
