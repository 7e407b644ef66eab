from __future__ import annotations

import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rows import column, rows
from tallywork.operators import orders, records, words
from tallywork.session import SETTINGS
from tallywork.sources.log_topics import RECORD_SCHEMA
from tallywork.sources.streams import stream_lines, stream_parquet
from tallywork.streaming import outputs, totals, windows
from tallywork.streaming.runner import (
    Arrivals, late_rows, latest_batch, read_batches, run_available, start, stored_batches, to_batch_dirs, workspace,
)

LINE_SCHEMA = "value string"
BATCHES = [["1,7,10.5", "2,7,1", "3,8,2"], ["4,8,5", "5,9,1", "1,2"], ["6,7,100"]]


@pytest.fixture
def arrivals(spark):
    from pyspark.sql.types import StringType, StructField, StructType

    return Arrivals(spark, "test", StructType([StructField("value", StringType())]))


def feed(arrivals, lines, query, action, mode="append", batches=BATCHES):
    for batch in batches:
        arrivals.deliver(lines(*batch))
        run_available(query(arrivals.stream()), action, arrivals.checkpoint, mode)


def money(stream):
    return records.parse_orders(stream)


def total(stream):
    return totals.running_total(money(stream), ["province_id"], "order_price")


def per_batch(spark, path, value):
    return {
        (row.batch_id, row.province_id): row[value] for row in read_batches(spark, path).collect()
    }


UPDATES = {(0, 7): 11.5, (0, 8): 2.0, (1, 8): 7.0, (1, 9): 1.0, (2, 7): 111.5}
COMPLETE = UPDATES | {(1, 7): 11.5, (2, 8): 7.0, (2, 9): 1.0}


def test_running_totals(spark, lines, arrivals):
    feed(arrivals, lines, total, to_batch_dirs(arrivals.output), "update")
    assert per_batch(spark, arrivals.output, "amount") == UPDATES


def test_running_totals_of_all_keys(spark, lines, arrivals):
    feed(arrivals, lines, total, to_batch_dirs(arrivals.output), "complete")
    assert per_batch(spark, arrivals.output, "amount") == COMPLETE
    assert rows(latest_batch(spark, arrivals.output)) == [(7, 111.5), (8, 7.0), (9, 1.0)]


def test_user_state_gives_the_same_totals(spark, lines, arrivals):
    def stateful(stream):
        cents = money(stream).select("province_id", (F.col("order_price") * 100).cast("bigint").alias("cents"))
        return totals.running_total_stateful(cents, "province_id", "cents")

    feed(arrivals, lines, stateful, to_batch_dirs(arrivals.output), "update")
    got = per_batch(spark, arrivals.output, "total")
    assert {key: cents / 100 for key, cents in got.items()} == UPDATES


def test_running_totals_with_the_recommended_settings(spark, lines, arrivals):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        feed(arrivals, lines, total, to_batch_dirs(arrivals.output), "update")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert per_batch(spark, arrivals.output, "amount") == UPDATES


def test_no_batches_yet(spark, lines, arrivals):
    schema = lines("x").schema
    assert read_batches(spark, f"{arrivals.home}/nothing", schema).count() == 0
    assert schema.fieldNames() == ["value"]
    feed(arrivals, lines, lambda s: s, to_batch_dirs(arrivals.output), batches=[["a"], ["b"]])
    assert rows(read_batches(spark, arrivals.output, schema)) == [("a", 0), ("b", 1)]


def test_restart_reads_nothing_twice(spark, lines, arrivals):
    feed(arrivals, lines, total, to_batch_dirs(arrivals.output), "update")
    before = per_batch(spark, arrivals.output, "amount")
    run_available(total(arrivals.stream()), to_batch_dirs(arrivals.output), arrivals.checkpoint, "update")
    assert per_batch(spark, arrivals.output, "amount") == before


def test_failed_batch_is_repeated_and_counted_once(spark, lines, arrivals):
    store = to_batch_dirs(arrivals.output)

    def dies_after_storing(batch, batch_id):
        store(batch, batch_id)
        raise RuntimeError("lost executor")

    arrivals.deliver(lines(*BATCHES[0]))
    with pytest.raises(Exception, match="lost executor"):
        run_available(total(arrivals.stream()), dies_after_storing, arrivals.checkpoint, "update")
    run_available(total(arrivals.stream()), store, arrivals.checkpoint, "update")
    assert per_batch(spark, arrivals.output, "amount") == {(0, 7): 11.5, (0, 8): 2.0}


def test_word_count_per_batch(spark, lines, arrivals):
    def count(batch):
        return words.word_count(words.tokens(batch))

    feed(arrivals, lines, lambda s: s, to_batch_dirs(arrivals.output, count), batches=[["a b a", ""], ["a"], ["", "c"]])
    assert rows(read_batches(spark, arrivals.output).select("batch_id", "word", "cnt")) == [
        (0, "a", 2), (0, "b", 1), (1, "a", 1), (2, "c", 1),
    ]


def test_batch_time_comes_from_the_rows(spark):
    source = Arrivals(spark, "times", spark.createDataFrame([], "value string, at timestamp").schema)

    def count(batch):
        return words.word_count(words.tokens(batch))

    store = to_batch_dirs(source.output, outputs.stamped(count, "at"))
    for hour in (1, 2):
        made = [("a b", moment(f"2024-01-01 0{hour}:00")), ("a", moment(f"2024-01-01 0{hour}:30"))]
        source.deliver(spark.createDataFrame(made, source.schema))
        run_available(source.stream(), store, source.checkpoint)
    wanted = [("a", 2, "2024/01/01 01:30:00", 0), ("a", 2, "2024/01/01 02:30:00", 1),
              ("b", 1, "2024/01/01 01:30:00", 0), ("b", 1, "2024/01/01 02:30:00", 1)]
    assert rows(read_batches(spark, source.output).select("word", "cnt", "batch_time", "batch_id")) == wanted


def test_jdbc_batches_are_merged(monkeypatch, lines, arrivals):
    merged = []
    monkeypatch.setattr(
        outputs, "upsert_table",
        lambda batch, url, table, staging, keys, properties: merged.append((table, staging, keys, rows(batch))),
    )
    action = outputs.jdbc_upsert_action("url", "counts", "counts_new", ["word"], {})
    feed(arrivals, lines, lambda s: words.word_count(words.tokens(s)), action, "update", [["a b a"], ["b"]])
    assert merged == [
        ("counts", "counts_new", ["word"], [("a", 2), ("b", 1)]), ("counts", "counts_new", ["word"], [("b", 2)]),
    ]


def test_state_has_the_partitions_of_the_session(spark, lines, arrivals):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        arrivals.deliver(lines(*BATCHES[0]))
        run_available(total(arrivals.stream()), to_batch_dirs(arrivals.output), arrivals.checkpoint, "update")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "11"
        stores = [entry for entry in Path(f"{arrivals.checkpoint}/state/0").iterdir() if entry.name.isdigit()]
        assert len(stores) == 11
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_query_that_goes_on(spark, lines, arrivals):
    arrivals.deliver(lines(*BATCHES[0]))
    query = start(
        total(arrivals.stream()), to_batch_dirs(arrivals.output), arrivals.checkpoint, "update",
        {"processingTime": "100 milliseconds"},
    )
    try:
        query.processAllAvailable()
        assert query.isActive
        arrivals.deliver(lines(*BATCHES[1]))
        query.processAllAvailable()
    finally:
        query.stop()
    assert per_batch(spark, arrivals.output, "amount") == {key: value for key, value in UPDATES.items() if key[0] < 2}


def test_latest_batch_may_be_empty(spark, lines, arrivals):
    feed(arrivals, lines, lambda s: s.where("value <> 'x'"), to_batch_dirs(arrivals.output), batches=[["a"], ["x"]])
    assert stored_batches(spark, arrivals.output) == [0, 1]
    assert latest_batch(spark, arrivals.output).count() == 0


def test_null_slices_arrive_and_wrong_ones_fail(spark, lines, arrivals):
    made = spark.createDataFrame([("a", 0), ("b", None), ("c", 1)], "value string, slice int")
    arrivals.run_slices(made, "slice", 3, lambda stream: stream, to_batch_dirs(arrivals.output))
    assert rows(read_batches(spark, arrivals.output)) == [("a", 0), ("b", 0), ("c", 1)]
    other = Arrivals(spark, "wrong", arrivals.schema)
    with pytest.raises(Exception, match="no such slice"):
        other.run_slices(made, "slice", 1, lambda stream: stream, to_batch_dirs(other.output))


def test_file_lines_and_union(spark, tmp_path):
    left, right = tmp_path / "left", tmp_path / "right"
    for folder, text in ((left, "x y\nx\n"), (right, "y z\n")):
        folder.mkdir()
        (folder / "part.txt").write_text(text)
    both = stream_lines(spark, str(left)).union(stream_lines(spark, str(right), max_files=1))
    home = workspace(spark, "union")
    counts = words.word_count(words.tokens(both))
    run_available(counts, outputs.keyed_table_action(f"{home}/out", ["word"]), f"{home}/checkpoint", "update")
    assert dict(rows(outputs.keyed_table(spark, f"{home}/out", ["word"]))) == {"x": 2, "y": 2, "z": 1}


def test_capped_files_give_several_batches(spark, tmp_path):
    for number in range(3):
        (tmp_path / f"{number}.txt").write_text("w\n")
    home = workspace(spark, "capped")
    counts = words.word_count(words.tokens(stream_lines(spark, str(tmp_path), max_files=1)))
    run_available(counts, outputs.keyed_table_action(f"{home}/out", ["word"]), f"{home}/checkpoint", "update")
    assert sorted(column(read_batches(spark, f"{home}/out/changes"), "cnt")) == [1, 2, 3]
    assert rows(outputs.keyed_table(spark, f"{home}/out", ["word"])) == [("w", 3)]


def test_keyed_table_is_compacted_and_may_be_repeated(spark, lines, arrivals):
    path, wanted = arrivals.output, {}
    action = outputs.keyed_table_action(path, ["k"], every=3)
    for number in range(11):
        changes = [(f"k{number % 4}", number), (f"k{number}", number)]
        wanted |= dict(changes)
        frame = spark.createDataFrame(sorted(set(changes)), "k string, v int")
        for _ in range(2):  # as after a failure
            action(frame, number)
        assert dict(rows(outputs.keyed_table(spark, path, ["k"]))) == wanted
    assert stored_batches(spark, f"{path}/base") == [5, 8]
    assert stored_batches(spark, f"{path}/changes") == [6, 7, 8, 9, 10]


def test_stream_of_one_file_or_directory(spark, tmp_path):
    spark.range(4).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    pq.write_table(pa.table({"id": [7, 8]}), tmp_path / "single.parquet")
    for name, wanted in (("t.parquet", 4), ("t.parquet/", 4), ("single.parquet", 2)):
        home = workspace(spark, "glob")
        stream = stream_parquet(spark, str(tmp_path / name), spark.range(1).schema)
        run_available(stream, to_batch_dirs(f"{home}/out"), f"{home}/checkpoint")
        assert read_batches(spark, f"{home}/out").count() == wanted


@pytest.mark.parametrize("merge", [windows.merge_counts(["province_id"]), windows.merge_counts_sql("province_id")])
def test_batch_windows(spark, lines, arrivals, merge):
    def count(batch):
        return orders.province_count(records.parse_orders(batch))

    action = windows.batch_windows(f"{arrivals.home}/partials", arrivals.output, count, merge)
    feed(arrivals, lines, lambda s: s, action)
    assert per_batch(spark, arrivals.output, "cnt") == {
        (0, 7): 2, (0, 8): 1, (1, 7): 2, (1, 8): 2, (1, 9): 1, (2, 7): 1, (2, 8): 1, (2, 9): 1,
    }


def test_batch_windows_with_longer_slide(spark, lines, arrivals):
    def count(batch):
        return orders.province_count(records.parse_orders(batch))

    action = windows.batch_windows(
        f"{arrivals.home}/partials", arrivals.output, count, windows.merge_counts(["province_id"]), length=2, slide=2
    )
    feed(arrivals, lines, lambda s: s, action, batches=[*BATCHES, ["7,9,1"]])
    assert per_batch(spark, arrivals.output, "cnt") == {(1, 7): 2, (1, 8): 2, (1, 9): 1, (3, 7): 1, (3, 9): 1}


def moment(text):
    return datetime.datetime.fromisoformat(text)


def test_event_windows_same_in_batch_and_stream(spark):
    frame = spark.createDataFrame(
        [(moment("2024-01-01 00:30"), "a"), (moment("2024-01-01 02:00"), "a"), (moment("2024-01-01 03:59"), "b")],
        "ts timestamp, k string",
    )
    counted = windows.event_windows(frame, "ts", "4 hours", "2 hours", ["k"], F.count(F.lit(1)))
    batch = rows(counted.select(F.hour("window.start").alias("h"), "k", "cnt"))
    assert batch == [(0, "a", 2), (0, "b", 1), (2, "a", 1), (2, "b", 1), (22, "a", 1)]
    source = Arrivals(spark, "windows", frame.schema)
    source.deliver(frame)

    def query(stream):
        sums = windows.event_windows(stream, "ts", "4 hours", "2 hours", ["k"], F.count(F.lit(1)))
        return sums.select(F.col("window.start").alias("start"), "k", "cnt")

    run_available(query(source.stream()), outputs.keyed_table_action(source.output, ["start", "k"]), source.checkpoint, "update")
    table = outputs.keyed_table(spark, source.output, ["start", "k"])
    assert rows(table.select(F.hour("start").alias("h"), "k", "cnt")) == batch


@pytest.mark.parametrize(("lateness", "first_day", "dropped"), [(None, (1, 103, 3), 0), ("1 hour", (1, 3, 2), 1)])
def test_daily_totals_start_anew(spark, lateness, first_day, dropped):
    schema = spark.createDataFrame([], "instant timestamp, k string, v bigint").schema
    source = Arrivals(spark, "daily", schema)

    def query(stream):
        sums = totals.daily_total(stream, "instant", ["k"], "v", lateness)
        return sums.select(F.col("day_window.start").alias("day"), "k", "amount", "cnt")

    batches = [
        [("2024-01-01 10:00", 1), ("2024-01-01 23:00", 2)],
        [("2024-01-02 05:00", 5), ("2024-01-02 06:00", 6)],
        [("2024-01-01 09:00", 100), ("2024-01-02 07:00", 7)],
    ]
    late = 0
    for batch in batches:
        made = spark.createDataFrame([(moment(at), "k", value) for at, value in batch], schema)
        source.deliver(made)
        action = outputs.keyed_table_action(source.output, ["day", "k"])
        running = start(query(source.stream()), action, source.checkpoint, "update", {"availableNow": True})
        running.awaitTermination()
        late += late_rows(running)
    table = outputs.keyed_table(spark, source.output, ["day", "k"])
    assert rows(table.select(F.dayofmonth("day").alias("d"), "amount", "cnt")) == [first_day, (2, 18, 3)]
    assert late == dropped


def test_offsets_follow_the_output(spark):
    source = Arrivals(spark, "offsets", RECORD_SCHEMA)
    offsets = f"{source.home}/offsets"
    seen = []

    def store(batch, batch_id):
        seen.append(batch_id)
        if batch_id == 1 and seen.count(1) == 1:
            raise RuntimeError("no space")
        batch.select("offset").write.mode("overwrite").parquet(f"{source.output}/batch_id={batch_id}")

    action = outputs.offsets_action(store, offsets)

    def deliver(*made):
        frame = spark.createDataFrame([(None, b"v", "t", p, o, None) for p, o in made], RECORD_SCHEMA)
        source.deliver(frame)

    deliver((0, 0), (0, 1), (1, 0))
    run_available(source.stream(), action, source.checkpoint)
    deliver((0, 2), (1, 1), (1, 2))
    with pytest.raises(Exception, match="no space"):
        run_available(source.stream(), action, source.checkpoint)
    assert read_batches(spark, offsets).agg(F.max("batch_id")).first()[0] == 0
    run_available(source.stream(), action, source.checkpoint)
    assert rows(read_batches(spark, offsets)) == [
        ("t", 0, 0, 2, 0), ("t", 0, 2, 3, 1), ("t", 1, 0, 1, 0), ("t", 1, 1, 3, 1),
    ]


def test_workspace_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    def session(shared, master):
        conf = SimpleNamespace(get=lambda key, default=None: default)
        context = SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda key: shared), master=master)
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert workspace(session("hdfs://x/ck/", "yarn"), "job").startswith("hdfs://x/ck/job-")
    with pytest.raises(ValueError, match="share"):
        workspace(session(None, "yarn"), "job")
    assert "/job-" in workspace(session(None, "local[2]"), "job")
