from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from rows import column, rows
from tallywork.functions import clock, fields, network, user_functions


def test_ip_to_long(lines):
    values = ["0.0.0.0", "1.2.3.4", "255.255.255.255", "10.300.1.1", "7", "1.2.3", "1.2.3.4.5", "1.2.3.4.5.6.7.8.9.300.11"]

    def fold(ip: str) -> int:
        number = 0
        for part in ip.split("."):
            number = (int(part) | number << 8) % 2**64
        return number - 2**64 if number >= 2**63 else number

    got = column(lines(*values).select(network.ip_to_long(F.col("value")).alias("n")), "n")
    assert got == [fold(value) for value in values]


def moments(spark):
    values = ["2024-01-01 00:00:00", "2024-02-29 23:59:59.999999", "2023-12-31 12:30:15.000001", "1969-12-31 23:00:00.5"]
    return spark.createDataFrame([(value,) for value in values], "t string").select(F.expr("cast(t as timestamp_ntz) as ts"))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_clock_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = moments(spark).select(
            clock.millis_to_midnight(F.col("ts")).alias("rest"),
            F.unix_micros(clock.utc_instant(F.col("ts"))).alias("micros"),
            clock.batch_time(F.col("ts")).alias("header"),
            clock.utc_text(clock.utc_instant(F.col("ts"))).alias("text"),
        )
        got = frame.collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [row.rest for row in got] == [86_400_000, 1, 41_384_999 + 1, 3_599_500]
    epoch = datetime.datetime(1970, 1, 1)
    wanted = [
        datetime.datetime(2024, 1, 1), datetime.datetime(2024, 2, 29, 23, 59, 59, 999999),
        datetime.datetime(2023, 12, 31, 12, 30, 15, 1), datetime.datetime(1969, 12, 31, 23, 0, 0, 500000),
    ]
    assert [row.micros for row in got] == [(moment - epoch) // datetime.timedelta(microseconds=1) for moment in wanted]
    assert [row.header for row in got] == [moment.strftime("%Y/%m/%d %H:%M:%S") for moment in wanted]
    assert [row.text for row in got] == [moment.strftime("%Y-%m-%d %H:%M:%S") for moment in wanted]


def test_batch_time_of_millis(spark):
    frame = spark.range(1).select(clock.batch_time_of_millis(F.lit(1_000)).alias("t"))
    assert column(frame, "t") == ["1970/01/01 00:00:01"]


def test_json_fields(lines):
    frame = lines('{"id": 1, "type": "push", "public": true}', '{"id": "2"', "", None)
    got = fields.json_fields(frame, "value", ["id", "type", "public", "created_at"]).collect()
    assert tuple(got[0]) == ("1", "push", "true", None)
    assert all(value is None for row in got[1:] for value in row)


def test_json_fields_are_literal_names(lines):
    frame = lines('{"a": {"b": 1}, "x": 2, "a.b": 3}')
    assert rows(fields.json_fields(frame, "value", ["a.b"])) == [("3",)]
    assert rows(fields.json_fields(frame, "value", ["a.b", "x"])) == [("3", "2")]


def test_record_without_value(spark):
    frame = spark.createDataFrame([("t", 0, 1, None)], "topic string, partition int, offset bigint, value binary")
    assert column(fields.record_view(frame), "line") == ["t-0:1 = null"]


def test_records(spark):
    frame = spark.createDataFrame([(None, b"caf\xc3\xa9", "t", 2, 40)], "key binary, value binary, topic string, partition int, offset bigint")
    assert rows(fields.decode_records(frame)) == [(None, "café", "t", 2, 40)]
    assert column(fields.record_view(frame), "line") == ["t-2:40 = café"]


def test_to_lower_in_all_forms(spark, lines):
    frame = lines(" ABC\t", "x", "", None)
    user_functions.register_to_lower(spark)
    native = column(frame.select(user_functions.to_lower(F.col("value")).alias("v")), "v")
    by_sql = column(spark.sql("SELECT to_lower(value) AS v FROM {f}", f=frame), "v")
    arrow = column(frame.select(user_functions.to_lower_arrow("value").alias("v")), "v")
    assert native == by_sql == arrow == ["abc", "x", "", None]


SALARIES = [("Michael", 3000), ("Andy", 4500), ("Justin", 3500), ("Berta", 4000)]


def test_average(spark):
    frame = spark.createDataFrame(SALARIES, "name string, salary bigint")
    assert column(frame.agg(user_functions.average(F.col("salary")).alias("a")), "a") == [3750.0]
    assert column(user_functions.average_arrow(frame, [], "salary", "a"), "a") == [3750.0]


def test_average_of_nothing_is_nan(spark):
    empty = spark.createDataFrame([], "name string, salary bigint")
    assert math.isnan(empty.agg(user_functions.average(F.col("salary")).alias("a")).first().a)
    assert math.isnan(user_functions.average_arrow(empty, [], "salary", "a").first().a)


def test_average_per_key_with_nulls(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 5), ("a", None)], "k string, v bigint")
    native = frame.groupBy("k").agg(user_functions.average(F.col("v")).alias("a")).where("k <> 'b' or k is null")
    assert rows(native) == rows(user_functions.average_arrow(frame, ["k"], "v", "a")) == [("a", 1.5), (None, 5.0)]
