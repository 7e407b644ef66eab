from __future__ import annotations

import random
from collections import Counter

import pytest

from rows import final_plan, rows
from tallywork.operators import ranges


def number(ip: str) -> int:
    a, b, c, d = map(int, ip.split("."))
    return (a << 24) | (b << 16) | (c << 8) | d


@pytest.fixture(scope="module")
def world(spark):
    """Disjoint ranges of very different sizes, and addresses of which a third hit one block."""
    dice = random.Random(11)
    bounds = sorted(dice.sample(range(1 << 24, 14 << 24), 400))
    table = [(low, high, f"lon{i}", f"lat{i}") for i, (low, high) in enumerate(zip(bounds[::2], bounds[1::2]))]
    table += [(20 << 24, 20 << 24, "single", "x"), ((20 << 24) + 1, (20 << 24) + 9, "next", "x")]
    probe = []
    for i in range(6_000):
        if i % 3 == 0:
            ip = f"5.5.{dice.randrange(256)}.{dice.randrange(3)}"
        else:
            ip = f"{dice.randrange(16)}.{dice.randrange(256)}.{dice.randrange(256)}.{dice.randrange(256)}"
        probe.append((i, ip))
    probe += [(6_000, "20.0.0.0"), (6_001, "20.0.0.1"), (6_002, "20.0.0.9"), (6_003, "20.0.0.10"), (6_004, None)]
    wanted = []
    for i, ip in probe:
        for low, high, lon, lat in table:
            if ip is not None and low <= number(ip) <= high:
                wanted.append((i, ip, lon, lat))
    lookup = spark.createDataFrame(table, "start_ip bigint, end_ip bigint, longitude string, latitude string")
    return spark.createDataFrame(probe, "id int, ip string"), lookup, sorted(wanted, key=repr)


COLUMNS = ["id", "ip", "longitude", "latitude"]


def test_all_forms_equal_brute_force(world):
    probe, lookup, wanted = world
    forms = [
        ranges.range_lookup(probe, lookup),
        ranges.range_lookup(probe, lookup, spread_by=["id"]),
        ranges.range_lookup(probe, lookup, spread_by=["id"], rows_per_split=2),
        ranges.range_lookup(probe, lookup, rows_per_split=1),
    ]
    for form in forms:
        assert rows(form.select(*COLUMNS)) == wanted


def test_hot_address_is_split(spark, world):
    _, lookup, _ = world
    hot = [(i, "20.0.0.1" if i % 3 else f"20.0.0.{i % 12}") for i in range(900)]
    probe = spark.createDataFrame(hot, "id int, ip string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = ranges.range_lookup(probe, lookup, rows_per_split=50)
        got = split.groupBy("ip").count().collect()
        plan = final_plan(split)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    wanted = Counter(ip for _, ip in hot if 0 <= int(ip.rsplit(".", 1)[1]) <= 9)
    assert {row["ip"]: row["count"] for row in got} == wanted
    assert "_salt" in plan and "NestedLoop" not in plan


def test_pieces_are_few_and_blocks_sparse(world):
    _, lookup, _ = world
    pieces = ranges._pieces(lookup)
    # 18 per range and block it touches, at most.
    touched = lookup.selectExpr("sum((end_ip >> 16) - (start_ip >> 16) + 1)").first()[0]
    assert pieces.count() <= 18 * touched
    assert pieces.groupBy("_key").count().agg({"count": "max"}).first()[0] <= 2


def test_dense_block(spark):
    low = 7 << 24
    table = [(low + 2 * i, low + 2 * i + i % 2, f"lon{i}", "lat") for i in range(3_000)]
    lookup = spark.createDataFrame(table, "start_ip bigint, end_ip bigint, longitude string, latitude string")
    probe = spark.createDataFrame([(i, f"7.0.{i // 256}.{i % 256}") for i in range(6_100)], "id int, ip string")
    wanted = sorted((i, f"lon{i // 2}") for i in range(6_000) if i % 2 == 0 or (i // 2) % 2)
    for form in (ranges.range_lookup(probe, lookup), ranges.range_lookup(probe, lookup, rows_per_split=1)):
        assert sorted((row.id, row.longitude) for row in form.collect()) == wanted
    assert ranges._pieces(lookup).groupBy("_key").count().agg({"count": "max"}).first()[0] <= 2


def test_no_nested_loop(world):
    probe, lookup, _ = world
    for form in (ranges.range_lookup(probe, lookup), ranges.geo_heat(probe, lookup)):
        plan = final_plan(form)
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_spark_decides_what_is_broadcast(world, spark, tmp_path):
    """No hint but that of the split addresses, and the probe is read for the counts and for the join."""
    probe, lookup, _ = world
    probe.write.parquet(str(tmp_path / "probe"))
    found = ranges.range_lookup(spark.read.parquet(str(tmp_path / "probe")), lookup)
    logical = found._jdf.queryExecution().logical().toString()
    assert logical.count("strategy=broadcast") == 1
    found.collect()
    plan = final_plan(found).split("Initial Plan")[0]
    assert plan.count("FileScan") <= 3 and plan.count("ReusedExchange") >= 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_addresses(spark, world, ansi):
    _, lookup, _ = world
    probe = spark.createDataFrame([(1, "20.0.0.1"), (2, "20.0.x.1"), (3, "20.0.0.1.")], "id int, ip string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a valid"):
            ranges.range_lookup(probe, lookup).collect()
        assert rows(ranges.range_lookup(probe, lookup, strict=False).select("id", "longitude")) == [(1, "next"), (3, "next")]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_heat(world):
    probe, lookup, wanted = world
    counts = {}
    for _, _, lon, lat in wanted:
        counts[lon, lat] = counts.get((lon, lat), 0) + 1
    expected = sorted(((lon, lat, n) for (lon, lat), n in counts.items()), key=repr)
    assert rows(ranges.geo_heat(probe, lookup)) == expected


def test_overlaps_fail(spark, world):
    probe, _, _ = world
    low = 5 << 24
    table = spark.createDataFrame(
        [(low, low + 100_000, "a", "a"), (low + 70_000, low + 80_000, "b", "b")],
        "start_ip bigint, end_ip bigint, longitude string, latitude string",
    )
    assert ranges.overlapping_ranges(table).count() == 1
    for form in (ranges.range_lookup(probe, table), ranges.geo_heat(probe, table)):
        with pytest.raises(Exception, match="overlapping range"):
            form.collect()
