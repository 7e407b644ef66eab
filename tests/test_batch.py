from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rows import column, final_plan, rows
from tallywork.operators import (
    aggregates, cells, grouping, orders, partitions, ratings, records, topk, traffic, upsert, words,
)

def word_lines():
    dice = random.Random(21)
    return [" ".join(f"w{min(dice.randrange(9), dice.randrange(9))}" for _ in range(12)) for _ in range(30)]


def test_word_count(lines):
    made = word_lines()
    wanted = Counter(word for line in made for word in line.split())
    counts = words.word_count(words.tokens(lines(*made, "w0 ")))
    wanted["w0"] += 1
    assert dict(rows(counts)) == wanted
    ranked = sorted(wanted.items(), key=lambda item: (-item[1], item[0]))
    assert [tuple(row) for row in words.top_words(counts).collect()] == ranked[:3]
    swapped = [tuple(row) for row in words.top_words_swapped(counts, 6).collect()]
    assert sorted(swapped, reverse=True) == sorted(((n, word) for word, n in ranked[:6]), reverse=True)


def test_tokens_of_dirty_lines(lines):
    frame = lines(" a  b\t", "", "\t", None, "c")
    raw = column(words.tokens(frame, trim=False, drop_empty=False), "word")
    trimmed = column(words.tokens(frame, drop_empty=False), "word")
    clean = column(words.tokens(frame), "word")
    assert raw == ["", "a", "b", "", "c"]
    assert trimmed == ["a", "b", "", "", "c"]
    assert clean == ["a", "b", "c"]


def test_access_log(lines):
    good = "1.1.1.1 - - [t +0] \"GET /a HTTP\" 200 5 http://r/ agent"
    short = "1.1.1.1 - - [t +0] \"GET /a HTTP\" 200 5"
    double_blank = "2.2.2.2 - - [t +0]  /b HTTP 200 5 ref"
    frame = lines(f"  {good}\t", short, "", None, double_blank)
    assert rows(records.access_log(frame)) == [("1.1.1.1", "/a", "http://r/"), ("2.2.2.2", "/b", "ref")]
    assert records.valid_records(frame, " ", 11).count() == 2


def test_orders_strict_and_dropping(lines):
    good = [" 1,2,3.5 ", "2,2,1", "3,7,1e2"]
    assert rows(records.parse_orders(lines(*good, "1,2", "", None, "a,b,,"))) == [
        ("1", 2, 3.5), ("2", 2, 1.0), ("3", 7, 100.0),
    ]
    for bad in ("1,2,3,4", "1,x,3", "1,2,y"):
        with pytest.raises(Exception):
            records.parse_orders(lines(*good, bad)).collect()
        assert records.parse_orders(lines(*good, bad), strict=False).count() == 3
    with pytest.raises(Exception, match="expected 3 fields"):
        records.parse_orders(lines(*good, "1,2,3,4")).count()
    parsed = records.parse_orders(lines(*good))
    assert rows(orders.province_amount(parsed)) == [(2, 4.5), (7, 100.0)]
    assert rows(orders.province_count(parsed)) == [(2, 2), (7, 1)]
    as_text = records.parse_orders(lines("1,north,2"), province="string")
    assert rows(as_text) == [("1", "north", 2.0)]


def test_ratings(lines):
    frame = lines("1::2::3.5::4", "1::2::3", "1::2::3::4::5", " 6::7::8::9\t", "1::2::3::4::::", None)
    assert rows(records.parse_ratings(frame)) == [(1, 2, 3.0, 4), (1, 2, 3.5, 4), (6, 7, 8.0, 9)]
    with pytest.raises(Exception, match="not a valid"):
        records.parse_ratings(lines("1::2::x::4")).collect()
    assert records.parse_ratings(lines("1::2::x::4"), strict=False).count() == 0


def test_ratings_top(spark):
    made = [(1, 5.0)] * 3 + [(2, 4.0)] * 3 + [(3, 1.0)] * 5 + [(4, 5.0)] * 2 + [(5, 4.0)] * 3
    frame = spark.createDataFrame(made, "movieId int, rating double")
    wanted = [(3, 5, 1.0), (1, 3, 5.0), (2, 3, 4.0)]
    assert [tuple(r) for r in ratings.ratings_top(frame, more_than=2, n=3).collect()] == wanted
    assert [tuple(r) for r in ratings.ratings_top_sql(frame, more_than=2, n=3).collect()] == wanted
    best = ratings.ratings_top(frame, more_than=2, n=2, best_average=True).collect()
    assert [row.movieId for row in best] == [1, 2]
    halves = spark.createDataFrame([(1, 0.25), (1, 0.0)], "movieId int, rating double")
    assert ratings.ratings_stats(halves).first().avg_rating == 0.13


def test_ip_records(lines):
    line = "|".join(["a", "b", "16", "31", *["x"] * 9, "lat", "lon"])
    assert rows(records.parse_ip_ranges(lines(line, line + "|extra", line[:-4], None))) == [(16, 31, "lon", "lat")]
    assert rows(records.parse_ip_logs(lines("t|1.2.3.4|rest", "t", "t|", None))) == [("1.2.3.4",)]


def test_top_per_key(lines):
    dice = random.Random(8)
    groups = {key: dice.sample(range(100), size) for key, size in (("k1", 4), ("k2", 7), ("k3", 2))}
    wanted = {key: sorted(numbers, reverse=True)[:3] for key, numbers in groups.items()}
    frame = records.parse_key_numbers(lines(*[f"{k} {n}" for k, ns in groups.items() for n in ns], "zz", ""))
    assert dict(rows(topk.group_topk_list(frame, ["key"], "number"))) == wanted
    ranked = rows(topk.group_topk_rank(frame, ["key"], "number"))
    assert ranked == sorted((key, number, rank) for key, top in wanted.items() for rank, number in enumerate(top, 1))
    with pytest.raises(Exception):
        records.parse_key_numbers(lines("aa 1 2")).collect()


def test_top_per_key_with_a_hot_key(spark):
    dice = random.Random(3)
    data = [("hot" if dice.random() < 0.4 else f"k{dice.randrange(50)}", dice.randrange(500)) for _ in range(20_000)]
    data += [("few", 1), ("few", 1)]
    frame = spark.createDataFrame(data, "key string, number int").repartition(8)
    wanted = {}
    for key, number in data:
        wanted.setdefault(key, []).append(number)
    wanted = {key: sorted(numbers, reverse=True)[:3] for key, numbers in wanted.items()}
    result = topk.group_topk_list(frame, ["key"], "number")
    assert dict(rows(result)) == wanted
    plan = final_plan(topk.group_topk_rank(frame, ["key"], "number"))
    assert plan.count("WindowGroupLimit") == 2


def test_whole_set(spark):
    frame = spark.range(1, 11, 1, 2)
    assert tuple(aggregates.whole_set(frame, "id").first()) == (10, 55, 1, 10)
    assert aggregates.fold_with_zero(frame, "id", 100, 2).first().folded == 355
    assert aggregates.global_top(frame, "id", 2).first().top_values == [10, 9]
    assert aggregates.fold_with_zero(frame.where("id > 99"), "id", 1, 2).first().folded == 3
    assert aggregates.first_rows(frame, 4).count() == 4


KEYS = ["area", "kind", "product"]
MEMBER_SCHEMA = "area string, kind string, product string, price int"


def members():
    """Seeded rows of three keys and a price, some without one."""
    dice = random.Random(17)
    fixed = [(f"a{a}", f"k{k}", f"p{p}", 5) for a in range(3) for k in range(3) for p in range(4)]
    return fixed + [
        (f"a{dice.randrange(3)}", f"k{dice.randrange(3)}", f"p{dice.randrange(4)}",
         dice.choice([None, *range(1, 50)]))
        for _ in range(60)
    ]


def levels_of(made, depth, measure):
    """The measure per prefix of the keys, in plain Python."""
    groups = {}
    for row in made:
        groups.setdefault(row[:depth], []).append(row[3])
    return {key: measure(prices) for key, prices in groups.items()}


MEASURES = {
    "cnt": (grouping.count_rows, lambda: F.count(F.lit(1)), len),
    "priced": (lambda: grouping.count_of("price"), lambda: F.count("price"), lambda prices: sum(p is not None for p in prices)),
    "total": (lambda: grouping.total("price"), lambda: F.sum("price"), lambda prices: sum(p or 0 for p in prices)),
    "low": (lambda: grouping.lowest("price"), lambda: F.min("price"), lambda prices: min(p for p in prices if p is not None)),
    "high": (lambda: grouping.highest("price"), lambda: F.max("price"), lambda prices: max(p for p in prices if p is not None)),
    "mean": (lambda: grouping.average("price"), lambda: F.avg("price"),
             lambda prices: sum(p or 0 for p in prices) / max(1, sum(p is not None for p in prices))),
}


@pytest.mark.parametrize("with_distinct", [False, True])
def test_grouping_levels_equal_native_ones(spark, with_distinct):
    frame = spark.createDataFrame(members(), MEMBER_SCHEMA)
    mine = {name: measure() for name, (measure, _, _) in MEASURES.items()}
    plain = [column().alias(name) for name, (_, column, _) in MEASURES.items()]
    if with_distinct:
        unlike = F.count_distinct("price")
        mine, plain = mine | {"unlike": unlike}, [*plain, unlike.alias("unlike")]
    level = F.grouping_id().cast("bigint").alias("level_id")
    sets = [KEYS[:1], KEYS[:2], KEYS]
    assert rows(grouping.rollup(frame, KEYS, mine)) == rows(frame.rollup(*KEYS).agg(*plain, level))
    assert rows(grouping.cube(frame, KEYS, mine)) == rows(frame.cube(*KEYS).agg(*plain, level))
    native = frame.groupingSets([[F.col(name) for name in one] for one in sets], *KEYS).agg(*plain, level)
    assert rows(grouping.grouping_sets(frame, KEYS, sets, mine)) == rows(native)


@pytest.mark.parametrize("name", MEASURES)
def test_grouping_levels_by_hand(spark, name):
    made = members()
    frame = spark.createDataFrame(made, MEMBER_SCHEMA)
    measure, _, by_hand = MEASURES[name]
    rolled = grouping.rollup(frame, KEYS, {name: measure()}).collect()
    for depth in range(4):
        got = {tuple(row)[:depth]: row[name] for row in rolled if row.level_id == (1 << (3 - depth)) - 1}
        assert got == pytest.approx(levels_of(made, depth, by_hand))
    union = {tuple(row)[:3]: row[name] for row in grouping.subtotals_union(frame, KEYS, {name: measure()}).collect()}
    wanted = {(*key, *[""] * (3 - len(key))): value for depth in range(4) for key, value in levels_of(made, depth, by_hand).items()}
    assert union == pytest.approx(wanted)


def test_grouping_of_nothing(spark):
    frame = spark.createDataFrame([], MEMBER_SCHEMA)
    mine = {"cnt": grouping.count_rows(), "total": grouping.total("price")}
    assert rows(grouping.subtotals_union(frame, KEYS, mine)) == [("", "", "", 0, None)]
    assert rows(grouping.subtotals_union(frame, KEYS, {"unlike": F.count_distinct("price")})) == [("", "", "", 0)]
    assert grouping.rollup(frame, KEYS, mine).count() == frame.rollup(*KEYS).count().count()


def test_ordered_levels_and_group_sum(spark):
    frame = spark.createDataFrame(members(), MEMBER_SCHEMA)
    rolled = grouping.rollup(frame, KEYS, {"total_price": grouping.total("price")})
    sums = aggregates.group_sum(frame, KEYS, F.col("price"), "total_price")
    assert rows(sums) == rows(rolled.where("level_id = 0").drop("level_id"))
    ordered = grouping.in_key_order(rolled, KEYS).collect()
    assert ordered[0].area is None and ordered[1].area == "a0" and ordered[1].kind is None


def test_grouping_keeps_real_nulls_apart(spark):
    frame = spark.createDataFrame([(None, "x", 1), ("a", "x", 2)], "a string, b string, price int")
    got = grouping.rollup(frame, ["a", "b"], {"total": grouping.total("price")})
    assert rows(got.where("a is null").select("level_id", "total")) == [(0, 1), (1, 1), (3, 3)]


def test_subtotals_read_the_input_once(spark):
    frame = spark.createDataFrame(members(), MEMBER_SCHEMA)
    union = grouping.subtotals_union(frame.repartition(3), KEYS, {"cnt": grouping.count_rows()})
    union.collect()
    assert final_plan(union).split("Initial Plan")[0].count("ReusedExchange") >= 3


def log_frame(spark):
    dice = random.Random(5)
    made = [
        (f"10.0.0.{dice.randrange(40)}", dice.choice(["/a", "/b", "", " "]), dice.choice(["r1", "r1", "r2", "r3", "", "\t"]))
        for _ in range(2_000)
    ]
    made += [("", "/a", "r2"), (None, "/a", None), ("9.9.9.9", None, "r9")]
    return made, spark.createDataFrame(made, "ip string, url string, referrer string")


def test_traffic(spark):
    made, frame = log_frame(spark)

    def present(value):
        return value is not None and value.strip() != ""

    pv = sum(present(url) for _, url, _ in made)
    uv = len({ip for ip, _, _ in made if present(ip)})
    refs = sorted(Counter(r for _, _, r in made if present(r)).items(), key=lambda item: (-item[1], item[0]))
    assert traffic.page_views(frame).first().pv == pv
    assert traffic.unique_visitors(frame).first().uv == uv
    assert abs(traffic.unique_visitors(frame, approximate=True).first().uv - uv) <= 4
    assert traffic.visitors(frame).count() == uv
    assert [tuple(r) for r in traffic.top_referrers(frame, 3).collect()] == refs[:3]
    for n in (2, 10):
        report = traffic.traffic_report(frame, n)
        assert rows(report) == sorted(
            [("pv", "", pv), ("uv", "", uv), *[("referrer", r, c) for r, c in refs[:n]]], key=repr
        )
    empty = frame.where("false")
    assert rows(traffic.traffic_report(empty)) == [("pv", "", 0), ("uv", "", 0)]


def test_traffic_report_reads_the_log_once(spark):
    _, frame = log_frame(spark)
    report = traffic.traffic_report(frame.repartition(3))
    report.collect()
    assert "ReusedExchange" in final_plan(report).split("Initial Plan")[0]


def test_cells(spark):
    wide = spark.createDataFrame([("spark", 233, "x"), ("hadoop", 123, None), ("flink", 300, "y")], "word string, count int, tag string")
    older = cells.wide_to_cells(wide, "word", "info", F.lit(1))
    assert older.count() == 5
    newer = cells.wide_to_cells(wide.select("word", (F.col("count") + 1).alias("count")), "word", "info", F.lit(2))
    both = older.unionByName(newer)
    assert cells.count_row_keys(both).first().row_keys == 3
    view = cells.cells_to_wide(both, [("info", "count"), ("info", "tag"), ("info", "none")])
    assert rows(view) == [("flink", "301", "y", None), ("hadoop", "124", None, None), ("spark", "234", "x", None)]
    assert rows(cells.latest_cells(both).where("qualifier = 'count'").select("row_key", "value", "version")) == [
        ("flink", "301", 2), ("hadoop", "124", 2), ("spark", "234", 2),
    ]
    printed = cells.cell_lines(both, 2)
    assert rows(printed) == [
        ("flink", "info:count = 301, version -> 2"), ("flink", "info:tag = y, version -> 1"),
        ("hadoop", "info:count = 124, version -> 2"),
    ]


def test_upsert(spark):
    base = spark.createDataFrame([(1, "old", 0), (2, "old", 9), (3, "old", 0)], "k int, v string, n int")
    updates = spark.createDataFrame([(2, "first", 1), (2, "last", 2), (4, "new", 1)], "k int, v string, n int")
    once = upsert.upsert(base, updates, ["k"], "n")
    wanted = [(1, "old", 0), (2, "last", 2), (3, "old", 0), (4, "new", 1)]
    assert rows(once) == wanted
    assert rows(upsert.upsert(once, updates, ["k"], "n")) == wanted


def test_upsert_of_a_null_key(spark):
    base = spark.createDataFrame([(None, "old", 0), (1, "old", 0)], "k int, v string, n int")
    updates = spark.createDataFrame([(None, "new", 1), (None, "newer", 2)], "k int, v string, n int")
    assert rows(upsert.upsert(base, updates, ["k"], "n")) == [(1, "old", 0), (None, "newer", 2)]


def test_upsert_and_cell_lines_read_once(spark, tmp_path):
    spark.range(20).selectExpr("id AS k", "'a' AS v", "id AS n").write.parquet(str(tmp_path / "base"))
    spark.range(9).selectExpr("id AS k", "'b' AS v", "id AS n").write.parquet(str(tmp_path / "updates"))
    base, updates = (spark.read.parquet(str(tmp_path / name)) for name in ("base", "updates"))
    assert final_plan(upsert.upsert(base, updates, ["k"], "n")).count("FileScan") == 2
    table = base.selectExpr("string(k) AS row_key", "'f' AS family", "'q' AS qualifier", "v AS value", "n AS version")
    assert final_plan(cells.cell_lines(table)).count("FileScan") == 1


def test_partitions(spark):
    frame = spark.range(0, 100, 1, 4)
    assert rows(partitions.partition_counts(frame)) == [(i, 25) for i in range(4)]
    doubled = partitions.map_partitions(frame, lambda batch: batch.assign(id=batch["id"] * 2), "id bigint")
    assert doubled.agg(F.sum("id")).first()[0] == 9900
    with partitions.persisted(frame.selectExpr("id % 7 AS k")) as kept:
        assert kept.is_cached and kept.distinct().count() == 7
    assert not kept.is_cached
