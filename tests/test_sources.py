from __future__ import annotations

import gzip
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from rows import column, rows
from tallywork.operators import words
from tallywork.operators.records import RATING_SCHEMA, parse_ratings
from tallywork.sources import catalog, files, jdbc, log_topics


def test_lines_plain_and_gzip(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\n\n y\n")
    with gzip.open(tmp_path / "b.gz", "wt") as out:
        out.write("z\n")
    assert sorted(column(files.read_lines(spark, str(tmp_path)), "value")) == ["", " y", "x", "z"]


def test_delimited_with_header(spark, tmp_path):
    (tmp_path / "u.dat").write_text("userId\tmovieId\trating\ttimestamp\n1\t2\t3.5\t881250949\n1\t3\t4\t881250950\n")
    found = files.read_delimited(spark, str(tmp_path), sep="\t")
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        ("userId", "int"), ("movieId", "int"), ("rating", "double"), ("timestamp", "int"),
    ]
    assert rows(found) == [(1, 2, 3.5, 881250949), (1, 3, 4.0, 881250950)]


def test_ratings_with_schema_and_wide_delimiter(spark, tmp_path):
    plain, wide = tmp_path / "plain", tmp_path / "wide"
    plain.mkdir()
    wide.mkdir()
    (plain / "u.data").write_text("1\t2\t3.5\t9\n4\t5\t6\t7\n")
    (wide / "r.dat").write_text("1::2::3.5::9\n4::5::6::7\nbroken::line\n")
    by_schema = files.read_ratings(spark, str(plain))
    assert by_schema.schema == RATING_SCHEMA
    by_text = parse_ratings(files.read_lines(spark, str(wide)))
    assert by_text.schema == RATING_SCHEMA
    assert rows(by_schema) == rows(by_text) == [(1, 2, 3.5, 9), (4, 5, 6.0, 7)]


def test_json_lines(spark, tmp_path):
    (tmp_path / "people.json").write_text('{"name":"Michael"}\n{"name":"Andy", "age":30}\n{"name":"Justin", "age":19}\n')
    found = files.read_json(spark, str(tmp_path))
    assert rows(found.select("name", "age")) == [("Andy", 30), ("Justin", 19), ("Michael", None)]
    declared = files.read_json(spark, str(tmp_path), "name string, age bigint")
    assert rows(declared) == rows(found.select("name", "age"))


def test_key_value_lines(spark, tmp_path):
    (tmp_path / "kv.txt").write_text("".join(f"{n}\x01val_{n}\n" for n in (238, 86, 311)))
    got = files.key_value_lines(files.read_lines(spark, str(tmp_path)))
    assert rows(got) == [(238, "val_238"), (311, "val_311"), (86, "val_86")]


def test_key_value_lines_with_any_separator(lines):
    assert rows(files.key_value_lines(lines("1|a|b", "2|"), "|")) == [(1, "a|b"), (2, "")]


def test_local_rows(spark):
    assert rows(files.local_rows(spark, [("a", 1), ("b", None)], "k string, n int")) == [("a", 1), ("b", None)]


def test_parquet_both_ways(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    assert rows(files.read_parquet(spark, path)) == rows(files.read_default(spark, path)) == [(i,) for i in range(5)]


def test_local_range(spark):
    made = files.local_range(spark, 1, 10, 2)
    assert made.rdd.getNumPartitions() == 2
    assert made.agg(F.sum("id"), F.count("id")).first()[:] == (55, 10)


def test_pair_sink(spark, lines, tmp_path):
    path = str(tmp_path / "out")
    counts = words.word_count(words.tokens(lines("spark hive spark", "a,b")))
    files.write_pairs(counts, path)
    assert sorted(column(files.read_lines(spark, path), "value")) == ["(a,b,1)", "(hive,1)", "(spark,2)"]
    assert rows(files.read_pairs(spark, path)) == [("a,b", "1"), ("hive", "1"), ("spark", "2")]
    with pytest.raises(Exception):
        files.write_pairs(counts, path)


def test_catalog_table(spark, tmp_path):
    catalog.save_table(spark.range(3), "numbers_of_test", str(tmp_path / "numbers"))
    try:
        assert rows(catalog.read_table(spark, "numbers_of_test")) == [(0,), (1,), (2,)]
        assert rows(catalog.query_table(spark, "SELECT id FROM numbers_of_test WHERE id > 1")) == [(2,)]
    finally:
        catalog.drop_table(spark, "numbers_of_test")
    assert not spark.catalog.tableExists("numbers_of_test") and (tmp_path / "numbers").exists()


class Recorder:
    def __init__(self):
        self.calls = []

    def jdbc(self, *args, **kwargs):
        self.calls.append((args, kwargs))


def test_jdbc_calls():
    reader = Recorder()
    session = SimpleNamespace(read=reader)
    properties = {"user": "u"}
    jdbc.read_whole(session, "url", "t", properties)
    jdbc.read_bounded(session, "url", "t", "amt", 10, 200, 5, properties)
    jdbc.read_by_predicates(session, "url", "t", ["amt < 5"], properties)
    assert reader.calls[0] == (("url", "t"), {"properties": properties})
    assert reader.calls[1][1] == {
        "column": "amt", "lowerBound": 10, "upperBound": 200, "numPartitions": 5, "properties": properties,
    }
    assert reader.calls[2][1] == {"predicates": ["amt < 5"], "properties": properties}


def test_upsert_statements():
    text = jdbc.upsert_statement("heat", "heat_new", ["longitude", "latitude"], ["longitude", "latitude", "total_count"])
    assert text == (
        "MERGE INTO heat t USING heat_new s ON t.longitude = s.longitude AND t.latitude = s.latitude"
        " WHEN MATCHED THEN UPDATE SET total_count = s.total_count"
        " WHEN NOT MATCHED THEN INSERT (longitude, latitude, total_count)"
        " VALUES (s.longitude, s.latitude, s.total_count)"
    )
    names = ["k", "v"]
    assert jdbc.upsert_statement("t", "s", ["k"], names, "mysql") == (
        "INSERT INTO t (k, v) SELECT k, v FROM s ON DUPLICATE KEY UPDATE v = VALUES(v)"
    )
    assert jdbc.upsert_statement("t", "s", ["k"], names, "postgresql") == (
        "INSERT INTO t (k, v) SELECT k, v FROM s ON CONFLICT (k) DO UPDATE SET v = EXCLUDED.v"
    )
    assert jdbc.upsert_statement("t", "s", ["k"], ["k"], "postgresql").endswith("DO NOTHING")
    with pytest.raises(ValueError, match="dialect"):
        jdbc.upsert_statement("t", "s", ["k"], names, "other")
    assert "MATCHED THEN UPDATE" not in jdbc.upsert_statement("a", "b", ["k"], ["k"])


def test_topic_options():
    assert log_topics.topic_options("h:1", ["a", "b"], max_records=10) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "latest", "maxOffsetsPerTrigger": "10",
    }
    assert "maxOffsetsPerTrigger" not in log_topics.topic_options("h:1", ["a"])
