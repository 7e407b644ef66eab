"""Every registered query against its SQL twin, and the shape of some plans."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import differences, oracle
from rows import final_plan

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    query = entry.queries()[name]
    assert differences(spark, connection, SF_DIR, name, query, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_every_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


OTHERS = ("stream_", "daily", "offset", "op", "pipeline")
BATCH = [name for name in sorted(entry.queries()) if not name.startswith(OTHERS)]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join(spark, name):
    plan = final_plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("word_count", "text:string"),
        ("count_by_key", "event_type:string"),
        ("ratings_stats", "l_partkey:bigint,l_quantity:double"),
        ("group_topk_rank", "l_extendedprice:double,l_returnflag:string"),
        ("json_extract", "event_id:bigint,props:string"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in final_plan(entry.queries()[name](spark, SF_DIR))
