"""Compare registered queries with their SQL twins on a data directory.

Usage: python tests/compare.py DATA_DIR [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def local_session(cpus: int = 8) -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallywork-tests")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value: object) -> object:
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).decode()
    return str(value)


def canonical(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    return sorted(tuple(_cell(row[index]) for index in order) for row in rows)


def differences(spark: SparkSession, connection, sf_dir: str, name: str, query, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = query(spark, sf_dir)
    mine = canonical(frame.columns, [tuple(row) for row in frame.collect()])
    result = connection.execute(sql)
    names = [item[0] for item in result.description]
    theirs = canonical(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"{name}: columns {frame.columns} and {names}"
    if len(mine) != len(theirs):
        return f"{name}: {len(mine)} and {len(theirs)} rows"
    for left, right in zip(mine, theirs):
        if left != right:
            return f"{name}: {left} and {right}"
    return None


def main() -> None:
    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, connection = local_session(), oracle(sf_dir)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name in sqls:
                problem = differences(spark, connection, sf_dir, name, query, sqls[name])
            else:
                problem = None if query(spark, sf_dir).count() else f"{name}: no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{name}: {type(error).__name__} {str(error)[:600]}"
        print(f"{time.time() - started:6.2f}s {'ok   ' if problem is None else 'FAIL '} {problem or name}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
