"""JDBC tables: three ways to read, and an upsert.

No database runs where this library is developed, so these thin wrappers are
covered by tests of the calls and statements they make, not by a live database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_whole(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    """The table in one partition; only for tables one task can read."""
    return spark.read.jdbc(url, table, properties=properties)


def read_bounded(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str],
) -> DataFrame:
    """The whole table in equal strides of a numeric column.

    The bounds set the stride and filter nothing: values outside them pile up in
    the first and the last partition.
    """
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=properties,
    )


def read_by_predicates(
    spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict[str, str]
) -> DataFrame:
    """One partition per predicate; rows that match none are not read."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def upsert_statement(
    table: str, staging: str, keys: list[str], columns: list[str], dialect: str = "standard"
) -> str:
    """One statement that inserts or replaces from a staging table, by dialect.

    `standard` is MERGE; `mysql` and `postgresql` need a unique index on the keys.
    """
    names = ", ".join(columns)
    values = [name for name in columns if name not in keys]
    if dialect == "mysql":
        update = ", ".join(f"{name} = VALUES({name})" for name in values or keys[:1])
        return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON DUPLICATE KEY UPDATE {update}"
    if dialect == "postgresql":
        update = ", ".join(f"{name} = EXCLUDED.{name}" for name in values)
        then = f"DO UPDATE SET {update}" if values else "DO NOTHING"
        return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON CONFLICT ({', '.join(keys)}) {then}"
    if dialect != "standard":
        raise ValueError(f"unknown dialect {dialect}")
    match = " AND ".join(f"t.{key} = s.{key}" for key in keys)
    update = ", ".join(f"{name} = s.{name}" for name in values)
    source = ", ".join(f"s.{name}" for name in columns)
    matched = f" WHEN MATCHED THEN UPDATE SET {update}" if values else ""
    return (
        f"MERGE INTO {table} t USING {staging} s ON {match}{matched}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({source})"
    )


def upsert_table(
    df: DataFrame, url: str, table: str, staging: str, keys: list[str], properties: dict[str, str],
    dialect: str = "standard",
) -> None:
    """Insert or replace rows by key: parallel write to a staging table, then one statement.

    `df` must hold one row per key (see `operators.upsert.latest_per_key`). The
    target changes in a single statement, so a failed task changes nothing, and
    errors fail the job. Running it again gives the same table. The staging
    table is dropped in the end.
    """
    df.write.jdbc(url, staging, mode="overwrite", properties=properties)
    _execute(df.sparkSession, url, properties, upsert_statement(table, staging, keys, df.columns, dialect))
    _execute(df.sparkSession, url, properties, f"DROP TABLE {staging}")


def _execute(spark: SparkSession, url: str, properties: dict[str, str], statement: str) -> None:
    """Run one statement from the driver, through the JVM's JDBC driver manager."""
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for name, value in properties.items():
        settings.setProperty(name, value)
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        prepared = connection.createStatement()
        try:
            prepared.executeUpdate(statement)
        finally:
            prepared.close()
    finally:
        connection.close()
