"""Day replacement in a JDBC table."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from roadspeed.sources.gold_jdbc import SPARK_ONLY, quoting

GOLD_COLUMNS = ("date", "datetime", "linkid", "self_mean")

# Fixed widths of the gold contract; plain text columns could not be compared in a DELETE everywhere.
_COLUMN_TYPES = "date VARCHAR(8), linkid VARCHAR(20)"
_DAYS_PER_DELETE = 500
_CONNECTIONS = "16"


def replace_days_jdbc(
    df: DataFrame,
    jdbc: dict[str, str],
    days: Iterable[str],
    date_col: str = "date",
    staging: str | None = None,
) -> None:
    """Replace the rows of ``days`` by those of ``df``, in one transaction. An absent table is created first.

    Executors fill a staging table in parallel; the target then changes through DELETE and
    INSERT ... SELECT that commit together, so a failure leaves the old rows in place. DISTINCT
    removes the copies that a task retried after a lost executor may leave in staging (gold rows
    are unique by day, time and link).
    """
    table = jdbc["dbtable"]
    staging = staging or f"{table}_staging_{uuid.uuid4().hex[:12]}"
    quote = quoting(df.sparkSession, jdbc["url"])
    names = ", ".join(quote(c) for c in df.columns)
    _ensure(df, jdbc)
    connection = _connect(df.sparkSession, jdbc)
    try:
        _stage(df, jdbc, staging)
        connection.setAutoCommit(False)
        try:
            wanted = sorted(set(days))
            for i in range(0, len(wanted), _DAYS_PER_DELETE):
                part = wanted[i : i + _DAYS_PER_DELETE]
                marks = ", ".join("?" * len(part))
                _run(connection, f"DELETE FROM {table} WHERE {quote(date_col)} IN ({marks})", part)
            _run(connection, f"INSERT INTO {table} ({names}) SELECT DISTINCT {names} FROM {staging}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.setAutoCommit(True)
    finally:
        # A failed write may have made the staging table or not.
        _run(connection, f"DROP TABLE IF EXISTS {staging}")
        connection.close()


def _stage(df: DataFrame, jdbc: dict[str, str], staging: str) -> None:
    _write(df, jdbc, staging, "overwrite")


def _ensure(df: DataFrame, jdbc: dict[str, str]) -> None:
    """Create the target without rows unless it is there."""
    _write(df.limit(0), jdbc, jdbc["dbtable"], "ignore")


def _write(df: DataFrame, jdbc: dict[str, str], table: str, mode: str) -> None:
    # Connections don't grow with the tasks.
    properties = {"numPartitions": _CONNECTIONS} | {k: v for k, v in jdbc.items() if k not in ("url", "dbtable")}
    types = ", ".join(t for t in _COLUMN_TYPES.split(", ") if t.split()[0] in df.columns)
    writer = df.write.mode(mode)
    if types:
        writer = writer.option("createTableColumnTypes", types)
    writer.jdbc(jdbc["url"], table, properties=properties)


def _connect(spark: SparkSession, jdbc: dict[str, str]):
    """A java.sql.Connection of the driver's JVM."""
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for key, value in jdbc.items():
        if key not in ("url", "dbtable", "driver", *SPARK_ONLY):
            properties.setProperty(key, value)
    if "driver" in jdbc:
        # Spark's registry sees drivers added with --jars, which DriverManager alone does not.
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(jdbc["driver"])
    return jvm.java.sql.DriverManager.getConnection(jdbc["url"], properties)


def _run(connection, sql: str, values: Iterable[str] = ()) -> None:
    statement = connection.prepareStatement(sql)
    try:
        for place, value in enumerate(values, start=1):
            statement.setString(place, value)
        statement.executeUpdate()
    finally:
        statement.close()
