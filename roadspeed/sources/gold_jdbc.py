"""Gold table behind JDBC."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from roadspeed.sources.days import day_list


# Settings of Spark's reader and writer that are no connection properties.
SPARK_ONLY = ("numPartitions", "batchsize", "fetchsize", "isolationLevel", "truncate")


def quoting(spark: SparkSession, url: str) -> Callable[[str], str]:
    """How the database behind the URL quotes a name."""
    return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier


def day_predicates(start: str, end: str, slices_per_day: int = 1, quote: Callable[[str], str] = str) -> list[str]:
    """Disjoint WHERE clauses that cover the days; each becomes one read partition.

    A large day is cut along ``datetime`` (which lies within its day) into equal slices; the
    first and last slice are open so that no row of the day is missed.
    """
    date, time = quote("date"), quote("datetime")
    clauses = []
    for day in day_list(start, end):
        first = datetime.strptime(day, "%Y%m%d")
        cuts = [first + i * timedelta(days=1) / slices_per_day for i in range(1, slices_per_day)]
        marks = [None, *[c.strftime("%Y-%m-%d %H:%M:%S.%f") for c in cuts], None]
        for low, high in zip(marks, marks[1:]):
            parts = [f"{date} = '{day}'"]
            parts += [f"{time} >= TIMESTAMP '{low}'"] if low else []
            parts += [f"{time} < TIMESTAMP '{high}'"] if high else []
            if not low and high:
                # NULL times belong to the first slice.
                parts[-1] = f"({parts[-1]} OR {time} IS NULL)"
            clauses.append(" AND ".join(parts))
    return clauses


def read_gold(
    spark: SparkSession, jdbc: dict[str, str], start: str, end: str, slices_per_day: int = 1
) -> DataFrame:
    """Gold rows of the days start..end, read in parallel by day.

    ``jdbc`` holds ``url``, ``dbtable`` and any further connection properties.
    """
    properties = {k: v for k, v in jdbc.items() if k not in ("url", "dbtable")}
    clauses = day_predicates(start, end, slices_per_day, quoting(spark, jdbc["url"]))
    return spark.read.jdbc(jdbc["url"], jdbc["dbtable"], predicates=clauses, properties=properties)
