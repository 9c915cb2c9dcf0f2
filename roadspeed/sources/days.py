"""Days of a day-partitioned lake."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadspeed.session import path_exists


def day_list(start: str, end: str) -> list[str]:
    """Every ``yyyyMMdd`` from start to end, both included; empty when end is earlier."""
    first, last = (datetime.strptime(d, "%Y%m%d") for d in (start, end))
    return [(first + timedelta(days=i)).strftime("%Y%m%d") for i in range((last - first).days + 1)]


def day_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The same days as a frame with one string column ``date``."""
    first, last = F.to_date(F.lit(start), "yyyyMMdd"), F.to_date(F.lit(end), "yyyyMMdd")
    # The condition matters: a sequence refuses an end before its start.
    days = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY")))
    return spark.range(1).select(F.explode(days).alias("day")).select(F.date_format("day", "yyyyMMdd").alias("date"))


def existing_days(spark: SparkSession, base: str, days: Iterable[str]) -> list[str]:
    """Those of the days that have a folder below ``base``; no other folder is looked at."""
    return [day for day in days if path_exists(spark, f"{base.rstrip('/')}/date={day}")]


def read_days(
    spark: SparkSession, base: str, start: str, end: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Parquet rows of the days start..end; other day directories are pruned, not read.

    With a schema no footer is opened for inference, and only the folders of the days are listed.
    Without one, the inferred integer type of the partition column is replaced by string.
    """
    if schema is None:
        found = spark.read.parquet(base).schema
        schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "date" else f for f in found])
        return spark.read.schema(schema).parquet(base).filter(F.col("date").between(start, end))
    paths = [f"{base.rstrip('/')}/date={day}" for day in existing_days(spark, base, day_list(start, end))]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def landed_files(spark: SparkSession, base: str, days: Iterable[str] | None = None, glob: str = "*") -> DataFrame:
    """(date, key, size) of every file below ``base/date=*/``, or below the folders of ``days`` alone.

    ``key`` is the path below ``base``. File contents are not read.
    """
    base = base.rstrip("/")
    if days is None:
        paths = [base] if path_exists(spark, base) else []
    else:
        paths = [f"{base}/date={day}" for day in existing_days(spark, base, days)]
    if not paths:
        return spark.createDataFrame([], "date string, key string, size long")
    # Paths come back with escapes, so the key is cut from the last day folder on.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(paths)
    key = F.regexp_extract("path", "/(date=[^/]+/.*)$", 1)
    day = F.regexp_extract("path", "/date=([^/]+)/", 1)
    return files.select(day.alias("date"), key.alias("key"), F.col("length").alias("size")).filter("date != ''")


def landed_days(spark: SparkSession, base: str, glob: str = "*", days: Iterable[str] | None = None) -> DataFrame:
    """Days with at least one file below ``base/date=*/``; file contents are not read."""
    return landed_files(spark, base, days, glob).select("date").distinct()


def pending_days(requested: DataFrame, landed: DataFrame) -> DataFrame:
    """Requested days without landed data."""
    return requested.join(landed.select("date").distinct(), "date", "left_anti")
