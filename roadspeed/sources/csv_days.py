"""Raw CSV files below ``date=yyyyMMdd/``."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadspeed.session import path_exists
from roadspeed.sources.days import day_list

# The columns of a raw file.
RAW_COLUMNS = ("CREATDE", "CREATHM", "LINKID", "ROADINSTTCD", "PASNGSPED", "PASNGTIME")

_PROBES = 16


def read_raw_csv(
    spark: SparkSession,
    base: str,
    start: str,
    end: str,
    columns: tuple[str, ...] = RAW_COLUMNS,
    encoding: str = "UTF-8",
    glob: str = "*.csv",
    files: dict[str, list[str]] | None = None,
    source: str | None = None,
) -> DataFrame:
    """Rows of the days start..end as text columns selected by header name, plus ``date``.

    Days may order their columns differently, so each day's header is looked up (one line read
    per day) and days with equal headers share one scan. Within a scan every file's header is
    checked; a differing one raises instead of swapping columns. A day without files has no rows.

    ``files`` gives the names of the files to read by day, instead of all that fit ``glob``. ``source`` names a further
    column for the file that a row comes from.
    """
    read = spark.read.option("header", True).option("encoding", encoding)

    def paths(day: str) -> list[str]:
        # A glob, as a folder would be searched through all its subfolders.
        names = [glob] if files is None else files.get(day, [])
        found = [f"{base}/date={day}/{name}" for name in names]
        return found if files is not None or path_exists(spark, found[0]) else []

    @inheritable_thread_target(spark)
    def header(day: str) -> tuple[str, ...]:
        return tuple(read.csv(found).columns) if (found := paths(day)) else ()

    days = day_list(start, end) if files is None else [day for day in sorted(files) if start <= day <= end]
    with ThreadPoolExecutor(_PROBES) as pool:
        headers = list(pool.map(header, days))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for day, names in zip(days, headers):
        if names:
            layouts.setdefault(names, []).append(day)

    def scan(names: tuple[str, ...], members: list[str]) -> DataFrame:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, "date")])
        return (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("encoding", encoding)
            .option("basePath", base)
            .csv([path for d in members for path in paths(d)])
            .select(*columns, "date", *([F.col("_metadata.file_name").alias(source)] if source else []))
        )

    if not layouts:
        names = (*columns, "date", *([source] if source else []))
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return reduce(DataFrame.unionByName, [scan(n, m) for n, m in layouts.items()])
