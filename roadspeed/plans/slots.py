"""Silver kept up to date file by file.

For each raw file the lake keeps the totals and counts of its slots (zone ``slots``, by day and file). A new, late or corrected
file replaces its own rows there, and the silver days it touches are the sums over their files. So an update reads the changed
files and the totals of their days, never the other raw files, and doing it again changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from roadspeed.operators.readings import merged_mean, normalise_time, slot_sums, to_bronze
from roadspeed.plans.config import LakeConfig
from roadspeed.plans.lake import write_zone
from roadspeed.session import path_exists, remove_path
from roadspeed.sinks import WriteReport
from roadspeed.sources import existing_days, read_raw_csv

_SUMS = "datetime timestamp, linkid string, total double, n bigint, date string, source string"
_LEDGER = "file string, size bigint, modified timestamp, date string, source string"
_FILE = ["date", "source", "file", "size", "modified"]


def file_columns() -> list[Column]:
    """date, source, file, size, modified of a file, from the columns of the binary file source.

    ``file`` is the name as Spark gives it, with escapes; ``source`` stands for it in the names of folders.
    """
    name = F.col("_metadata.file_name")
    return [
        F.regexp_extract("path", "/date=([^/]+)/[^/]+$", 1).alias("date"), _source(name).alias("source"), name.alias("file"),
        F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
    ]


def _source(file: Column) -> Column:
    return F.md5(file.cast("binary"))


def raw_files(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """The files that lie in the raw day folders themselves; none is opened."""
    place = f"{cfg.zone('raw')}/date=*/*.csv"
    if not path_exists(spark, place):
        return spark.createDataFrame([], _LEDGER).select(*_FILE)
    return spark.read.format("binaryFile").load(place).select(*file_columns())


def changed_files(spark: SparkSession, cfg: LakeConfig) -> tuple[DataFrame, DataFrame]:
    """The raw files that silver does not hold in this form, and those that it holds but are gone."""
    now, known = raw_files(spark, cfg), cfg.zone("slots/files")
    if not path_exists(spark, known):
        return now, now.limit(0)
    seen = spark.read.schema(_LEDGER).parquet(known).select(*_FILE)
    return now.join(seen, _FILE, "left_anti"), seen.join(now, ["date", "source"], "left_anti")


def _totals(spark: SparkSession, cfg: LakeConfig, days: Iterable[str]) -> DataFrame:
    base = cfg.zone("slots/sums")
    paths = [f"{base}/date={day}" for day in existing_days(spark, base, days)]
    if not paths:
        return spark.createDataFrame([], _SUMS)
    return spark.read.schema(_SUMS).option("basePath", base).parquet(*paths)


def _by_day(files: DataFrame | None) -> dict[str, list[Row]]:
    out: dict[str, list[Row]] = {}
    for row in files.select("date", "source", "file").distinct().collect() if files is not None else []:
        out.setdefault(row["date"], []).append(row)
    return out


def apply_files(spark: SparkSession, cfg: LakeConfig, files: DataFrame, gone: DataFrame | None = None) -> WriteReport:
    """Bring the given raw files (with ``file_columns``) into silver, and take those that are gone out of it.

    The list of files goes to the driver, as the list of a read does; their rows do not.
    """
    listed, left = _by_day(files), _by_day(gone)
    days = sorted({*listed, *left})
    if not days:
        return WriteReport(0)
    base, ledger = cfg.zone("slots/sums"), cfg.zone("slots/files")
    # Removed first, as a file without usable rows makes no folder that the write would replace.
    for row in chain(*listed.values(), *left.values()):
        remove_path(spark, f"{base}/date={row['date']}/source={row['source']}")
    if listed:
        names = {day: [unquote(row["file"]) for row in rows] for day, rows in listed.items()}
        raw = read_raw_csv(
            spark, cfg.zone("raw"), min(names), max(names), encoding=cfg.encoding, files=names, source="source"
        ).withColumn("source", _source(F.col("source")))
        readings = normalise_time(to_bronze(raw, ["source"]), cfg.links, cfg.drop_invalid_time, ["source"])
        sums = slot_sums(readings, step=cfg.step).hint("rebalance", "date", "source")
        _replace(sums, base)

    merged = merged_mean(_totals(spark, cfg, days)).select("datetime", "linkid", "self_mean", "date")
    report = write_zone(cfg, "silver", merged, days)
    # Last: files whose update has failed on the way count as changed still.
    _replace(files.select("file", "size", "modified", "date", "source"), ledger)
    for row in chain(*left.values()):
        remove_path(spark, f"{ledger}/date={row['date']}/source={row['source']}")
    return report


def _replace(df: DataFrame, base: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "source").parquet(base)


def refresh_silver(spark: SparkSession, cfg: LakeConfig) -> WriteReport:
    """Bring every new, late, corrected or removed raw file into silver; other days stay."""
    return apply_files(spark, cfg, *changed_files(spark, cfg))
