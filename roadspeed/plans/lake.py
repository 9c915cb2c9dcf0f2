"""Raw to bronze to silver to gold, each as one lazy plan over all requested days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadspeed.operators.gold import conform_gold
from roadspeed.operators.readings import BRONZE_SCHEMA, SILVER_SCHEMA, normalise_time, slot_mean, to_bronze
from roadspeed.plans.config import LakeConfig
from roadspeed.sinks import WriteReport, replace_days_jdbc, write_days
from roadspeed.sources import day_list, existing_days, read_days, read_gold, read_raw_csv
from roadspeed.versions import VersionedDays

GOLD_SCHEMA = "date string, datetime timestamp, linkid string, self_mean double"


def _processed(spark: SparkSession, cfg: LakeConfig, zone: str, start: str, end: str) -> tuple[list[str], list[str]]:
    """The days whose source exists, which are replaced even if they end empty, and the others, which stay."""
    days = day_list(start, end)
    if cfg.versioned and zone != "raw":
        there = sorted(set(days) & set(VersionedDays(spark, cfg.zone(zone)).days()))
    else:
        there = existing_days(spark, cfg.zone(zone), days)
    return there, sorted(set(days) - set(there))


def write_zone(cfg: LakeConfig, zone: str, df: DataFrame, days: list[str], **how) -> WriteReport:
    """Replace days of bronze, silver or gold, in whichever form the lake keeps them."""
    if cfg.versioned:
        return VersionedDays(df.sparkSession, cfg.zone(zone)).write(df, days, **how)
    return write_days(df, cfg.zone(zone), days, **how)


def zone_rows(spark: SparkSession, cfg: LakeConfig, zone: str, start: str, end: str) -> DataFrame:
    """The days start..end of bronze, silver or gold, in whichever form the lake keeps them."""
    schema = {"bronze": BRONZE_SCHEMA, "silver": SILVER_SCHEMA, "gold": GOLD_SCHEMA}[zone]
    if cfg.versioned:
        return VersionedDays(spark, cfg.zone(zone)).read(start, end, schema)
    return read_days(spark, cfg.zone(zone), start, end, schema)


def raw_to_bronze(spark: SparkSession, cfg: LakeConfig, start: str, end: str) -> WriteReport:
    raw = read_raw_csv(spark, cfg.zone("raw"), start, end, encoding=cfg.encoding)
    fixed = cfg.bronze_files_per_day
    days, absent = _processed(spark, cfg, "raw", start, end)
    return write_zone(cfg, "bronze", to_bronze(raw), days, files_per_day=fixed, as_read=fixed is None, absent=absent)


def silver_rows(bronze: DataFrame, cfg: LakeConfig) -> DataFrame:
    timed = normalise_time(bronze, cfg.links, cfg.drop_invalid_time)
    return slot_mean(timed, step=cfg.step).select("datetime", "linkid", "self_mean", "date")


def bronze_to_silver(spark: SparkSession, cfg: LakeConfig, start: str, end: str) -> WriteReport:
    bronze = zone_rows(spark, cfg, "bronze", start, end)
    by = "datetime" if cfg.silver_files_per_day else None
    days, absent = _processed(spark, cfg, "bronze", start, end)
    return write_zone(
        cfg, "silver", silver_rows(bronze, cfg), days, files_per_day=cfg.silver_files_per_day, by=by, absent=absent
    )


def silver_to_gold(spark: SparkSession, cfg: LakeConfig, start: str, end: str) -> None:
    gold = conform_gold(zone_rows(spark, cfg, "silver", start, end))
    days, _ = _processed(spark, cfg, "silver", start, end)
    if cfg.jdbc is None:
        write_zone(cfg, "gold", gold, days, as_read=True)
    else:
        replace_days_jdbc(gold, cfg.jdbc, days)


def gold_rows(spark: SparkSession, cfg: LakeConfig, start: str, end: str) -> DataFrame:
    if cfg.jdbc is None:
        return zone_rows(spark, cfg, "gold", start, end)
    return read_gold(spark, cfg.jdbc, start, end, cfg.jdbc_slices_per_day)
