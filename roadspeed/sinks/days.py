"""Day-partitioned Parquet with day-level replacement."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from roadspeed.session import spread_tasks


@dataclass(frozen=True)
class WriteReport:
    rows: int
    days: list[str] = field(default_factory=list)
    empty_days: list[str] = field(default_factory=list)
    absent_days: list[str] = field(default_factory=list)


def write_days(
    df: DataFrame,
    base: str,
    days: Iterable[str] = (),
    files_per_day: int | None = None,
    by: str | None = None,
    as_read: bool = False,
    absent: Iterable[str] = (),
) -> WriteReport:
    """Replace the days found in ``df`` (column ``date``); other days below ``base`` stay.

    ``days`` are the processed days: one that ends without rows is replaced by an empty
    directory, as dynamic overwrite alone would keep its old rows. ``absent`` days, which have no
    source, are only reported.

    By default the files are sized by Spark: REBALANCE gives a small day one file and splits a
    large one, so no task writes a whole hot day. ``files_per_day`` fixes the number instead,
    spreading rows by the hash of ``by`` (or evenly without it). ``as_read`` skips the shuffle: it
    suits rows that come straight from a scan of day directories, where a task holds one or a few
    days anyway.
    """
    rows, found = written(df, base, files_per_day, by, as_read, replace=True)
    missing = sorted(set(days) - set(found))
    for day in missing:
        df.drop("date").limit(0).write.mode("overwrite").parquet(f"{base}/date={day}")
    return WriteReport(rows, found, missing, sorted(absent))


def written(
    df: DataFrame, base: str, files_per_day: int | None, by: str | None, as_read: bool, replace: bool
) -> tuple[int, list[str]]:
    """Write day folders below ``base``, laid out as ``write_days`` says; the number of rows and the days found.

    With ``replace`` the days found are replaced in place, else nothing may exist there.
    """
    if as_read:
        laid_out = df
    elif files_per_day is None:
        laid_out = df.hint("rebalance", "date")
    else:
        # Without a column the whole row decides, which is the same on a retried task.
        spread = [F.col(by)] if by else [F.col(c) for c in df.columns]
        bucket = F.pmod(F.xxhash64(*spread), F.lit(files_per_day))
        laid_out = df.repartition(spread_tasks(df.sparkSession), "date", bucket)

    # Counted while writing: no extra pass. Distinct days are bounded by the calendar.
    seen = Observation()
    counted = laid_out.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set("date").alias("days"))
    writer = counted.write.partitionBy("date")
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(base)
    return seen.get["rows"], sorted(seen.get["days"])
