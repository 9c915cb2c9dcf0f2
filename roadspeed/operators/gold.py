"""Gold contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Older column names and the names they have in gold.
OLD_NAMES = {"LINKID": "linkid", "DATETIME_5MIN": "datetime", "datetime_5min": "datetime"}

# Channel order of the training input.
CHANNELS = ("t2_mean", "t1_mean", "self_mean", "f1_mean", "f2_mean")

# The columns that lead.
_LEAD = ("date", "datetime", "linkid")


def conform_gold(silver: DataFrame, day: str | None = None) -> DataFrame:
    """Current names, keys first. ``day`` sets the date of a frame that has no such column."""
    # Exact names only: Spark's own rename ignores case and would touch columns that are right already.
    names = [OLD_NAMES.get(c, c) for c in silver.columns]
    named = silver.toDF(*names)
    if day is not None:
        named = named.withColumn("date", F.lit(day))
    lead = [c for c in _LEAD if c in named.columns]
    return named.select(*lead, *[c for c in named.columns if c not in lead])


def five_channels(gold: DataFrame, value: str = "self_mean") -> DataFrame:
    """datetime, linkid and one measure repeated as five channels."""
    return gold.select("datetime", "linkid", *[F.col(value).alias(c) for c in CHANNELS])
