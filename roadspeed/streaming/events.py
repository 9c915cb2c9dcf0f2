"""File-arrival events for a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVENT_SCHEMA = "date string, bucket string, key string, size bigint"


def file_events(landed: DataFrame, bucket: str, prefix: str = "") -> DataFrame:
    """One event per landed file (columns date, key, size)."""
    key = F.concat(F.lit(f"{prefix.rstrip('/')}/"), F.col("key")) if prefix else F.col("key")
    return landed.select(
        F.col("date").cast("string"), F.lit(bucket).alias("bucket"), key.alias("key"), F.col("size").cast("long")
    )


def event_values(events: DataFrame) -> DataFrame:
    """The messages: one JSON object per row in column ``value``."""
    return events.select(F.to_json(F.struct("date", "bucket", "key", "size")).alias("value"))


def publish_events(events: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send one message per event; returns when the broker has acknowledged all of them."""
    (
        event_values(events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )
