"""The test tables as road readings."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspeed.operators import normalise_time, slot_mean, to_bronze
from roadspeed.session import adopt, scratch_path
from roadspeed.sources.archives import file_opener
from roadspeed.sources.csv_days import RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return adopt(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw_readings(spark: SparkSession, sf_dir: str, link: str) -> DataFrame:
    """Events as raw text readings; ``link`` is the column that names the road link."""
    text = table(spark, sf_dir, "events").select(
        (F.year("ts") * 10000 + F.month("ts") * 100 + F.dayofmonth("ts")).cast("string").alias("CREATDE"),
        F.lpad((F.hour("ts") * 100 + F.minute("ts")).cast("string"), 4, "0").alias("CREATHM"),
        F.col(link).cast("string").alias("LINKID"),
        F.col("event_type").alias("ROADINSTTCD"),
        F.col("value").cast("string").alias("PASNGSPED"),
        F.get_json_object("props", "$.k").alias("PASNGTIME"),
    )
    return text.withColumn("date", F.col("CREATDE"))


def raw_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many sparse links."""
    return raw_readings(spark, sf_dir, "user_id")


def raw_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few dense links."""
    return raw_readings(spark, sf_dir, "event_type")


def silver(raw: DataFrame) -> DataFrame:
    return slot_mean(normalise_time(to_bronze(raw)))


def gold_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(raw_by_type(spark, sf_dir)).select("date", "datetime", "linkid", "self_mean")


def channels_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five different measures per event type and slot; the last one has gaps of its own."""
    k = F.get_json_object("props", "$.k").cast("double")
    slot = F.window(F.col("ts").cast("timestamp"), "5 minutes")["start"]
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("linkid"), slot.alias("datetime")).agg(
        F.min("value").alias("t2_mean"), F.max("value").alias("t1_mean"), F.avg("value").alias("self_mean"),
        F.avg(k).alias("f1_mean"), F.avg(F.when(k % 2 == 1, F.col("value"))).alias("f2_mean"),
    )


def price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices per supplier and ship date: many links on a daily grid."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("linkid"),
        F.col("l_shipdate").cast("timestamp").alias("datetime"),
        F.col("l_extendedprice").alias("self_mean"),
    )


def first_last_day(raw: DataFrame) -> tuple[str, str]:
    return tuple(raw.agg(F.min("date"), F.max("date")).first())


def dirty_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings by type with, in every ten, an impossible time, a day of another date, a bad day and a short time."""
    form = F.pmod("event_id", F.lit(10))
    minutes = F.hour("ts") * 100 + F.minute("ts")
    day = F.date_format("ts", "yyyyMMdd")
    return table(spark, sf_dir, "events").select(
        F.when(form == 1, F.date_format(F.date_add("ts", 1), "yyyyMMdd")).when(form == 2, "20x51113").otherwise(day).alias("CREATDE"),
        F.when(form == 0, "2599").when(form == 3, minutes.cast("string")).otherwise(F.lpad(minutes.cast("string"), 4, "0")).alias("CREATHM"),
        F.col("event_type").alias("LINKID"), F.lit("R").alias("ROADINSTTCD"), F.col("value").cast("string").alias("PASNGSPED"),
        F.get_json_object("props", "$.k").alias("PASNGTIME"), day.alias("date"),
    )


def csv_lake(raw: DataFrame, base: str | None = None) -> str:
    """Raw CSV files by day in a new folder; the last day has its columns in reverse order."""
    base = base or scratch_path(raw.sparkSession, "csv")
    _, last = first_last_day(raw)
    plain, turned = raw.filter(F.col("date") != last), raw.filter(F.col("date") == last)
    for part, columns in ((plain, RAW_COLUMNS), (turned, RAW_COLUMNS[::-1])):
        part.select(*columns, "date").write.mode("append").partitionBy("date").option("header", True).csv(base)
    return base


def csv_files(raw: DataFrame, base: str) -> None:
    """The rows as one CSV file ``part-<file>.csv`` for each day and value of ``file``; files of that name are replaced.

    Every task writes its own files whole, aside first, as a landing job does.
    """
    locate, columns = file_opener(), list(RAW_COLUMNS)

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        store, folder = locate(f"{base}/date={key[0]}")
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/.part-{key[1]}") as out:
            out.write(rows[columns].to_csv(index=False).encode())
        store.move(f"{folder}/.part-{key[1]}", f"{folder}/part-{key[1]}.csv")
        return pd.DataFrame({"rows": [len(rows)]})

    raw.groupBy("date", "file").applyInPandas(write, "rows long").agg({"rows": "sum"}).collect()


def zip_archives(raw: DataFrame) -> str:
    """Raw readings as archives ``<day>_<task>.zip``, each with one CSV file, in a new folder.

    Every task writes its own archives, one open at a time, so a hot day is spread over tasks.
    """
    base = scratch_path(raw.sparkSession, "zip")
    locate = file_opener()
    columns = list(RAW_COLUMNS)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zipfile
        from contextlib import ExitStack

        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        store, folder = locate(base)
        store.create_dir(folder, recursive=True)
        day, count, files, member = None, 0, ExitStack(), None
        for batch in batches:
            for date, rows in batch.groupby("date"):
                if date != day:
                    if day is not None:
                        files.close()
                        yield pd.DataFrame({"date": [day], "rows": [count]})
                    day, count, files = date, 0, ExitStack()
                    out = files.enter_context(store.open_output_stream(f"{folder}/{day}_{task:05d}.zip"))
                    packed = files.enter_context(zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED))
                    # All archives of a day hold members of two names, so that names clash.
                    member = files.enter_context(packed.open(f"part_{task % 2}.csv", "w"))
                    member.write((",".join(columns) + "\n").encode())
                member.write(rows[columns].to_csv(index=False, header=False).encode())
                count += len(rows)
        if day is not None:
            files.close()
            yield pd.DataFrame({"date": [day], "rows": [count]})

    # Sorted in the task, so that a day's rows are adjacent and its archive is opened once.
    raw.sortWithinPartitions("date").mapInPandas(pack, "date string, rows long").agg(F.sum("rows")).collect()
    return base
