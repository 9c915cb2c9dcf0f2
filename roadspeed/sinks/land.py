"""Copy archived files into the raw lake."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadspeed.session import materialise, qualified
from roadspeed.sources.archives import by_member, file_opener, list_members, safe_member
from roadspeed.sources.days import landed_files

_CHUNK = 1 << 20


def keyed(members: DataFrame) -> DataFrame:
    """Members with ``key``, their place in the lake: ``date=D/<member>``.

    Where archives of a day hold members of one name, the archive's name and a hash of its path stand before the file
    name, so none replaces another.
    """
    shared = F.count(F.lit(1)).over(Window.partitionBy("date", "member")) > 1
    stem = F.regexp_extract("archive", r"([^/]*?)(\.[^./]*)?$", 1)
    mark = F.concat(stem, F.lit("_"), F.lower(F.hex(F.xxhash64("archive"))), F.lit("_"))
    folder, name = F.regexp_extract("member", "^(.*/)?([^/]*)$", 1), F.regexp_extract("member", "^(.*/)?([^/]*)$", 2)
    own = F.when(shared, F.concat(folder, mark, name)).otherwise(F.col("member"))
    return members.withColumn("key", F.concat(F.lit("date="), "date", F.lit("/"), own))


def pending_members(spark: SparkSession, archives: str, lake: str, days: Iterable[str], glob: str = "*.zip") -> DataFrame:
    """Members of the days' archives that the lake doesn't hold in full size: date, archive, member, size, key."""
    days = list(days)
    there = landed_files(spark, lake, days).select("key", "size")
    return keyed(list_members(spark, archives, glob, days)).join(there, ["key", "size"], "left_anti")


def land_zip(
    spark: SparkSession, archives: str, lake: str, glob: str = "*.zip", days: Iterable[str] | None = None
) -> DataFrame:
    """Copy archived files to the lake and return what landed: date, key, size.

    With ``days``, only files of those days that the lake does not hold yet are copied, so a run that broke off is
    completed by the next, and archives of other days are not opened; else every file is copied. A file is written
    beside its place and then moved, so a retried or lost task leaves no half file. Member names that would leave their
    day's folder raise.
    """
    locate = file_opener()
    lake = qualified(spark, lake).rstrip("/")

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import posixpath
        import shutil
        import uuid
        import zipfile

        for batch in batches:
            for date, archive, member, key in zip(batch["date"], batch["archive"], batch["member"], batch["key"]):
                safe_member(archive, member)
                source, path = locate(archive)
                target, place = locate(f"{lake}/{key}")
                folder, name = posixpath.split(place)
                target.create_dir(folder, recursive=True)
                # Names that start with an underscore are invisible to Spark readers.
                part = f"{folder}/_{name}.{uuid.uuid4().hex}"
                try:
                    with source.open_input_file(path) as raw, zipfile.ZipFile(raw) as packed:
                        with packed.open(member) as data, target.open_output_stream(part) as out:
                            shutil.copyfileobj(data, out, _CHUNK)
                        size = packed.getinfo(member).file_size
                    target.move(part, place)
                except BaseException:
                    if target.get_file_info(part).is_file:
                        target.delete_file(part)
                    raise
                yield pd.DataFrame({"date": [date], "key": [key], "size": [size]})

    if days is None:
        members = keyed(list_members(spark, archives, glob))
    else:
        members = pending_members(spark, archives, lake, days, glob)
    chosen = by_member(members).select("date", "archive", "member", "key")
    landed = chosen.mapInPandas(copy, "date string, key string, size long")
    # Written once, so that reading the result again does not copy again.
    return materialise(landed.withColumn("lake", F.lit(lake)), "landed")
