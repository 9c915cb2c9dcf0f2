"""ZIP archives of raw files.

Spark has no ZIP codec, so members are expanded in Python. The unit of work is a member, not an
archive: the listing is spread over the cluster by member, and each task seeks to its member and
streams it. No archive or member is ever held in memory as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspeed.functions import day_from_path
from roadspeed.session import spread_tasks

_LINES_PER_BATCH = 20_000


def file_opener() -> Callable:
    """``open(uri)`` -> (Arrow file system, path); made on the driver, used inside tasks."""

    def locate(uri: str):
        from pyarrow import fs

        scheme, _, rest = uri.partition(":")
        if scheme == "file" or not rest:
            return fs.LocalFileSystem(), "/" + (rest or uri).lstrip("/")
        if scheme in ("s3a", "s3n"):
            uri = "s3:" + rest
        return fs.FileSystem.from_uri(uri)

    return locate


def safe_member(archive: str, member: str) -> str:
    """The member name, if it stays below the folder it is unpacked to; else ValueError."""
    parts = member.split("/")
    if not member or member.startswith("/") or "\\" in member or ":" in parts[0] or {"..", ".", ""} & set(parts):
        raise ValueError(f"unsafe member name {member!r} in {archive}")
    return member


def list_members(
    spark: SparkSession, archives: str, glob: str = "*.zip", days: Iterable[str] | None = None
) -> DataFrame:
    """One row per archived file: date, archive, member, size. Folder entries are left out.

    With ``days``, archives of other days are not opened.
    """
    locate = file_opener()

    def directory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zipfile

        for batch in batches:
            for archive in batch["archive"]:
                store, path = locate(archive)
                with store.open_input_file(path) as raw, zipfile.ZipFile(raw) as packed:
                    found = [m for m in packed.infolist() if not m.is_dir()]
                yield pd.DataFrame(
                    {
                        "archive": archive,
                        "member": [m.filename for m in found],
                        "size": pd.Series([m.file_size for m in found], dtype="int64"),
                    }
                )

    # The content column is not selected, so the scan lists paths without reading archives.
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(archives).select(F.col("path").alias("archive"))
    if days is not None:
        files = files.filter(day_from_path("archive").isin(list(days)))
    listed = files.repartition(spread_tasks(spark), "archive").mapInPandas(directory, "archive string, member string, size long")
    return listed.select(day_from_path("archive").alias("date"), "archive", "member", "size")


def by_member(members: DataFrame) -> DataFrame:
    """Spread members over tasks, so that one large archive is not one task."""
    return members.repartition(spread_tasks(members.sparkSession), "archive", "member")


def read_zip_members(spark: SparkSession, archives: str, glob: str = "*.csv", encoding: str = "UTF-8") -> DataFrame:
    """One row per text line: date, archive, member, line_no (1-based), line.

    ``glob`` is matched against the full member name; the default takes top-level CSV files
    only, as ``*`` does not cross a folder.
    """
    locate = file_opener()

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile
        from itertools import islice

        for batch in batches:
            for date, archive, member in zip(batch["date"], batch["archive"], batch["member"]):
                store, path = locate(archive)
                with store.open_input_file(path) as raw, zipfile.ZipFile(raw) as packed, packed.open(member) as data:
                    text = io.TextIOWrapper(data, encoding=encoding, newline=None)
                    first = 1
                    while chunk := [line.rstrip("\n") for line in islice(text, _LINES_PER_BATCH)]:
                        yield pd.DataFrame(
                            {
                                "date": date,
                                "archive": archive,
                                "member": member,
                                "line_no": range(first, first + len(chunk)),
                                "line": chunk,
                            }
                        )
                        first += len(chunk)

    pattern = "^" + "".join({"*": "[^/]*", "?": "[^/]"}.get(ch, f"\\Q{ch}\\E") for ch in glob) + "$"
    wanted = list_members(spark, archives).filter(F.col("member").rlike(pattern))
    return by_member(wanted).select("date", "archive", "member").mapInPandas(
        lines, "date string, archive string, member string, line_no long, line string"
    )
