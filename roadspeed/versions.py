"""Day tables whose days are replaced all at once.

Data lies in ``base/version=<id>/date=<day>``, a new folder for each write. A snapshot is a small file in ``base/_snapshots``
that names the version of each day; it is written aside and renamed into place as the last step of a write. Readers take
the newest snapshot, or an older one by number, and open its folders only. So a reader sees all days of a write or none, a
failed write changes nothing, and a reader that has begun keeps its files until old versions are removed.

Two writers at a time: the rename of the later one finds its number taken. It takes the next number if the other has
written other days only, and raises otherwise; its rows stay unseen then.

A snapshot holds one entry for each day of the calendar. The rename must be atomic, as it is on HDFS and local disks; on
object stores let one writer work at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from roadspeed.sinks.days import WriteReport, written

_FOLDER = "_snapshots"


class DaysChanged(RuntimeError):
    """Another writer has replaced the same days meanwhile."""


@dataclass(frozen=True)
class Snapshot:
    """The version of each day; number 0 is the table before its first write."""

    number: int = 0
    days: dict[str, str] = field(default_factory=dict)

    def between(self, start: str, end: str) -> dict[str, str]:
        return {day: version for day, version in sorted(self.days.items()) if start <= day <= end}


class VersionedDays:
    """A table of days below ``base``."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._store = self._path("").getFileSystem(self._conf)

    def _path(self, below: str) -> object:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{below}" if below else self.base)

    def _numbers(self) -> list[int]:
        folder = self._path(_FOLDER)
        if not self._store.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._store.listStatus(folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The newest snapshot, or the one of this number."""
        numbers = self._numbers()
        if number is None:
            number = numbers[-1] if numbers else 0
        if number == 0:
            return Snapshot()
        if number not in numbers:
            raise ValueError(f"{self.base} has no snapshot {number}")
        stream = self._store.open(self._path(f"{_FOLDER}/{number}.json"))
        try:
            return Snapshot(number, json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _publish(self, snapshot: Snapshot) -> bool:
        """Whether the snapshot's number was free."""
        aside, place = self._path(f"{_FOLDER}/.{uuid.uuid4().hex}"), self._path(f"{_FOLDER}/{snapshot.number}.json")
        stream = self._store.create(aside, False)
        stream.write(json.dumps(snapshot.days, sort_keys=True).encode())
        stream.close()
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._store.getUri(), self._conf)
        try:
            context.rename(self._store.makeQualified(aside), self._store.makeQualified(place), options)
        except Exception:
            if not self._store.exists(place):
                raise
            self._store.delete(aside, False)
            return False
        return True

    def write(
        self,
        df: DataFrame,
        days: Iterable[str] = (),
        files_per_day: int | None = None,
        by: str | None = None,
        as_read: bool = False,
        absent: Iterable[str] = (),
    ) -> WriteReport:
        """Replace the days found in ``df``, and empty those of ``days`` that are not; arguments as of ``write_days``."""
        began = self.snapshot()
        version = uuid.uuid4().hex
        rows, found = written(df, f"{self.base}/version={version}", files_per_day, by, as_read, replace=False)
        missing = sorted(set(days) - set(found))
        now = began
        while True:
            changed = [d for d in (*found, *missing) if now.days.get(d) != began.days.get(d)]
            if changed:
                raise DaysChanged(f"{self.base}: {', '.join(sorted(changed))} changed while they were written")
            kept = {day: v for day, v in now.days.items() if day not in missing}
            if self._publish(Snapshot(now.number + 1, kept | dict.fromkeys(found, version))):
                return WriteReport(rows, found, missing, sorted(absent))
            now = self.snapshot()

    def read(
        self, start: str, end: str, schema: T.StructType | str, number: int | None = None
    ) -> DataFrame:
        """Rows of the days start..end as of a snapshot; only their folders are opened."""
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        found = self.snapshot(number).between(start, end)
        if not found:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.base}/version={version}/date={day}" for day, version in found.items()]
        whole = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
        return self.spark.read.schema(whole).option("basePath", self.base).parquet(*paths).select(schema.names)

    def days(self, number: int | None = None) -> list[str]:
        return sorted(self.snapshot(number).days)

    def remove_old(self, keep: int = 1) -> int:
        """Remove all but the newest ``keep`` snapshots and the day folders that only they use; the folders removed.

        Also removes what failed writes have left, so no write may be under way.
        """
        if keep < 1:
            raise ValueError("keep starts at 1")
        numbers = self._numbers()
        used = {(v, d) for n in numbers[-keep:] for d, v in self.snapshot(n).days.items()}
        # Snapshots go first: none may name a folder that is gone.
        for number in numbers[:-keep]:
            self._store.delete(self._path(f"{_FOLDER}/{number}.json"), False)
        removed = 0
        for folder in self._store.globStatus(self._path("version=*")) or []:
            version = folder.getPath().getName().removeprefix("version=")
            if not any(v == version for v, _ in used):
                removed += len(self._store.globStatus(self._path(f"version={version}/date=*")) or [])
                self._store.delete(folder.getPath(), True)
                continue
            for day in self._store.listStatus(folder.getPath()):
                name = day.getPath().getName()
                if name.startswith("date=") and (version, name.removeprefix("date=")) not in used:
                    removed += 1
                    self._store.delete(day.getPath(), True)
        return removed
