"""Versioned days: whole replacements, failures, writers at a time, and removal of old versions."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roadspeed.plans import LakeConfig, bronze_to_silver, raw_to_bronze, silver_to_gold
from roadspeed.plans.lake import gold_rows, zone_rows
from roadspeed.versions import DaysChanged, Snapshot, VersionedDays
from workload.adapters import csv_lake, dirty_readings, first_last_day

SF = "/root/testdata/sf0.001"
SCHEMA = "k int, date string"


@pytest.fixture
def table(spark, tmp_path):
    return VersionedDays(spark, str(tmp_path / "table"))


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def held(table, number=None):
    return sorted(tuple(r) for r in table.read("0", "9", SCHEMA, number).collect())


def test_days_are_replaced_emptied_and_kept(spark, table):
    assert held(table) == [] and table.days() == [] and table.snapshot() == Snapshot()
    table.write(rows(spark, (1, "1"), (2, "2"), (3, "3")))
    report = table.write(rows(spark, (20, "2"), (21, "2")), days=["2", "3", "4"], absent=["7"])
    assert (report.rows, report.days, report.empty_days, report.absent_days) == (2, ["2"], ["3", "4"], ["7"])
    assert held(table) == [(1, "1"), (20, "2"), (21, "2")] and table.days() == ["1", "2"]
    assert held(table, 1) == [(1, "1"), (2, "2"), (3, "3")] and held(table, 0) == []
    assert [r.k for r in table.read("2", "2", SCHEMA).collect()] == [20, 21]
    with pytest.raises(ValueError, match="no snapshot 9"):
        table.snapshot(9)


def test_failed_write_leaves_every_day_old(spark, table):
    table.write(rows(spark, (1, "1"), (2, "2")))
    before = held(table)
    bad = spark.range(0, 2000, 1, 4).select(
        F.when(F.col("id") == 1999, F.raise_error(F.lit("broken"))).otherwise(F.lit(9)).cast("int").alias("k"),
        (F.col("id") % 2 + 1).cast("string").alias("date"),
    )
    with pytest.raises(Exception, match="broken"):
        table.write(bad, as_read=True)
    assert held(table) == before and table.snapshot().number == 1


def test_failure_before_the_pointer_is_set(spark, table, monkeypatch):
    table.write(rows(spark, (1, "1"), (2, "2")))
    before = held(table)
    monkeypatch.setattr(VersionedDays, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.write(rows(spark, (7, "1"), (8, "2")))
    monkeypatch.undo()
    assert held(table) == before
    table.write(rows(spark, (5, "2")))
    assert held(table) == [(1, "1"), (5, "2")] and table.remove_old() > 0 and held(table) == [(1, "1"), (5, "2")]


def test_two_writers(spark, table, monkeypatch):
    table.write(rows(spark, (1, "1"), (2, "2")))
    publish, other = VersionedDays._publish, VersionedDays(spark, table.base)

    def late(self, snapshot, theirs):
        monkeypatch.undo()
        other.write(theirs)
        return publish(self, snapshot)

    monkeypatch.setattr(VersionedDays, "_publish", lambda self, s: late(self, s, rows(spark, (10, "1"), (30, "3"))))
    table.write(rows(spark, (20, "2")))
    assert held(table) == [(10, "1"), (20, "2"), (30, "3")] and table.snapshot().number == 3
    monkeypatch.setattr(VersionedDays, "_publish", lambda self, s: late(self, s, rows(spark, (11, "1"))))
    with pytest.raises(DaysChanged, match="1"):
        table.write(rows(spark, (12, "1"), (31, "3")))
    assert held(table) == [(11, "1"), (20, "2"), (30, "3")]


def test_reader_keeps_its_files_until_old_versions_go(spark, table):
    table.write(rows(spark, (1, "1"), (2, "2")))
    old = table.read("0", "9", SCHEMA)
    table.write(rows(spark, (10, "1")))
    table.write(rows(spark, (11, "1")))
    assert sorted(r.k for r in old.collect()) == [1, 2]
    assert table.remove_old(keep=2) == 1 and held(table, 2) == [(2, "2"), (10, "1")]
    with pytest.raises(ValueError):
        table.snapshot(1)
    assert table.remove_old() == 1 and held(table) == [(2, "2"), (11, "1")]
    folders = {p.name for p in Path(table.base).glob("version=*/date=*")}
    assert folders == {"date=1", "date=2"} and len(list(Path(table.base).glob("version=*/date=*"))) == 2
    with pytest.raises(ValueError):
        table.remove_old(0)


def test_plans_on_a_versioned_lake(spark, tmp_path):
    """The same rows in every zone as without versions, also when a day is run again."""
    raw = dirty_readings(spark, SF)
    days = first_last_day(raw)
    lakes = [LakeConfig(archives="", base=str(tmp_path / name), links=None, versioned=name == "v") for name in ("p", "v")]
    for cfg in lakes:
        csv_lake(raw, cfg.zone("raw"))
        for span in (days, (days[0], days[0])):
            raw_to_bronze(spark, cfg, *span)
            report = bronze_to_silver(spark, cfg, *span)
            silver_to_gold(spark, cfg, *span)
        assert report.days == [days[0]] and report.rows > 0
    for zone in ("bronze", "silver", "gold"):
        plain, versioned = (zone_rows(spark, cfg, zone, *days) for cfg in lakes)
        assert sorted(plain.columns) == sorted(versioned.columns) and plain.count() == versioned.count() > 0
        assert plain.exceptAll(versioned.select(plain.columns)).isEmpty()
    assert gold_rows(spark, lakes[1], *days).count() == gold_rows(spark, lakes[0], *days).count()
