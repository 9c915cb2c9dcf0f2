"""Silver kept up to date by files: late, corrected, repeated and removed ones; what an update reads; the stream."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import roadspeed.plans.slots as slots_module
from roadspeed.operators import normalise_time, slot_mean, to_bronze
from roadspeed.operators.readings import merged_mean, slot_sums
from roadspeed.plans import LakeConfig
from roadspeed.plans.lake import zone_rows
from roadspeed.plans.slots import changed_files, refresh_silver
from roadspeed.sources import read_raw_csv
from roadspeed.streaming.slots import stream_slots

HEAD = "CREATDE,CREATHM,LINKID,ROADINSTTCD,PASNGSPED,PASNGTIME"
DAYS = ("20251110", "20251130")


@pytest.fixture(params=[False, True])
def lake(tmp_path, request):
    return LakeConfig(archives="", base=str(tmp_path / "lake"), links=None, versioned=request.param)


def land(cfg, day, name, *lines, head=HEAD):
    folder = Path(cfg.zone("raw")) / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([head, *lines]) + "\n")


def reading(day, time, link, speed):
    return f"{day},{time},{link},x,{speed},1"


def silver(spark, cfg):
    rows = zone_rows(spark, cfg, "silver", *DAYS).collect()
    return {(r.date, r.linkid, r.datetime.strftime("%H:%M")): r.self_mean for r in rows}


def recomputed(spark, cfg):
    rows = slot_mean(normalise_time(to_bronze(read_raw_csv(spark, cfg.zone("raw"), *DAYS)))).collect()
    return {(r.date, r.linkid, r.datetime.strftime("%H:%M")): r.self_mean for r in rows}


def test_late_corrected_repeated_and_removed_files(spark, lake):
    assert refresh_silver(spark, lake).days == []
    a, b = "20251113", "20251114"
    land(lake, a, "one.csv", reading(a, "0001", "L1", 10), reading(a, "2", "L1", 20), reading(a, "0301", "L2", ""))
    land(lake, b, "one.csv", reading(b, "0001", "L1", 1))
    report = refresh_silver(spark, lake)
    assert (report.rows, report.days) == (3, [a, b])
    assert silver(spark, lake) == {(a, "L1", "00:00"): 15.0, (a, "L2", "03:00"): None, (b, "L1", "00:00"): 1.0}

    land(lake, a, "two late.csv", reading(a, "0004", "L1", 60), head=HEAD)
    report = refresh_silver(spark, lake)
    assert report.days == [a] and silver(spark, lake)[a, "L1", "00:00"] == 30.0
    assert refresh_silver(spark, lake).days == []

    land(lake, a, "one.csv", reading(a, "0001", "L1", 20))
    assert refresh_silver(spark, lake).days == [a]
    assert silver(spark, lake) == recomputed(spark, lake) == {(a, "L1", "00:00"): 40.0, (b, "L1", "00:00"): 1.0}

    land(lake, b, "one.csv", reading(b, "xx", "L1", 1))  # no usable row is left of this day
    os.remove(f"{lake.zone('raw')}/date={a}/two late.csv")
    report = refresh_silver(spark, lake)
    assert report.days == [a] and report.empty_days == [b]
    assert silver(spark, lake) == recomputed(spark, lake) == {(a, "L1", "00:00"): 20.0}
    assert refresh_silver(spark, lake).days == [] and all(f.isEmpty() for f in changed_files(spark, lake))


def test_update_reads_the_changed_files_and_days_alone(spark, tmp_path, monkeypatch):
    cfg = LakeConfig(archives="", base=str(tmp_path / "lake"), links=None)
    days = [f"202511{d}" for d in range(11, 21)]
    for day in days:
        for name in ("a.csv", "b.csv"):
            land(cfg, day, name, reading(day, "0001", "L1", 1), reading(day, "0001", "L2", 2))
    refresh_silver(spark, cfg)
    land(cfg, days[3], "c.csv", reading(days[3], "0003", "L1", 4))
    raw, sums = [], []
    read, totals = slots_module.read_raw_csv, slots_module._totals
    monkeypatch.setattr(slots_module, "read_raw_csv", lambda *a, **k: raw.append(read(*a, **k)) or raw[-1])
    monkeypatch.setattr(slots_module, "_totals", lambda *a: sums.append(totals(*a)) or sums[-1])
    assert refresh_silver(spark, cfg).days == [days[3]]
    assert [f.rsplit("/", 2)[-2:] for f in raw[0].inputFiles()] == [[f"date={days[3]}", "c.csv"]]
    assert {f.split("/date=")[1][:8] for f in sums[0].inputFiles()} == {days[3]}
    assert silver(spark, cfg) == pytest.approx(recomputed(spark, cfg))


def test_failed_update_is_made_up_for(spark, lake, monkeypatch):
    a = "20251113"
    land(lake, a, "one.csv", reading(a, "0001", "L1", 10))
    refresh_silver(spark, lake)
    land(lake, a, "two.csv", reading(a, "0001", "L1", 20))
    monkeypatch.setattr(slots_module, "write_zone", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        refresh_silver(spark, lake)
    assert silver(spark, lake) == {(a, "L1", "00:00"): 10.0}
    monkeypatch.undo()
    assert refresh_silver(spark, lake).days == [a] and silver(spark, lake) == {(a, "L1", "00:00"): 15.0}


def test_stream_with_a_late_file_and_one_that_comes_twice(spark, lake, tmp_path):
    a, b = "20251113", "20251114"

    def run(checkpoint):
        """The number of batches, which hold one file each."""
        query = stream_slots(spark, lake, str(tmp_path / checkpoint), files_per_batch=1)
        query.awaitTermination()
        return sum(p["numInputRows"] > 0 for p in query.recentProgress)

    land(lake, a, "one.csv", reading(a, "0001", "L1", 10))
    land(lake, b, "one.csv", reading(b, "0001", "L1", 3))
    assert run("c1") == 2
    land(lake, a, "late.csv", reading(a, "0002", "L1", 30))
    assert run("c1") == 1 and run("c1") == 0
    wanted = {(a, "L1", "00:00"): 20.0, (b, "L1", "00:00"): 3.0}
    assert silver(spark, lake) == recomputed(spark, lake) == wanted
    assert run("c2") == 3 and silver(spark, lake) == wanted  # every file once more


def test_sums_add_up_to_the_mean(spark):
    rows = [("a", "2025-11-13 00:00:01", v, s) for v, s in ((1.0, "x"), (2.0, "x"), (6.0, "y"), (None, "y"))]
    rows += [("b", "2025-11-13 00:00:01", None, "x")]
    df = spark.createDataFrame(rows, "linkid string, at string, speed double, source string")
    df = df.select("linkid", F.col("at").cast("timestamp").alias("datetime"), "speed", "source", F.lit("d").alias("date"))
    got = {r.linkid: r.self_mean for r in merged_mean(slot_sums(df)).collect()}
    assert got == {"a": 3.0, "b": None}
