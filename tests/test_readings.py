"""Raw CSV to silver: the rows of fixture F1."""

from pyspark.sql import functions as F

from roadspeed.operators import filter_links, normalise_time, slot_mean, to_bronze
from roadspeed.plans import LakeConfig, bronze_to_silver, raw_to_bronze
from roadspeed.plans.config import DEFAULT_LINKS
from roadspeed.sources import read_days, read_raw_csv

HEADER = ["CREATDE", "CREATHM", "LINKID", "ROADINSTTCD", "PASNGSPED", "PASNGTIME"]
DAY = "20251113"
ROWS = [
    (DAY, "0005", "1920161400", "40.0"),
    (DAY, "7", "1920161400", "60.0"),
    (DAY, "0010", "1920161400", ""),
    (DAY, "0015", "1920161400", "abc"),
    (DAY, "2500", "1920161400", "30.0"),
    (DAY, "12345", "1920161400", "30.0"),
    (DAY, "1x", "1920161400", "30.0"),
    ("20251112", "2355", "1920161400", "30.0"),
    (DAY, "0005", "9999999999", "30.0"),
    (DAY, "0005", "0192", "30.0"),
]


def lake(tmp_path):
    first = tmp_path / "raw" / f"date={DAY}"
    (first / "inner").mkdir(parents=True)
    lines = [",".join(HEADER)] + [f"{d},{t},{link},R,{v},1.5" for d, t, link, v in ROWS]
    (first / "a.csv").write_text("\n".join(lines) + "\n")
    (first / "inner" / "b.csv").write_text("\n".join(lines) + "\n")
    second = tmp_path / "raw" / "date=20251114"
    second.mkdir()
    (second / "a.csv").write_text(",".join(HEADER[::-1]) + "\n2.5,50.0,R,1920161400,0930,20251114\n")
    (tmp_path / "raw" / "date=20251115").mkdir()
    return LakeConfig(archives="", base=str(tmp_path))


def test_csv_days_select_by_header_and_keep_text(spark, tmp_path):
    cfg = lake(tmp_path)
    raw = read_raw_csv(spark, cfg.zone("raw"), "20251112", "20251116")
    assert raw.columns == [*HEADER, "date"]
    assert {r.date: r["count"] for r in raw.groupBy("date").count().collect()} == {DAY: 10, "20251114": 1}
    turned = raw.filter("date = '20251114'").first()
    assert (turned.CREATDE, turned.CREATHM, turned.LINKID, turned.PASNGSPED) == ("20251114", "0930", "1920161400", "50.0")
    assert raw.filter("LINKID = '0192'").count() == 1


def test_csv_days_without_any_file(spark, tmp_path):
    assert read_raw_csv(spark, str(tmp_path), "20250101", "20250103").collect() == []


def test_csv_header_that_differs_within_a_day_raises(spark, tmp_path):
    import pytest

    day = tmp_path / "date=20251113"
    day.mkdir()
    (day / "a.csv").write_text(",".join(HEADER) + "\n20251113,0005,1,R,1.0,1\n")
    (day / "b.csv").write_text(",".join(HEADER[::-1]) + "\n1,1.0,R,1,0005,20251113\n")
    with pytest.raises(Exception, match="CSV header"):
        read_raw_csv(spark, str(tmp_path), "20251113", "20251113").collect()


def test_bronze_has_types_and_nulls(spark, tmp_path):
    cfg = lake(tmp_path)
    bronze = to_bronze(read_raw_csv(spark, cfg.zone("raw"), DAY, DAY))
    assert [f.dataType.simpleString() for f in bronze.schema] == ["string"] * 4 + ["double"] * 2 + ["string"]
    speeds = {r.CREATHM: r.PASNGSPED for r in bronze.collect()}
    assert speeds["0015"] is None and speeds["0010"] is None and speeds["7"] == 60.0


def test_silver_means_and_filters(spark, tmp_path):
    cfg = lake(tmp_path)
    bronze = raw_to_bronze(spark, cfg, DAY, "20251115")
    assert (bronze.rows, bronze.days, bronze.empty_days) == (11, [DAY, "20251114"], ["20251115"])
    assert bronze.absent_days == []
    bronze_to_silver(spark, cfg, DAY, "20251115")
    rows = read_days(spark, cfg.zone("silver"), DAY, DAY).select(F.date_format("datetime", "HH:mm").alias("t"), "self_mean")
    assert {r.t: r.self_mean for r in rows.collect()} == {"00:05": 50.0, "00:10": None, "00:15": None, "12:30": 30.0}


def test_impossible_time_can_be_kept(spark, tmp_path):
    cfg = lake(tmp_path)
    bronze = to_bronze(read_raw_csv(spark, cfg.zone("raw"), DAY, DAY))
    kept = slot_mean(normalise_time(bronze, DEFAULT_LINKS, drop_invalid_time=False))
    assert [r.self_mean for r in kept.filter("datetime IS NULL").collect()] == [30.0]


def test_nan_speed_counts_as_missing(spark):
    rows = [(DAY, "0005", "a", "R", float("nan"), 1.0, DAY), (DAY, "0006", "a", "R", 10.0, 1.0, DAY)]
    bronze = spark.createDataFrame(rows, "CREATDE string, CREATHM string, LINKID string, ROADINSTTCD string, PASNGSPED double, PASNGTIME double, date string")
    assert slot_mean(normalise_time(bronze)).first().self_mean == 10.0


def test_nine_digit_day_is_cut(spark):
    bronze = spark.createDataFrame(
        [("202511139", "0005", "a", "R", 10.0, 1.0, DAY)],
        "CREATDE string, CREATHM string, LINKID string, ROADINSTTCD string, PASNGSPED double, PASNGTIME double, date string",
    )
    assert normalise_time(bronze).count() == 1


def test_links_by_list_and_by_table(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "LINKID string")
    table = spark.createDataFrame([("b",), ("b",), ("z",)], "link string")
    assert filter_links(df, ["a", "c"]).count() == 2
    assert filter_links(df, table).count() == 2
    assert filter_links(df, None).count() == 4


def test_link_list_reaches_the_scan(spark, tmp_path):
    bronze = tmp_path / "bronze"
    spark.createDataFrame([("a", DAY)], "LINKID string, date string").write.parquet(str(bronze))
    plan = filter_links(spark.read.parquet(str(bronze)), ["a", "b"])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(LINKID, [a,b])]" in plan
