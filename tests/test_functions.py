import pytest
from pyspark.sql import functions as F

from roadspeed.functions import (
    day_from_path, finite_or_zero, floor_div, is_finite, micros, minute_of_day, nan_to_null, parse_mixed_ts,
    parse_stamp, slot_start, trailing_range,
)


def values(spark, kind, items, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column.alias("out")).collect()]


def texts(spark, items, column, form="yyyy-MM-dd HH:mm:ss"):
    return values(spark, "string", items, F.date_format(column, form))


def test_parse_stamp(spark):
    df = spark.createDataFrame(
        [("20251113", "0005"), ("20251113", "2500"), ("20251113", "0060"), ("20250230", "0000"), ("20240229", "2359"), ("2025113", "0000"), (None, "0000")],
        "d string, t string",
    )
    got = [r[0] for r in df.select(F.date_format(parse_stamp("d", "t"), "yyyyMMddHHmm")).collect()]
    assert got == ["202511130005", None, None, None, "202402292359", None, None]


def test_parse_mixed(spark):
    items = ["2025-11-13T00:05", " 2025-11-13 00:05:07.25 ", "20251113", "202511130005", "2025/11/13 00:05", "x", None, "11/13/2025"]
    assert texts(spark, items, parse_mixed_ts("v")) == [
        "2025-11-13 00:05:00", "2025-11-13 00:05:07", "2025-11-13 00:00:00", "2025-11-13 00:05:00",
        "2025-11-13 00:05:00", None, None, "2025-11-13 00:00:00",
    ]


def test_slot_start_also_before_1970(spark):
    items = ["2025-11-13 00:04:59", "2025-11-13 00:05:00", "1969-12-31 23:59:59", None]
    assert texts(spark, items, slot_start(F.col("v").cast("timestamp"))) == [
        "2025-11-13 00:00:00", "2025-11-13 00:05:00", "1969-12-31 23:55:00", None,
    ]


def test_day_from_path(spark):
    items = ["http://h/a/20251113_5Min.zip", "20251113.zip", "latest.zip", "http://h/20251113_5Min.zip/", "2025111_x.zip", "20251113"]
    assert values(spark, "string", items, day_from_path("v")) == [
        "20251113", "20251113", "unknown_date", "20251113", "unknown_date", "20251113",
    ]


def test_trailing_range(spark):
    df = spark.createDataFrame([("20251113", 30), ("20251113", 0), ("20240301", 2)], "d string, n int")
    assert [tuple(r) for r in df.select(*trailing_range("d", F.col("n"))).collect()] == [
        ("20251015", "20251113"), ("20251113", "20251113"), ("20240229", "20240301"),
    ]


def test_numbers(spark):
    items = [1.5, None, float("nan"), float("inf"), float("-inf")]
    assert values(spark, "double", items, finite_or_zero("v")) == [1.5, 0.0, 0.0, 0.0, 0.0]
    assert values(spark, "double", items, is_finite("v")) == [True, False, False, False, False]
    assert values(spark, "double", items, nan_to_null("v")) == [1.5, None, None, float("inf"), float("-inf")]


def test_floor_div_is_exact(spark):
    big = 300_000_000 * 10**9
    assert values(spark, "long", [big - 1, big, -1, 0], floor_div("v", 300_000_000)) == [10**9 - 1, 10**9, -1, 0]


def test_minute_of_day(spark):
    assert values(spark, "string", ["2025-11-13 23:59:59"], minute_of_day(F.col("v").cast("timestamp"))) == [1439]


def test_micros():
    assert micros("5 minutes") == 300_000_000
    assert micros("1 day") == 86_400_000_000
    with pytest.raises(ValueError):
        micros("0 minutes")
