import datetime as dt

import pytest
from pyspark.sql import functions as F

from logloom.functions.times import floor_to, parse_seconds, seconds, time_regex, utc_date

UTC = dt.timezone.utc


def parse(spark, text, fmt, zone="UTC"):
    return spark.createDataFrame([(text,)], "v string").select(parse_seconds(F.col("v"), fmt, zone).alias("t")).first().t


@pytest.mark.parametrize("text, fmt", [
    ("2024/02/29 23:59:58", "%Y/%m/%d %H:%M:%S"),
    ("2024/2/9 3:4:5", "%Y/%m/%d %H:%M:%S"),
    ("20240229235958", "%Y%m%d%H%M%S"),
    ("29/Feb/2024:23:59:58", "%d/%b/%Y:%H:%M:%S"),
    ("2024-02-29T11:59:58 PM", "%FT%I:%M:%S %p"),
    ("at '2024-02-29' it's 23 o'clock", "at '%Y-%m-%d' it's %H o'clock"),
    ("100% 2024-02-29", "100%% %Y-%m-%d"),
    ("2024-02-29 23:59:58+0530", "%Y-%m-%d %H:%M:%S%z"),
    ("2024-02-29 23:59:58-08:00", "%Y-%m-%d %H:%M:%S%z"),
    ("2024-02-29 23:59:58Z", "%Y-%m-%d %H:%M:%S%z"),
    ("05/01/99", "%d/%m/%y"), ("05/01/69", "%d/%m/%y"), ("05/01/68", "%d/%m/%y"), ("29/02/00", "%d/%m/%y"),
    ("Jan  5 2024", "%b %e %Y"), ("Thu Jan  5 23:01:02 2023", "%a %b %d %H:%M:%S %Y"),
    ("Thursday, 05 January 2023", "%A, %d %B %Y"), ("%T 2024-02-29", "%%T %Y-%m-%d"),
    ("12:01 am 2024-02-29", "%I:%M %p %Y-%m-%d"), ("2024060", "%Y%j"), ("2024-02-29 GMT", "%Y-%m-%d %Z"),
])
def test_same_as_strptime(spark, text, fmt):
    known = fmt.replace("%F", "%Y-%m-%d").replace("%e", "%d")
    expected = dt.datetime.strptime(text, known)
    expected = expected if expected.tzinfo else expected.replace(tzinfo=UTC)
    assert parse(spark, text, fmt) == int(expected.timestamp())


@pytest.mark.parametrize("text", ["", "no time", "2024/13/01 00:00:00", "2024/01/01", "2023/02/29 00:00:00", "2024/01/01 24:00:00", "x2024/01/01 00:00:00", "\x012024\x0101\x01", None])
def test_what_does_not_parse_is_null(spark, text):
    assert parse(spark, text, "%Y/%m/%d %H:%M:%S") is None


@pytest.mark.parametrize("fmt", ["%H:%M", "%Y-%m-%d %I:%M", "%Y-%m", "%Q"])
def test_formats_spark_cannot_parse_fail_before_the_job(fmt):
    with pytest.raises(ValueError):
        time_regex(fmt)


def test_epoch_seconds_and_zones(spark):
    assert parse(spark, "1704067200", "%s") == 1704067200
    assert parse(spark, "17e3", "%s") is None
    assert parse(spark, "2024-01-01 01:00:00", "%Y-%m-%d %H:%M:%S", "Europe/Berlin") == 1704067200


def test_session_zone_plays_no_part(spark):
    times = ["2024-03-31 02:30:00.9", "2024-07-01 00:00:00", "1969-12-31 23:59:59"]
    expected = [int(dt.datetime.fromisoformat(t[:19]).replace(tzinfo=UTC).timestamp()) for t in times]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        frame = spark.createDataFrame([(t,) for t in times], "v string")
        row = frame.select(seconds(F.col("v").cast("timestamp_ntz")).alias("t"))
        assert [r.t for r in row.collect()] == expected
        assert parse(spark, "2024-03-31 02:30:00", "%Y-%m-%d %H:%M:%S") == expected[0]
        day = spark.createDataFrame([(1704067199,), (1704067200,), (2**31 + 5,)], "t bigint")
        days = [str(r.d) for r in day.select(utc_date(F.col("t")).alias("d")).collect()]
        assert days == ["2023-12-31", "2024-01-01", "2038-01-19"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_floor_to(spark):
    row = spark.range(107, 108).select(floor_to(F.col("id"), 10).alias("a"), floor_to(F.col("id"), 10, 103).alias("b")).first()
    assert (row.a, row.b) == (100, 103)
