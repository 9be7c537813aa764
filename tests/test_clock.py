from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from metricwin.functions.clock import (
    clock_text,
    date_clock_text,
    nearest_event_time,
    normalised,
    on_epoch_day,
    seconds_of_day,
)

CASES = [
    ("00:00:00", "00:00:00", 0),
    ("23:59:59", "23:59:59", 86399),
    ("1:2:3", "01:02:03", 3723),
    (" 10:00:00", "10:00:00", 36000),
    ("10:00:00.123", "10:00:00", 36000),
    ("24:00:00", None, None),
    ("10:60:00", None, None),
    ("10:00", None, None),
    ("", None, None),
    (None, None, None),
    ("2024-01-01T10:00:00", None, None),
    ("soon", None, None),
]


def test_time_texts(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "ts string")
    ts = F.col("ts")
    rows = df.select(
        normalised(ts), seconds_of_day(ts), F.unix_seconds(on_epoch_day(ts))
    ).collect()
    assert [tuple(r) for r in rows] == [(text, sec, sec) for _, text, sec in CASES]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_seconds_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("18:59:59",), ("19:00:00",)], "ts string")
        secs = seconds_of_day(F.col("ts"))
        rows = df.select(secs, clock_text(secs)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [tuple(r) for r in rows] == [(68399, "18:59:59"), (68400, "19:00:00")]


def test_clock_text_wraps_both_ways(spark):
    df = spark.createDataFrame([(86410,), (-20,), (0,), (86399,)], "s long")
    rows = df.select(clock_text(F.col("s")), date_clock_text(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [
        ("00:00:10", "1970-01-02 00:00:10"),
        ("23:59:40", "1969-12-31 23:59:40"),
        ("00:00:00", "1970-01-01 00:00:00"),
        ("23:59:59", "1970-01-01 23:59:59"),
    ]


def test_nearest_event_time_keeps_the_readings_own_day(spark):
    utc = timezone.utc
    records = [
        ("23:59:58", datetime(2024, 1, 2, 0, 0, 3, tzinfo=utc), datetime(2024, 1, 1, 23, 59, 58)),
        ("00:00:01", datetime(2024, 1, 1, 23, 59, 59, tzinfo=utc), datetime(2024, 1, 2, 0, 0, 1)),
        ("12:00:00", datetime(2024, 1, 1, 12, 0, 7, tzinfo=utc), datetime(2024, 1, 1, 12, 0, 0)),
        ("late", datetime(2024, 1, 1, 12, 0, 7, tzinfo=utc), None),
    ]
    df = spark.createDataFrame([r[:2] for r in records], "ts string, record timestamp")
    got = df.select(F.unix_seconds(nearest_event_time(F.col("ts"), F.col("record")))).collect()
    want = [r[2] and int(r[2].replace(tzinfo=utc).timestamp()) for r in records]
    assert [r[0] for r in got] == want
