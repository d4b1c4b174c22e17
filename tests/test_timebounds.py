from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from logframe.functions import timebounds as tb

DAY = tb.NANOS_PER_DAY
NOW = 1_705_320_000_000_000_000  # 2024-01-15 12:00


@pytest.mark.parametrize(
    ("offset", "ns"),
    [
        (timedelta(microseconds=37), 37_000),
        (timedelta(weeks=1), 7 * 86_400 * 10**9),
        (timedelta(hours=5, milliseconds=-250), 18_000 * 10**9 - 25 * 10**7),
        (timedelta(minutes=-90, microseconds=3), -5_400 * 10**9 + 3_000),
    ],
)
def test_timedelta_to_ns(offset, ns):
    assert tb.timedelta_to_ns(offset) == ns


def test_to_ns():
    assert tb.to_ns(1_700_000_000_000_000_001, NOW) == 1_700_000_000_000_000_001
    assert tb.to_ns(datetime(2024, 1, 15, 12), NOW) == NOW
    assert tb.to_ns(datetime(2024, 1, 15, 14, tzinfo=timezone(timedelta(hours=2))), NOW) == NOW
    assert tb.to_ns("2024-01-15 12:00:00", NOW) == NOW
    assert tb.to_ns(date(2024, 1, 15), NOW) == NOW - 12 * tb.NANOS_PER_HOUR
    assert tb.to_ns(timedelta(hours=-2), NOW) == NOW - 2 * tb.NANOS_PER_HOUR


@pytest.mark.parametrize("bound", [True, 1.5, object(), "1 month", [1]])
def test_refused_bounds(bound):
    with pytest.raises(ValueError):
        tb.to_ns(bound, NOW)


def test_month_offset_is_refused_with_a_reason():
    with pytest.raises(ValueError, match="no fixed length"):
        tb.to_ns({"months": 1}, NOW)


def test_default_hour():
    hour = tb.NANOS_PER_HOUR
    assert tb.with_default_hour(tb.Window(), NOW) == tb.Window(NOW - hour, NOW)
    assert tb.with_default_hour(tb.Window(start_ns=5), NOW) == tb.Window(5, NOW)
    assert tb.with_default_hour(tb.Window(end_ns=10 * hour), NOW) == tb.Window(9 * hour, 10 * hour)
    assert tb.with_default_hour(tb.Window(end_ns=NOW + 1), NOW) == tb.Window(NOW - hour, NOW + 1)


def test_predicates_intersect():
    window = tb.window_of_predicates([(">=", 5), (">", 7), ("<=", 20), ("<", 30)])
    assert window == tb.Window(8, 21)
    assert tb.window_of_predicates([("=", 9)]) == tb.Window(9, 10)
    assert tb.window_of_predicates([]) == tb.Window()
    with pytest.raises(ValueError):
        tb.window_of_predicates([("!=", 1)])
    assert tb.Window(1, 10).intersect(tb.Window(4, None)) == tb.Window(4, 10)


INSTANTS = [0, -1, 1, DAY, DAY - 1, -DAY, -DAY - 1, NOW, NOW + 999, 1_700_000_000_123_456_789, -1_001]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_columns_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(ns,) for ns in INSTANTS], "ns bigint")
        timestamp = tb.timestamp_of(F.col("ns"))
        rows = df.select(
            "ns",
            tb.day_of(F.col("ns")).alias("day"),
            timestamp.alias("timestamp"),
            tb.ns_of_timestamp(timestamp).alias("back"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    epoch = datetime(1970, 1, 1)
    for row in rows:
        expected = epoch + timedelta(microseconds=row.ns // 1_000)
        assert row.timestamp == expected
        assert row.day == expected.date()
        assert row.back == row.ns // 1_000 * 1_000


def test_filter_is_exact_and_names_the_day(spark):
    df = spark.createDataFrame([(ns,) for ns in INSTANTS], "ts_ns bigint")
    with_day = df.withColumn("day", tb.day_of(F.col("ts_ns")))
    for start, end in [(0, 1), (-DAY, 0), (1, NOW), (NOW, NOW + 1), (-DAY - 1, DAY), (None, 0), (0, None)]:
        window = tb.Window(start, end)
        expected = sorted(n for n in INSTANTS if (start is None or n >= start) and (end is None or n < end))
        for table in (df, with_day):
            found = sorted(r.ts_ns for r in table.where(tb.time_filter(window, table)).collect())
            assert found == expected
    assert tb.time_filter(tb.Window(), df) is None
