import datetime as dt

import pytest

from tidewatch.functions.time import iso_to_ntz, millis_to_ntz, ntz_micros, partition_parts
from tidewatch.sources.bronze import hours_to_process

UTC = dt.timezone.utc


def _back(hour):
    return dt.datetime(*(int(hour[k]) for k in ("year", "month", "day", "hour")))


@pytest.mark.parametrize("now", [
    dt.datetime(2024, 3, 1, 1, 59, 59, tzinfo=UTC),                                # leap February
    dt.datetime(2025, 4, 30, 22, 0, tzinfo=UTC),
    dt.datetime(2025, 10, 26, 3, 20, tzinfo=dt.timezone(dt.timedelta(hours=5, minutes=30))),
    dt.datetime(2028, 2, 29, 11, 7),                                               # no zone: UTC
])
@pytest.mark.parametrize("lookback", [0, 1, 5, 30])
def test_hours_step_back_one_by_one(now, lookback):
    hours = [_back(h) for h in hours_to_process(now, lookback)]
    utc = now if now.tzinfo is None else now.astimezone(UTC).replace(tzinfo=None)
    assert len(set(hours)) == lookback + 1
    assert hours[0] <= utc < hours[0] + dt.timedelta(hours=1)
    assert all(a - b == dt.timedelta(hours=1) for a, b in zip(hours, hours[1:]))


def test_hours_are_padded_text():
    for hour in hours_to_process(dt.datetime(2031, 5, 4, 3, tzinfo=UTC), 8):
        assert {k: len(v) for k, v in hour.items()} == {"year": 4, "month": 2, "day": 2, "hour": 2}


def test_hours_follow_the_clock_by_default():
    newest = _back(hours_to_process()[0])
    now = dt.datetime.now(UTC).replace(tzinfo=None)
    assert dt.timedelta(0) <= now - newest < dt.timedelta(hours=1, minutes=1)


def test_iso_parsing_variants(spark):
    df = spark.createDataFrame(
        [("2026-06-10T14:30:00Z",), ("2026-06-10T14:30:00+00:00",),
         ("2026-06-10T14:30:00.000000+00:00",), ("2026-06-10T16:30:00+02:00",),
         ("not a time",)], "s string")
    got = [r[0] for r in df.select(iso_to_ntz("s")).collect()]
    want = dt.datetime(2026, 6, 10, 14, 30)
    assert got[:4] == [want] * 4
    assert got[4] is None


def test_millis_exact_and_micros_roundtrip(spark):
    df = spark.createDataFrame([(1707994496789,)], "ms long")
    ts = df.select(millis_to_ntz("ms").alias("t")).first()["t"]
    assert ts == dt.datetime(2024, 2, 15, 10, 54, 56, 789000)
    back = df.select(ntz_micros(millis_to_ntz("ms"))).first()[0]
    assert back == 1707994496789 * 1000


def test_micros_independent_of_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 01:30:00' a, "
                       "TIMESTAMP_NTZ'2024-03-10 03:30:00' b")
        a, b = df.select(ntz_micros("a"), ntz_micros("b")).first()
        assert b - a == 2 * 3600 * 10**6
        assert a == 1710034200 * 10**6
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    """Also inside the hour that daylight saving skips in New York."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(
            [("2026-03-08T02:30:00",), ("2026-03-08T02:30:00Z",), ("2026-03-08 02:30:00",),
             ("2026-03-08T08:00:00+05:30",), ("2026-03-08T02:30:00.000000+00:00",)], "s string")
        want = dt.datetime(2026, 3, 8, 2, 30)
        assert [r[0] for r in df.select(iso_to_ntz("s")).collect()] == [want] * 5
        micros = df.select(ntz_micros(iso_to_ntz("s"))).collect()
        exact = (want - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        assert {r[0] for r in micros} == {exact}
        old = spark.sql("SELECT TIMESTAMP_NTZ'1969-12-31 23:59:59.999999' t")
        assert old.select(ntz_micros("t")).first()[0] == -1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_partition_parts_zero_padded(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2026-07-06 04:05:00' t")
    parts = partition_parts("t")
    row = df.select(*[c.alias(n) for n, c in parts.items()]).first().asDict()
    assert row == {"year": "2026", "month": "07", "day": "06", "hour": "04"}
