from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wavemeter.functions.timeutil import (
    buckets,
    day_numbers,
    hour_numbers,
    previous_bucket,
    previous_period,
    previous_period_bounds,
    rollup_interval,
    ts_lit,
    zone_offset_minutes,
)
from wavemeter.operators.counters import complete_buckets, parse_any_time
from wavemeter.operators.threshold import spatial_run_bounds

RUNS = [
    datetime(2024, 1, 1, 0, 0), datetime(2024, 3, 1, 5, 59, 59), datetime(2024, 2, 15, 23, 7),
    datetime(2024, 2, 16, 0, 0), datetime(2023, 12, 31, 12, 30), datetime(2024, 3, 31, 1, 1, 1),
]
GRAINS = ("HOUR", "DAY", "WEEK", "MONTH", "FITTEEN_DAYS")


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize("grain", GRAINS)
def test_columns_agree_with_literals(spark, grain):
    for run in RUNS:
        got = one(spark, *previous_period(ts_lit(run), grain))
        assert got == previous_period_bounds(run, grain), run


def test_half_month_ends_with_the_month():
    assert previous_period_bounds(datetime(2024, 3, 10), "FITTEEN_DAYS") == (
        datetime(2024, 2, 16), datetime(2024, 3, 1),
    )
    assert previous_period_bounds(datetime(2024, 3, 16), "FITTEEN_DAYS") == (
        datetime(2024, 3, 1), datetime(2024, 3, 16),
    )


@pytest.mark.parametrize("minutes,delay", [(5, 10), (5, 180), (15, 0), (60, 0)])
def test_bucket_columns_agree_with_bounds(spark, minutes, delay):
    for run in RUNS:
        got = one(spark, *previous_bucket(ts_lit(run), minutes, delay))
        assert got == spatial_run_bounds(run, minutes, delay)


def test_daily_load_covers_the_business_day(spark):
    run = ts_lit("2024-01-10 05:30:00")
    assert one(spark, *rollup_interval(run, 1440)) == (
        datetime(2024, 1, 9, 3), datetime(2024, 1, 10, 3),
    )
    assert one(spark, *rollup_interval(run, 1440, source_lag_hours=6)) == (
        datetime(2024, 1, 8, 3), datetime(2024, 1, 9, 3),
    )
    assert one(spark, *rollup_interval(run, 15, days_back=1)) == (
        datetime(2024, 1, 9, 5, 15), datetime(2024, 1, 9, 5, 30),
    )
    with pytest.raises(ValueError):
        rollup_interval(run, 15, "other")


def test_bucket_series(spark):
    start = datetime(2024, 1, 1)
    got = [r[0] for r in buckets(spark, start, start + timedelta(minutes=70), 30).orderBy("__time").collect()]
    assert got == [start + timedelta(minutes=m) for m in (0, 30, 60)]
    assert buckets(spark, start, start, 30).count() == 0


@pytest.mark.parametrize(
    "zones,minutes",
    [("Z", 0), ("-03:00", 0), ("-03:00,-02:00", -180), ("+05:30,x", 330), ("+00:00,+01:00", 0),
     ("junk,junk", 0), (None, 0)],
)
def test_zone_lists(spark, zones, minutes):
    assert one(spark, zone_offset_minutes(F.lit(zones).cast("string")))[0] == minutes


def test_day_and_hour_sets(spark):
    def days(*names):
        return one(spark, day_numbers(F.array(*[F.lit(n) for n in names])))[0]

    assert days("WEEKEND") == [6, 7] and days("MONDAY", "SUNDAY") == [1, 7]
    assert days("WORKDAYS") == [1, 2, 3, 4, 5] and days("ALLDAYS", "MONDAY") is None
    assert one(spark, day_numbers(F.lit(None).cast("array<string>")))[0] is None
    hours = one(spark, hour_numbers(F.array(F.lit("_08_00"), F.lit("21:30"), F.lit("07"))))[0]
    assert hours == [8, 21, 7]
    assert one(spark, hour_numbers(F.array(F.lit("ALL"), F.lit("07"))))[0] is None


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2024-12-04T23:15:00.250Z", datetime(2024, 12, 4, 23, 15, 0, 250000)),
        ("2024-12-01 10:00:00", datetime(2024, 12, 1, 10)),
        ("2024-12-01", datetime(2024, 12, 1)),
        ("1733047200000", datetime(2024, 12, 1, 10)),
        ("01-12-2024 10:00:00", datetime(2024, 12, 1, 10)),
        ("99999999999999999999", None),
        ("soon", None),
        (None, None),
    ],
)
def test_time_texts(spark, text, expected):
    got = one(spark, parse_any_time(F.lit(text).cast("string"), ("dd-MM-yyyy HH:mm:ss",)))[0]
    assert got == expected


def test_incremental_runs_meet_without_overlap():
    """Successive marks give adjoining ranges of whole buckets."""
    mark, ends = datetime(2024, 1, 1), []
    for now in (datetime(2024, 1, 1, 0, 7), datetime(2024, 1, 1, 0, 16), datetime(2024, 1, 1, 0, 16)):
        start, end = complete_buckets(mark, now, 5)
        assert start == mark
        mark = end
        ends.append(end.minute)
    assert ends == [5, 15, 15]
