"""Calendar arithmetic on UTC wall-clock timestamps (TIMESTAMP_NTZ)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemeter.model import TIME

# The business day starts at 03:00 UTC.
DAY_START_HOURS = 3

# Granularity of a config -> granularity tag of the fact rows.
PERIOD_TAGS = {
    "PT5M": "PT300S",
    "PT15M": "PT900S",
    "PT30M": "PT1800S",
    "PT1H": "PT3600S",
}

# Time grain of a config -> ISO period.
GRAIN_PERIODS = {
    "HOUR": "PT1H",
    "DAY": "P1D",
    "WEEK": "P1W",
    "MONTH": "P1M",
    "FITTEEN_DAYS": "P15D",
}

# ISO day numbers and the two named day sets.
ISO_DAYS = {
    "MONDAY": 1,
    "TUESDAY": 2,
    "WEDNESDAY": 3,
    "THURSDAY": 4,
    "FRIDAY": 5,
    "SATURDAY": 6,
    "SUNDAY": 7,
}
WORKDAYS = (1, 2, 3, 4, 5)
WEEKEND = (6, 7)


def ts_lit(value: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal; it folds, so comparisons with it reach the scan."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def minutes_interval(minutes: Column | int) -> Column:
    n = F.lit(minutes) if isinstance(minutes, int) else minutes
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"), F.lit(0.0))


def days_interval(days: Column | int) -> Column:
    n = F.lit(days) if isinstance(days, int) else days
    return F.make_dt_interval(n.cast("int"))


def floor_minutes(ts: str | Column, minutes: int) -> Column:
    """Start of the aligned N-minute bucket."""
    return F.window(ts, f"{minutes} minutes")["start"]


def with_bucket(df: DataFrame, minutes: int, ts: str = TIME, out: str = TIME) -> DataFrame:
    return df.withColumn(out, floor_minutes(ts, minutes))


def business_day(ts: Column) -> Column:
    """Day of ``ts`` when days start at 03:00 UTC, labelled by its calendar date."""
    shifted = ts - F.make_dt_interval(F.lit(0), F.lit(DAY_START_HOURS))
    return F.to_date(shifted).cast("timestamp_ntz")


def day_start(ts: Column) -> Column:
    return F.to_date(ts).cast("timestamp_ntz")


def week_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "week").cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month").cast("timestamp_ntz")


def hour_start(ts: Column) -> Column:
    return day_start(ts) + F.make_dt_interval(F.lit(0), F.hour(ts))


def minute_start(ts: Column) -> Column:
    return day_start(ts) + F.make_dt_interval(F.lit(0), F.hour(ts), F.minute(ts))


def month_shift(ts: Column, months: int) -> Column:
    return F.add_months(F.to_date(ts), months).cast("timestamp_ntz")


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("long")).cast("timestamp_ntz")


def iso_weekday(ts: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(ts) + F.lit(1)


def day_numbers(names: Column) -> Column:
    """ISO day numbers named by an array; null means every day.

    ``WEEKEND`` and ``WORKDAYS`` stand for their members; ``ALLDAYS`` and a missing or
    empty list mean every day. Meant for the config side, once per config row.
    """
    members = {
        **{name: (number,) for name, number in ISO_DAYS.items()},
        "WEEKEND": WEEKEND,
        "WORKDAYS": WORKDAYS,
    }
    table = F.create_map(
        *[x for n, days in members.items() for x in (F.lit(n), F.array(*[F.lit(d) for d in days]))]
    )
    listed = F.flatten(
        F.transform(
            names, lambda n: F.coalesce(F.try_element_at(table, n), F.array().cast("array<int>"))
        )
    )
    everything = names.isNull() | (F.size(names) == 0) | F.array_contains(names, "ALLDAYS")
    return F.when(~F.coalesce(everything, F.lit(True)), listed)


def on_days(ts: Column, numbers: Column) -> Column:
    """Whether ``ts`` falls on one of the day numbers; null numbers accept every day."""
    return numbers.isNull() | F.array_contains(numbers, iso_weekday(ts))


def hour_numbers(options: Column) -> Column:
    """Hours of ``_HH_MM``, ``HH:MM`` or ``HH`` options; null means any hour.

    ``ALL`` and a missing or empty list mean any hour.
    """
    hours = F.transform(
        options, lambda x: F.regexp_extract(x, r"^_?(\d{1,2})", 1).try_cast("int")
    )
    everything = options.isNull() | (F.size(options) == 0) | F.array_contains(options, "ALL")
    return F.when(~F.coalesce(everything, F.lit(True)), F.array_compact(hours))


def in_hours(ts: Column, numbers: Column) -> Column:
    """Whether the hour of ``ts`` is listed; null numbers accept every hour."""
    return numbers.isNull() | F.array_contains(numbers, F.hour(ts))


def period_tag(period: Column) -> Column:
    """Config granularity (``PT5M``) -> fact granularity (``PT300S``)."""
    table = F.create_map(*[F.lit(x) for kv in PERIOD_TAGS.items() for x in kv])
    return F.try_element_at(table, F.upper(period))


def seconds_tag(seconds: Column) -> Column:
    return F.concat(F.lit("PT"), seconds.cast("string"), F.lit("S"))


def zone_offset_minutes(zones: Column) -> Column:
    """Minutes east of UTC named by a zone list ``"+HH:MM,..."``.

    Only a list of two or more zones carries an offset, taken from its first entry;
    everything else is UTC.
    """
    parts = F.split(zones, ",")
    first = F.trim(F.element_at(parts, 1))
    sign = F.when(first.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    hours = F.regexp_extract(first, r"^[+-]?(\d{1,2}):(\d{2})$", 1).try_cast("int")
    mins = F.regexp_extract(first, r"^[+-]?(\d{1,2}):(\d{2})$", 2).try_cast("int")
    return F.when(F.size(parts) > 1, F.coalesce(sign * (hours * 60 + mins), F.lit(0))).otherwise(
        F.lit(0)
    )


def previous_period(run_ts: Column, grain: str) -> tuple[Column, Column]:
    """Half-open window of the last complete HOUR / DAY / WEEK / MONTH / half month."""
    if grain == "HOUR":
        end = hour_start(run_ts)
        return end - F.make_dt_interval(F.lit(0), F.lit(1)), end
    if grain == "DAY":
        end = day_start(run_ts)
        return end - days_interval(1), end
    if grain == "WEEK":
        end = week_start(run_ts)
        return end - days_interval(7), end
    if grain == "MONTH":
        end = month_start(run_ts)
        return month_shift(end, -1), end
    if grain == "FITTEEN_DAYS":
        first = month_start(run_ts)
        middle = days_interval(15)
        early = F.dayofmonth(run_ts) <= 15
        start = F.when(early, month_shift(first, -1) + middle).otherwise(first)
        return start, F.when(early, first).otherwise(first + middle)
    raise ValueError(f"unknown grain {grain!r}")


def previous_bucket(
    run_ts: Column, minutes: int, source_delay_minutes: int = 0
) -> tuple[Column, Column]:
    """Half-open N-minute bucket before ``run_ts``, moved back by the delay of the source."""
    base = minute_start(run_ts)
    end = (
        base
        - minutes_interval(F.minute(base) % F.lit(minutes))
        - minutes_interval(source_delay_minutes)
    )
    return end - minutes_interval(minutes), end


def busy_hour_period(run_ts: Column, period: str) -> tuple[Column, Column]:
    grain = {
        "DAILY_BUSY_HOUR": "DAY",
        "WEEKLY_BUSY_HOUR": "WEEK",
        "MONTHLY_BUSY_HOUR": "MONTH",
    }[period]
    return previous_period(run_ts, grain)


def previous_period_bounds(run_ts: datetime, grain: str) -> tuple[datetime, datetime]:
    """Driver-side twin of :func:`previous_period`, for literals that prune the scan."""
    midnight = run_ts.replace(hour=0, minute=0, second=0, microsecond=0)
    first = midnight.replace(day=1)
    before = (first - timedelta(days=1)).replace(day=1)
    if grain == "HOUR":
        end = run_ts.replace(minute=0, second=0, microsecond=0)
        return end - timedelta(hours=1), end
    if grain == "DAY":
        return midnight - timedelta(days=1), midnight
    if grain == "WEEK":
        end = midnight - timedelta(days=midnight.weekday())
        return end - timedelta(days=7), end
    if grain == "MONTH":
        return before, first
    if grain == "FITTEEN_DAYS":
        if run_ts.day <= 15:
            return before + timedelta(days=15), first
        return first, first + timedelta(days=15)
    if grain == "YEAR":
        january = first.replace(month=1)
        return january.replace(year=january.year - 1), january
    raise ValueError(f"unknown grain {grain!r}")


def rollup_interval(
    run_ts: Column, grain_minutes: int, process: str = "load", days_back: int = 0,
    source_lag_hours: int = 0,
) -> tuple[Column, Column]:
    """Bucket a roll-up run has to (re)compute.

    ``load`` takes the last complete bucket before the run time, ``days_back`` days earlier
    and shifted by the lag of the source; ``interval`` and ``reprocess`` take the bucket
    that starts at ``run_ts``. Daily buckets start at 03:00 UTC.
    """
    daily = grain_minutes == 1440
    if process in ("interval", "reprocess"):
        start = run_ts
        end = run_ts + minutes_interval(grain_minutes)
    elif process == "load":
        base = run_ts - days_interval(days_back)
        base = base - F.make_dt_interval(F.lit(0), F.lit(source_lag_hours))
        if daily:
            end = day_start(base)
        else:
            end = minute_start(base) - minutes_interval(F.minute(base) % F.lit(grain_minutes))
        start = end - minutes_interval(grain_minutes)
    else:
        raise ValueError(f"unknown process {process!r}")
    if daily:
        shift = F.make_dt_interval(F.lit(0), F.lit(DAY_START_HOURS))
        start, end = start + shift, end + shift
    return start, end


def bucket_series(df: DataFrame, start: str, end: str, minutes: int, out: str = "bucket") -> DataFrame:
    """One row per bucket start in ``[start, end)``; an empty range gives no row."""
    # A range that is not a whole number of steps still ends with a started bucket.
    stop = F.greatest(F.col(start), F.col(end) - F.make_dt_interval(secs=F.lit(0.000001)))
    series = F.sequence(F.col(start), stop, minutes_interval(minutes))
    return df.where(F.col(start) < F.col(end)).withColumn(out, F.explode(series))


def buckets(spark: SparkSession, start: datetime, end: datetime, minutes: int) -> DataFrame:
    """Bucket frame for a backfill over ``[start, end)``."""
    span = spark.range(1).select(ts_lit(start).alias("start"), ts_lit(end).alias("end"))
    return bucket_series(span, "start", "end", minutes, TIME).select(TIME)
