"""Counter aggregation over aligned buckets, single level or nested."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemeter.functions.scalars import suffixed
from wavemeter.functions.timeutil import (
    epoch_millis,
    floor_minutes,
    minutes_interval,
    seconds_tag,
    ts_lit,
)
from wavemeter.model import TIME

KEYS = (
    "additionalDn", "dn", "vendorName", "familyId", "elementType", "sourceSystem", "managerIp",
    "isReliable",
)

FUNCTIONS = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}


@dataclass(frozen=True)
class CounterSpec:
    """One aggregation: function, bucket, name tag and, for nested ones, the outer step."""

    function: str
    minutes: int
    tag: str
    outer_function: str | None = None
    outer_minutes: int | None = None


# The aggregation templates, by interval name and function.
TEMPLATES = {
    "1_minute_to_5_minute_max_avg": (CounterSpec("avg", 1, "_5m", "max", 5),),
    "5_minute_to_15_minute_avg_max": (CounterSpec("avg", 5, "_15m", "max", 15),),
    "second_to_1_minute": tuple(CounterSpec(f, 1, "_1m") for f in ("max", "sum", "count")),
    "second_to_5_minute": tuple(CounterSpec(f, 5, "_5m") for f in ("max", "sum", "count")),
    "second_to_15_minute": tuple(CounterSpec(f, 15, "_15m") for f in ("max", "sum", "count")),
}


def complete_buckets(mark: datetime, now: datetime, minutes: int) -> tuple[datetime, datetime]:
    """``[from, to)`` of the buckets that closed after ``mark`` and before ``now``.

    ``mark`` is the end of the last bucket already published. Only whole buckets are read,
    so no bucket is ever emitted twice or from part of its rows.
    """
    def floor(t: datetime) -> datetime:
        midnight = t.replace(hour=0, minute=0, second=0, microsecond=0)
        step = timedelta(minutes=minutes)
        return midnight + ((t - midnight) // step) * step

    start = floor(mark)
    if start < mark:
        start += timedelta(minutes=minutes)
    return start, max(start, floor(now))


def base_samples(df: DataFrame, base_interval: int = 1, source: str | None = None) -> DataFrame:
    rows = df.where(F.col("reportInterval") == base_interval)
    return rows.where(F.col("sourceSystem") == source) if source else rows


def _finish(df: DataFrame, minutes: int) -> DataFrame:
    seconds = F.lit(minutes * 60)
    end = F.col(TIME) + minutes_interval(minutes)
    return (
        df.withColumn("beginTime", epoch_millis(F.col(TIME)))
        .withColumn("endTime", epoch_millis(end))
        .withColumn("reportInterval", seconds)
        .withColumn("granularityInterval", seconds_tag(seconds))
    )


def counter_agg(df: DataFrame, specs: Sequence[CounterSpec] | CounterSpec) -> DataFrame:
    """Aggregate samples by one or more specs that share bucket and nesting.

    Specs that differ only in the function share one scan, one shuffle and one group-by;
    their results become rows named ``<name><tag>_<function>``.
    """
    specs = (specs,) if isinstance(specs, CounterSpec) else tuple(specs)
    first = specs[0]
    if any((s.minutes, s.tag, s.outer_minutes) != (first.minutes, first.tag, first.outer_minutes)
           for s in specs):
        raise ValueError("specs of one call must share bucket, tag and nesting")
    keys = (*KEYS, "name", "code")
    inner = (
        df.withColumn(TIME, floor_minutes(TIME, first.minutes))
        .groupBy(TIME, *keys)
        .agg(
            *[FUNCTIONS[s.function]("value").cast("double").alias(f"__{s.function}") for s in specs],
            F.collect_set("managerFilename").alias("__files"),
        )
    )
    if first.outer_minutes is not None:
        inner = (
            inner.withColumn(TIME, floor_minutes(TIME, first.outer_minutes))
            .groupBy(TIME, *keys)
            .agg(
                *[
                    FUNCTIONS[s.outer_function](f"__{s.function}").alias(f"__{s.function}")
                    for s in specs
                ],
                F.array_distinct(F.flatten(F.collect_set("__files"))).alias("__files"),
            )
        )
    variants = F.explode(
        F.array(
            *[
                F.struct(
                    suffixed(F.col("name"), *_suffix(s)).alias("name"),
                    suffixed(F.col("code"), *_suffix(s)).alias("code"),
                    F.col(f"__{s.function}").alias("value"),
                )
                for s in specs
            ]
        )
    )
    rows = inner.select(
        TIME,
        *KEYS,
        F.array_join(F.sort_array("__files"), ",").alias("managerFilename"),
        variants.alias("__v"),
    ).select(TIME, *KEYS, "managerFilename", "__v.*")
    return _finish(rows, first.outer_minutes or first.minutes)


def _suffix(spec: CounterSpec) -> tuple[str, ...]:
    tail = (f"_{spec.outer_function}",) if spec.outer_function else ()
    return (spec.tag, f"_{spec.function}", *tail)


def counter_multilevel(df: DataFrame) -> DataFrame:
    """Per device and 15 minutes: max, sum, count, average, and the largest 1-minute average.

    The 1-minute stage is needed for its averages; the 5-minute stage of the same maxima,
    sums and counts would change nothing, so the second step goes straight to 15 minutes.
    """
    minute = (
        df.withColumn(TIME, floor_minutes(TIME, 1))
        .groupBy(TIME, F.col("additionalDn").alias("device"))
        .agg(
            F.max("value").alias("max"),
            F.sum("value").alias("sum"),
            F.count("value").alias("count"),
        )
        .withColumn("avg", F.when(F.col("count") > 0, F.col("sum") / F.col("count")))
    )
    out = (
        minute.withColumn(TIME, floor_minutes(TIME, 15))
        .groupBy(TIME, "device")
        .agg(
            F.max("max").alias("max"),
            F.max("avg").alias("maxAvg"),
            F.sum("sum").alias("sum"),
            F.sum("count").alias("count"),
        )
    )
    return out.withColumn(
        "avg", F.when(F.col("count") > 0, F.col("sum") / F.col("count"))
    ).withColumn("aggregation_interval", F.lit("15_minute"))


def counter_incremental(
    df: DataFrame, specs: Sequence[CounterSpec] | CounterSpec, mark: datetime, now: datetime
) -> DataFrame:
    """:func:`counter_agg` over the buckets that completed between ``mark`` and ``now``."""
    first = specs if isinstance(specs, CounterSpec) else specs[0]
    start, end = complete_buckets(mark, now, first.outer_minutes or first.minutes)
    rows = df.where((F.col(TIME) >= ts_lit(start)) & (F.col(TIME) < ts_lit(end)))
    return counter_agg(rows, specs)


# Layouts found in landed records besides ISO 8601 and epoch milliseconds.
TIMESTAMP_LAYOUTS = (
    "MM/dd/yyyy HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "yyyy/MM/dd HH:mm:ss",
    "dd-MMM-yyyy",
)


def parse_any_time(text: Column, layouts: Sequence[str] = ()) -> Column:
    """Text timestamp as ISO 8601, epoch milliseconds or one of ``layouts``; null when unreadable.

    Times are UTC; a zone suffix does not move them.
    """
    # At most 15 digits keep the product inside a long; four digits would be a year.
    digits = F.when(text.rlike(r"^\d{5,15}$"), text).try_cast("long")
    iso = F.when(~text.rlike(r"^\d{5,}$"), text).try_cast("timestamp_ntz")
    others = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in layouts]
    return F.coalesce(F.timestamp_millis(digits).cast("timestamp_ntz"), iso, *others)


def high_water_mark(df: DataFrame, column: str, layouts: Sequence[str] = ()) -> DataFrame:
    """One row with the latest readable time of a text column (dotted paths allowed)."""
    return df.agg(F.max(parse_any_time(F.col(column), layouts)).alias("high_water_mark"))
