"""Roll-up levels as stored tables: read the level below for an interval, replace this one's."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemeter.model import TIME
from wavemeter.operators.quality import damaged_days, reconcile_content
from wavemeter.operators.rollup import rollup_group, rollup_temporal
from wavemeter.sinks.tables import replace_interval
from wavemeter.sources.landed import read_interval

# Partition grain of every stored level, and when its daily bucket begins (UTC).
PARTITIONS = {"15m": "hour", "30m": "hour", "hourly": "hour", "daily": "day"}
DAY_START = timedelta(hours=3)
# A stored level is clustered by the columns its readers ask for first.
CLUSTER = {False: ("dn", "metricId", "additionalDn"), True: ("networkGroup", "metricId")}


def source_interval(grain: str, start: datetime, end: datetime) -> tuple[datetime, datetime]:
    """What the level below must be read for: daily buckets begin hours after their label."""
    return (start + DAY_START, end + DAY_START) if grain == "daily" else (start, end)


def store_level(
    spark: SparkSession, below: DataFrame, path: str, grain: str, start: datetime, end: datetime,
    groups: bool = False, sketch: bool = True,
) -> None:
    """Roll rows of the level below up and replace the buckets of ``[start, end)``.

    ``below`` may hold rows of other times; they are left out. A second run changes nothing.
    """
    first, last = source_interval(grain, start, end)
    rows = below.where((F.col(TIME) >= F.lit(first)) & (F.col(TIME) < F.lit(last)))
    build = rollup_group if groups else rollup_temporal
    replace_interval(
        spark, build(rows, grain, sketch), path, start, end, CLUSTER[groups], PARTITIONS[grain]
    )


def roll_stored(
    spark: SparkSession, source: str, source_grain: str, target: str, grain: str,
    start: datetime, end: datetime, groups: bool = False, sketch: bool = True,
) -> None:
    """One run of a level over stored tables: only the partitions of the interval are read."""
    first, last = source_interval(grain, start, end)
    below = read_interval(spark, source, first, last, PARTITIONS[source_grain])
    store_level(spark, below, target, grain, start, end, groups, sketch)


def cascade(
    spark: SparkSession, facts: DataFrame, paths: dict[str, str], days: list[datetime],
    sketch: bool = True,
) -> None:
    """Rebuild the stored levels 15m, hourly and daily of whole business days.

    Facts and lower levels of neighbouring days are taken together, others are not read. The
    days are those of a repair or a late run, so the list is short.
    """
    for first, last in _runs(days):
        start, end = first + DAY_START, last + DAY_START
        store_level(spark, facts, paths["15m"], "15m", start, end, sketch=sketch)
        roll_stored(spark, paths["15m"], "15m", paths["hourly"], "hourly", start, end, sketch=sketch)
        roll_stored(spark, paths["hourly"], "hourly", paths["daily"], "daily", first, last, sketch=sketch)


def _runs(days: list[datetime]) -> list[tuple[datetime, datetime]]:
    """Half-open runs of neighbouring days."""
    out: list[tuple[datetime, datetime]] = []
    for day in sorted(set(days)):
        if out and out[-1][1] == day:
            out[-1] = (out[-1][0], day + timedelta(days=1))
        else:
            out.append((day, day + timedelta(days=1)))
    return out


def repair_stored(
    spark: SparkSession, facts: DataFrame, paths: dict[str, str], start: datetime, end: datetime,
    sketch: bool = True,
) -> list[datetime]:
    """Compare the 15-minute level of ``[start, end)`` with the facts and rebuild the days that differ.

    Returns the business days rebuilt, up to the daily level. Only the partitions of the interval are
    opened, on both sides; they are compared by content, so facts that were swapped or changed are
    found as well as lost ones. The days are those of a short interval, a list of its length.
    """
    rows = facts.where((F.col(TIME) >= F.lit(start)) & (F.col(TIME) < F.lit(end)))
    kept = read_interval(spark, paths["15m"], start, end, PARTITIONS["15m"])
    days = [r["day"] for r in damaged_days(reconcile_content(rows, kept, "15m")).collect()]
    cascade(spark, facts, paths, days, sketch)
    return sorted(days)
