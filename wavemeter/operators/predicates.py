"""Value derivation and row filters used across the roll-ups and evaluations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemeter.functions.timeutil import ts_lit
from wavemeter.model import TIME

# Facts older than this are clock errors.
EARLIEST_FACT = datetime(2022, 1, 1)


def rate_value(
    is_rate: str = "isRate", num: str = "numerator", den: str = "denominator", value: str = "value"
) -> Column:
    """Numerator over denominator for rate metrics with a usable denominator, else the value."""
    usable = F.col(is_rate) & (F.col(den) != 0)
    return F.when(usable, F.col(num) / F.col(den)).otherwise(F.col(value))


def with_rate_value(df: DataFrame) -> DataFrame:
    """Replace ``value`` by :func:`rate_value` and drop rows that have none."""
    return df.withColumn("value", rate_value()).where(F.col("value").isNotNull())


def usable_rate_row() -> Column:
    """Rate rows need a non-zero denominator; other rows pass."""
    return F.when(F.col("isRate"), F.col("denominator") != 0).otherwise(F.lit(True))


def in_interval(start: datetime, end: datetime, ts: str = TIME) -> Column:
    """``[start, end)`` with literals, so it prunes at the scan."""
    return (F.col(ts) >= ts_lit(start)) & (F.col(ts) < ts_lit(end))


def in_closed_interval(start: datetime, end: datetime, ts: str = TIME) -> Column:
    return F.col(ts).between(ts_lit(start), ts_lit(end))


def settled_after(mark: datetime, now: datetime, settle_minutes: int, ts: str = TIME) -> Column:
    """Rows above the high-water mark and older than the settling time; both ends open."""
    limit = now - timedelta(minutes=settle_minutes)
    return (F.col(ts) > ts_lit(mark)) & (F.col(ts) < ts_lit(limit))


def any_shared(groups: Column, wanted: Column) -> Column:
    """Array overlap that is false, never null, on missing groups."""
    return F.coalesce(F.arrays_overlap(groups, wanted), F.lit(False))


def out_of_range_time(now: datetime, ts: str = TIME) -> Column:
    """Facts at least one day ahead of ``now``, or before any fact can exist."""
    return (F.col(ts) >= ts_lit(now + timedelta(days=1))) | (F.col(ts) <= ts_lit(EARLIEST_FACT))


def split_time_outliers(df: DataFrame, now: datetime, ts: str = TIME) -> tuple[DataFrame, DataFrame]:
    """``(clean, quarantined)``."""
    bad = out_of_range_time(now, ts)
    return df.where(~bad), df.where(bad)


def active_elements(df: DataFrame) -> DataFrame:
    return df.where((F.col("Type") == "Element") & (F.col("State") == "Active"))


def relabel(
    df: DataFrame, names: Mapping[str, str], stamp: datetime, stamp_column: str = "processing_date"
) -> DataFrame:
    return df.withColumnsRenamed(dict(names)).withColumn(stamp_column, ts_lit(stamp))


def fill_missing(df: DataFrame, marker: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls of the given (by default: all) columns as marker text."""
    names = list(columns) if columns is not None else df.columns
    return df.withColumns(
        {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(marker)) for c in names}
    )
