"""Counter runs that go on where the last one published: the mark is stored, read back and advanced."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemeter.functions.timeutil import ts_lit
from wavemeter.model import TIME
from wavemeter.operators.counters import (
    TIMESTAMP_LAYOUTS,
    CounterSpec,
    complete_buckets,
    counter_incremental,
    high_water_mark,
)
from wavemeter.sinks.tables import finish_replacement, partition_values, replace_partitions
from wavemeter.sources.landed import partition_label

# Partition of the marks, and of the published rows: each run is one, named by where it began.
JOB, RUN = "job", "run"
# Fixed value: how far a first run looks back.
FIRST_LOOK_BACK = timedelta(hours=24)
CLUSTER = ("additionalDn", "name", TIME)


def read_mark(spark: SparkSession, marks: str, job: str) -> datetime | None:
    """Where a job's published rows end; None before its first run.

    Marks are text. Those of other tools may be in any of the landed layouts.
    """
    finish_replacement(spark, marks, JOB)
    if job not in partition_values(spark, marks, JOB):
        return None
    rows = spark.read.schema(f"mark string, run_ts timestamp_ntz, {JOB} string").parquet(marks)
    return high_water_mark(rows.where(F.col(JOB) == job), "mark", TIMESTAMP_LAYOUTS).first()[0]


def advance_mark(spark: SparkSession, marks: str, job: str, mark: datetime, run_ts: datetime) -> None:
    """Store a job's mark in place of the one before; marks of other jobs stay."""
    row = spark.createDataFrame([(mark.isoformat() + "Z", run_ts, job)], f"mark string, run_ts timestamp_ntz, {JOB} string")
    replace_partitions(spark, row, marks, JOB, ("mark",))


def publish_run(
    spark: SparkSession, rows: DataFrame, specs: Sequence[CounterSpec] | CounterSpec, out: str,
    mark: datetime, now: datetime,
) -> datetime | None:
    """Publish the buckets that closed between ``mark`` and ``now``; return where they end.

    A run is the partition named by its first bucket. It is replaced whole, so publishing again
    from the same mark, even up to a later ``now``, leaves no row twice. None if there was no row.
    """
    first = specs if isinstance(specs, CounterSpec) else specs[0]
    minutes = first.outer_minutes or first.minutes
    start, _ = complete_buckets(mark, now, minutes)
    label = partition_label(start, "minute")
    result = counter_incremental(rows, specs, mark, now).withColumn(RUN, F.lit(label))
    replace_partitions(spark, result, out, RUN, CLUSTER, [label])
    if label not in partition_values(spark, out, RUN):
        return None
    # What is in the table decides, not what was computed.
    last = spark.read.parquet(out).where(F.col(RUN) == label).agg(F.max(TIME)).first()[0]
    return last + timedelta(minutes=minutes)


def run_incremental(
    spark: SparkSession, rows: DataFrame, specs: Sequence[CounterSpec] | CounterSpec, out: str, marks: str,
    job: str, now: datetime,
) -> datetime | None:
    """One run of a job: read its mark, publish what closed since, then advance the mark.

    A run that dies before the mark is advanced is repeated by the next from the same place. A run
    without rows leaves the mark, so buckets that fill later are still read.
    """
    mark = read_mark(spark, marks, job) or now - FIRST_LOOK_BACK
    end = publish_run(spark, rows, specs, out, mark, now)
    if end is not None:
        advance_mark(spark, marks, job, end, now)
    return end


def published(spark: SparkSession, out: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Published rows, of ``[start, end)`` if given. Runs that began after the end are not opened."""
    rows = spark.read.parquet(out)
    if start is not None:
        rows = rows.where(F.col(TIME) >= ts_lit(start))
    if end is not None:
        rows = rows.where((F.col(RUN) < partition_label(end, "minute")) & (F.col(TIME) < ts_lit(end)))
    return rows.drop(RUN)
