"""Parquet tables: journaled partition replace, keyed upsert, compaction, control rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemeter.functions.timeutil import ts_lit
from wavemeter.model import TIME
from wavemeter.operators.status import latest_per_key, upsert
from wavemeter.sources.landed import PARTITION, partition_label

ROWS_PER_FILE = 4_000_000
# How the partition of a time is named, as :func:`partition_label` does it.
_PATTERNS = {"day": "yyyyMMdd", "hour": "yyyyMMddHH", "minute": "yyyyMMddHHmm"}


def _folder(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


# Folders of a replacement under way; readers pass over names that begin with an underscore.
STAGED, JOURNAL = "_staged-", "_journal-"


def replace_partitions(
    spark: SparkSession, df: DataFrame, path: str, column: str, cluster: Sequence[str], covered: Iterable[str] = (),
) -> None:
    """Replace the partitions found in ``df``, and empty those of ``covered`` that got no row.

    Rows are first written beside the table, then a journal names every partition to swap or to
    empty, and only then are folders touched. A run that dies before its journal leaves the
    table as it was; one that dies later is finished by :func:`finish_replacement`, which every
    replacement calls first, so each step may happen twice. One writer per table is assumed; a
    reader that overlaps the swap may have to start again. ``df`` may read the table itself.
    """
    finish_replacement(spark, path, column)
    run = uuid.uuid4().hex
    staged = f"{path}/{STAGED}{run}"
    # Rebalancing splits a hot day over several files and needs no look at the rows beforehand, which
    # would build them twice; every file is sorted.
    (
        df.hint("rebalance", F.col(column))
        .sortWithinPartitions(column, *cluster)
        .write.option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(column)
        .parquet(staged)
    )
    filled = set(partition_values(spark, staged, column))
    steps = [(name, True) for name in sorted(filled)] + [(name, False) for name in sorted(set(covered) - filled)]
    if not steps:
        _delete(spark, staged)
        return
    journal = spark.createDataFrame(steps, "name string, filled boolean")
    journal.coalesce(1).write.parquet(f"{path}/{JOURNAL}{run}")
    finish_replacement(spark, path, column)


def finish_replacement(spark: SparkSession, path: str, column: str) -> None:
    """Carry out what journals of a table say, and drop what runs without a journal left."""
    children = _children(spark, path)
    for name in children:
        journal = f"{path}/{name}"
        if not name.startswith(JOURNAL) or not exists(spark, f"{journal}/_SUCCESS"):
            continue
        staged = f"{path}/{STAGED}{name.removeprefix(JOURNAL)}"
        for step in spark.read.parquet(journal).collect():
            _swap(spark, staged, path, f"{column}={step['name']}", step["filled"])
        _delete(spark, staged)
        _delete(spark, journal)
    for name in children:
        if name.startswith((STAGED, JOURNAL)):
            _delete(spark, f"{path}/{name}")


def _swap(spark: SparkSession, staged: str, path: str, partition: str, filled: bool) -> None:
    """One step of a journal. A staged folder that is gone was moved before."""
    if not filled:
        _delete(spark, f"{path}/{partition}")
    elif exists(spark, f"{staged}/{partition}"):
        _delete(spark, f"{path}/{partition}")
        files, source = _folder(spark, f"{staged}/{partition}")
        if not files.rename(source, _folder(spark, f"{path}/{partition}")[1]):
            raise OSError(f"cannot move {staged}/{partition}")


def _delete(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def _children(spark: SparkSession, path: str) -> list[str]:
    files, folder = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a table's partitions."""
    return [name.removeprefix(f"{column}=") for name in _children(spark, path) if name.startswith(f"{column}=")]


def replace_interval(
    spark: SparkSession, df: DataFrame, path: str, start: datetime, end: datetime,
    cluster: Sequence[str], grain: str = "hour",
) -> None:
    """Replace exactly ``[start, end)`` of a table partitioned by time grain.

    Bounds that are not aligned to the grain are refused, as partitions are replaced whole, and
    a row outside the interval ends the job. Partitions of the interval that get no new row are
    emptied, other partitions stay untouched, a second run gives the same table, and a run that
    died half-way is finished by the next.
    """
    for bound in (start, end):
        if bound != _floor(bound, grain):
            raise ValueError(f"{bound} is not aligned to a {grain}")
    # A fixed prefix keeps the labels text when the table is read back.
    inside = (F.col(TIME) >= ts_lit(start)) & (F.col(TIME) < ts_lit(end))
    outside = F.raise_error(
        F.concat(F.lit(f"outside [{start}, {end}): "), F.coalesce(F.col(TIME).cast("string"), F.lit("null")))
    )
    rows = df.withColumn(
        PARTITION, F.when(inside, F.concat(F.lit("t"), F.date_format(TIME, _PATTERNS[grain]))).otherwise(outside)
    )
    first, last = partition_label(start, grain), partition_label(end, grain)
    covered = [name for name in partition_values(spark, path, PARTITION) if first <= name < last]
    replace_partitions(spark, rows, path, PARTITION, cluster, covered)


def replace_buckets(
    spark: SparkSession, df: DataFrame, path: str, cluster: Sequence[str], grain: str = "hour",
    covered: Sequence[datetime] = (),
) -> None:
    """Replace the buckets (values of ``__time``) found in ``df``, and empty those of ``covered`` without a row.

    Only the partitions that hold these buckets are rewritten; their other buckets stay. Rows
    are landed once and then read as often as needed, so an input that may be evaluated only
    once is fine. The same rows once more have no effect.
    """
    finish_replacement(spark, path, PARTITION)
    label = F.concat(F.lit("t"), F.date_format(TIME, _PATTERNS[grain]))
    df.withColumn(PARTITION, label).write.mode("overwrite").parquet(f"{path}/_changes")
    news = spark.read.parquet(f"{path}/_changes")
    listed = spark.createDataFrame([(moment,) for moment in covered], f"{TIME} timestamp_ntz")
    buckets = news.select(TIME).unionByName(listed).distinct()
    touched = {r[0] for r in news.select(PARTITION).distinct().collect()}
    touched |= {partition_label(moment, grain) for moment in covered}
    rows, there = news, sorted(touched & set(partition_values(spark, path, PARTITION)))
    if there:
        held = spark.read.parquet(path).where(F.col(PARTITION).isin(*there)).join(buckets, TIME, "left_anti")
        rows = held.select(*news.columns).unionByName(news)
    replace_partitions(spark, rows, path, PARTITION, cluster, touched)


# Partition of a key's rows in a keyed table.
SLOT = "slot"


def upsert_table(
    spark: SparkSession, changes: DataFrame, path: str, keys: Sequence[str], order: Column | None = None,
    slots: int = 64,
) -> None:
    """Insert or replace rows of a keyed table by key; only the slots of changed keys are rewritten.

    Keys are dealt by hash into ``slots`` partitions, a number that stays with the table; choose it so
    that a slot is some files large. Changes are landed once and then read as often as needed,
    so an input that may be evaluated only once is fine. The same changes once more have no effect.
    """
    finish_replacement(spark, path, SLOT)
    landed = f"{path}/_changes"
    slot = F.format_string("s%05d", F.pmod(F.xxhash64(*keys), F.lit(slots)))
    changes.withColumn(SLOT, slot).write.mode("overwrite").parquet(landed)
    news = spark.read.parquet(landed)
    touched = [r[0] for r in news.select(SLOT).distinct().collect()]
    if not touched:
        return
    if set(touched) & set(partition_values(spark, path, SLOT)):
        held = spark.read.parquet(path).where(F.col(SLOT).isin(*touched)).select(*news.columns)
    else:
        held = news.limit(0)
    replace_partitions(spark, upsert(held, news, keys, order), path, SLOT, keys)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of a keyed table, or None before the first change."""
    return spark.read.parquet(path).drop(SLOT) if partition_values(spark, path, SLOT) else None


def _floor(moment: datetime, grain: str) -> datetime:
    smaller = {"day": {"hour": 0, "minute": 0}, "hour": {"minute": 0}, "minute": {}}[grain]
    return moment.replace(second=0, microsecond=0, **smaller)


def write_busy_hours(df: DataFrame, path: str) -> None:
    """Busy-hour rows by (periodicity, date, config); a re-run replaces what it covers."""
    keys = ("periodicity", "data_date", "BH_configuration_id")
    (
        df.withColumn("data_date", F.date_format("data_date_start", "'d'yyyyMMdd"))
        # By range of element, so that a config with most rows is written by many tasks.
        .repartitionByRange(*keys, "dn", "BH_level")
        .sortWithinPartitions(*keys, "dn", "BH_level")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*keys)
        .parquet(path)
    )


def compact(
    spark: SparkSession, stage: str, lake: str, keys: Sequence[str], spread: int | None = None
) -> None:
    """Partial files of a stage as ``spread`` files per partition, promoted to the lake.

    Without ``spread`` the largest partition is counted and written in files of the usual
    size, each by its own task. Promotion overwrites the partitions found in the stage and
    leaves the others alone.
    """
    staged = spark.read.parquet(stage)
    if spread is None:
        most = staged.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        spread = max(1, -(-most // ROWS_PER_FILE))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in staged.columns if c not in keys]), F.lit(spread))
    (
        staged.repartition(*keys, salt)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*keys)
        .parquet(lake)
    )


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_control(df: DataFrame, path: str) -> None:
    """Append load attempts to the control table."""
    df.write.mode("append").parquet(path)


def current_load_status(control: DataFrame) -> DataFrame:
    """Status of the last attempt per threshold and KPI."""
    return latest_per_key(control, ("threshold_id", "kpi_id"), ("load_datatime", "status"))
