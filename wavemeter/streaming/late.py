"""Rows that come after their bucket was closed: counted, listed, and made good by a rerun."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemeter.functions.timeutil import floor_minutes, minutes_interval, ts_lit
from wavemeter.model import TIME
from wavemeter.operators.recompute import rows_of_buckets
from wavemeter.operators.rollup import GRAINS, raw_rows
from wavemeter.sinks.tables import partition_values, replace_buckets
from wavemeter.sources.landed import PARTITION
from wavemeter.streaming.jobs import closed, drain_batches, first_level, stream_rollup, watermark_of


@dataclass(frozen=True)
class StreamedLevel:
    """A level kept by a stream: its table, the counts of what arrived, and both checkpoints.

    ``partition`` is the grain of the table's folders: a batch rewrites those of the buckets it closes.
    """

    folder: str
    grain: str
    keys: tuple[str, ...]
    delay: str
    partition: str = "hour"

    @property
    def level(self) -> str:
        return f"{self.folder}/level"

    @property
    def arrivals(self) -> str:
        return f"{self.folder}/arrivals"

    def checkpoint(self, of: str) -> str:
        return f"{self.folder}/checkpoint-{of}"

    @property
    def cluster(self) -> tuple[str, ...]:
        return (*self.keys, TIME)


def count_arrivals(facts: DataFrame, job: StreamedLevel) -> None:
    """Rows of every bucket, counted as they arrive. A few numbers per batch, whatever its size.

    Files are named by batch, so a repeated batch overwrites itself. Rows without a time are counted
    under a null bucket.
    """

    def handle(batch: DataFrame, number: int) -> None:
        # A window would leave rows without a time out.
        timed = F.coalesce(F.col(TIME), F.timestamp_seconds(F.lit(0)).cast("timestamp_ntz"))
        bucket = F.when(F.col(TIME).isNotNull(), floor_minutes(timed, GRAINS[job.grain].minutes))
        counts = batch.groupBy(bucket.alias(TIME)).agg(F.count(F.lit(1)).alias("arrived"))
        counts.write.mode("overwrite").parquet(f"{job.arrivals}/batch={number}")

    drain_batches(raw_rows(facts, job.grain), handle, job.checkpoint("arrivals"))


def roll_up(spark: SparkSession, facts: DataFrame, job: StreamedLevel) -> datetime | None:
    """Store the buckets that the watermark has closed; return the watermark.

    All rows of a bucket are emitted by one batch, so a batch replaces whole buckets and may be
    repeated. ``count_arrivals`` runs first: what this run takes in has then been counted.
    """

    def handle(batch: DataFrame, number: int) -> None:
        replace_buckets(spark, closed(batch), job.level, job.cluster, job.partition)

    query = drain_batches(
        stream_rollup(facts, job.grain, job.keys, job.delay), handle, job.checkpoint("level")
    )
    return watermark_of(query)


def late_ledger(spark: SparkSession, job: StreamedLevel, watermark: datetime | None) -> DataFrame:
    """Buckets whose rows did not all reach the level: ``arrived``, ``rolled`` and ``late`` rows.

    A bucket is judged once the watermark of the level has passed its end; later ones are still open.
    So every counted row is in the level, in an open bucket, or late here. Rows without a time are
    listed under a null bucket: no level can hold them.
    """
    arrived = (
        spark.read.schema(f"{TIME} timestamp_ntz, arrived long, batch int").parquet(job.arrivals)
        .groupBy(TIME)
        .agg(F.sum("arrived").alias("arrived"))
    )
    ends = F.col(TIME) + minutes_interval(GRAINS[job.grain].minutes)
    over = (ends <= ts_lit(watermark)) if watermark else F.lit(False)
    missing = F.col("arrived") - F.coalesce("rolled", F.lit(0))
    return (
        arrived.join(_rolled(spark, job), F.col(TIME) == F.col("__t"), "left")
        .where(F.col(TIME).isNull() | over)
        .select(TIME, "arrived", F.coalesce("rolled", F.lit(0)).alias("rolled"), missing.alias("late"))
        .where("late > 0")
    )


def _rolled(spark: SparkSession, job: StreamedLevel) -> DataFrame:
    """Rows of every bucket of the level."""
    if not partition_values(spark, job.level, PARTITION):
        return spark.createDataFrame([], "__t timestamp_ntz, rolled long")
    return spark.read.parquet(job.level).groupBy(F.col(TIME).alias("__t")).agg(F.sum("count").alias("rolled"))


def rerun_late(spark: SparkSession, facts: DataFrame, job: StreamedLevel, ledger: DataFrame) -> None:
    """Rebuild the listed buckets from all their facts and replace them in the level.

    The first and last bucket bound the scan of ``facts``, the stored form of what was streamed.
    A rebuilt bucket holds all that arrived, so it leaves the ledger.
    """
    due = ledger.select(TIME).where(F.col(TIME).isNotNull())
    rows = rows_of_buckets(raw_rows(facts, job.grain), due, job.grain)
    rebuilt = closed(first_level(rows, job.grain, job.keys))
    replace_buckets(spark, rebuilt, job.level, job.cluster, job.partition)
