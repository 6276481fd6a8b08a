"""Streaming versions of the batch jobs. Checkpoints go to the shared folder."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wavemeter.model import MEASURES, TIME
from wavemeter.operators.rollup import GRAINS, raw_rows
from wavemeter.sinks.messages import keyed_json
from wavemeter.sources.landed import split_malformed


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Messages of a topic from the earliest offset; progress lives in the checkpoint."""
    reader = spark.readStream.format("kafka").option("startingOffsets", "earliest")
    return reader.options(**options).load().selectExpr(
        "cast(key AS string) AS key", "cast(value AS string) AS value", "timestamp"
    )


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, format_: str = "parquet",
    options: Mapping[str, str] | None = None, files_per_batch: int = 1000,
) -> DataFrame:
    """Files of a folder as they land; a backlog comes in batches of bounded size."""
    reader = spark.readStream.schema(schema).format(format_)
    bounded = {"maxFilesPerTrigger": str(files_per_batch), **(options or {})}
    return reader.options(**bounded).load(path)


def drain(
    stream: DataFrame, sink: str, checkpoint: str, format_: str = "parquet", mode: str = "append"
) -> StreamingQuery:
    """Process what is there now, then stop; a later call goes on from the checkpoint."""
    query = (
        stream.writeStream.format(format_)
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def drain_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """As :func:`drain`, handing every micro-batch to ``handle``.

    The offset of a batch is committed only after ``handle`` returned, so a failed batch
    comes again under the same number.
    """
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def watermark_of(query: StreamingQuery) -> datetime | None:
    """Event time up to which a query has closed its state; None before the first row."""
    progress = query.lastProgress
    text = ((progress or {}).get("eventTime") or {}).get("watermark")
    moment = datetime.fromisoformat(text).replace(tzinfo=None) if text else None
    return moment if moment and moment.year > 1970 else None


@dataclass(frozen=True)
class Consumed:
    """What a bounded run took in."""

    rows: int
    seconds: float
    batches: int

    @property
    def rate(self) -> float:
        """Rows a second of wall time."""
        return self.rows / self.seconds if self.seconds else 0.0


def follow(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str,
    seconds: float, mode: str = "append",
) -> Consumed:
    """Run for at most ``seconds``, one micro-batch per interval, and say what was taken in.

    When the time is up, the batch that is under way is finished before the query stops, so its
    offsets are committed and the next run begins behind it. An error of the stream is raised here.
    """
    taken = {"rows": 0, "batches": 0, "busy": False}

    def counted(batch: DataFrame, number: int) -> None:
        taken["busy"] = True
        seen = Observation()
        handle(batch.observe(seen, F.count(F.lit(1)).alias("rows")), number)
        taken["rows"] += seen.get["rows"]
        taken["batches"] += 1
        taken["busy"] = False

    started = time.monotonic()
    query = (
        stream.writeStream.foreachBatch(counted)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(processingTime=every)
        .start()
    )
    try:
        query.awaitTermination(max(0.0, seconds))
        # A trigger that is active has offsets to commit after its batch.
        while query.isActive and (taken["busy"] or query.status["isTriggerActive"]):
            query.awaitTermination(0.05)
    finally:
        query.stop()
    if query.exception():
        raise query.exception()
    return Consumed(taken["rows"], time.monotonic() - started, taken["batches"])


def _first_level() -> list:
    out = [F.count(F.lit(1)).alias("count")]
    for m in MEASURES:
        out += [F.sum(m).alias(f"sum_{m}"), F.max(m).alias(f"max_{m}"), F.min(m).alias(f"min_{m}")]
    return out


def stream_rollup(
    facts: DataFrame, grain: str, keys: Sequence[str], delay: str
) -> DataFrame:
    """Level-1 roll-up that emits a bucket once the watermark has passed its end.

    ``delay`` is how late facts may come. The result keeps the ``window`` column, so that
    the next level can be chained.
    """
    # Watermarks need a zoned timestamp; the session zone is UTC.
    rows = raw_rows(facts, grain).withColumn(TIME, F.col(TIME).cast("timestamp"))
    return first_level(rows.withWatermark(TIME, delay), grain, keys)


def first_level(rows: DataFrame, grain: str, keys: Sequence[str]) -> DataFrame:
    """Level-1 roll-up of raw rows per ``window`` and key, streamed or not."""
    return rows.groupBy(F.window(TIME, f"{GRAINS[grain].minutes} minutes"), *keys).agg(*_first_level())


def stream_next_level(rolled: DataFrame, grain: str, keys: Sequence[str]) -> DataFrame:
    """Next level over the closed buckets of the level below."""
    merged = [F.sum("count").alias("count")]
    for m in MEASURES:
        merged += [
            F.sum(f"sum_{m}").alias(f"sum_{m}"),
            F.max(f"max_{m}").alias(f"max_{m}"),
            F.min(f"min_{m}").alias(f"min_{m}"),
        ]
    return rolled.groupBy(F.window("window", f"{GRAINS[grain].minutes} minutes"), *keys).agg(*merged)


def closed(rolled: DataFrame) -> DataFrame:
    """Roll-up rows with the bucket start as ``__time``."""
    return rolled.withColumn(TIME, F.col("window.start").cast("timestamp_ntz")).drop("window")


def redirect(messages: DataFrame, key: str) -> DataFrame:
    """Messages for another topic under one constant key."""
    return messages.select(F.lit(key).alias("key"), "value")


def split_stream(
    messages: DataFrame, schema: T.StructType, host: str, good: str, bad: str, checkpoint: str
) -> None:
    """Readable records and error records of a stream to two tables.

    Files are named by batch, so a repeated batch overwrites itself.
    """

    def handle(batch: DataFrame, number: int) -> None:
        # Both tables are written from one read of the batch.
        held = batch.persist(StorageLevel.DISK_ONLY)
        records, errors = split_malformed(held, schema, host)
        records.write.mode("overwrite").parquet(f"{good}/batch={number}")
        keyed_json(errors, host).write.mode("overwrite").parquet(f"{bad}/batch={number}")
        held.unpersist()

    drain_batches(messages, handle, checkpoint)
