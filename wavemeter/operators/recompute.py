"""Which buckets a run recomputes, and recomputing many of them in one job."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavemeter.functions.timeutil import rollup_interval, ts_lit
from wavemeter.model import TIME
from wavemeter.operators.rollup import GRAINS, bucket, rollup_group, rollup_temporal

# Days back a load repeats its bucket, for sources that deliver late.
LATE_DAYS = (0, 1, 3)
PROMPT_DAYS = (0,)


def load_intervals(
    runs: DataFrame, grain: str, process: str = "load", days_back: Sequence[int] = LATE_DAYS,
    source_lag_hours: int = 0, run_ts: str = "run_ts",
) -> DataFrame:
    """Runs with the interval each has to (re)compute, one row per day back."""
    minutes = GRAINS[grain].minutes
    days = days_back if process == "load" else (0,)
    spans = []
    for d in days:
        start, end = rollup_interval(F.col(run_ts), minutes, process, d, source_lag_hours)
        spans.append(
            F.struct(
                F.lit(d).alias("days_back"),
                start.alias("interval_start"),
                end.alias("interval_end"),
            )
        )
    return runs.select("*", F.inline(F.array(*spans)))


def due_after(buckets: DataFrame, grain: str, next_grain: str, ts: str = TIME) -> DataFrame:
    """Buckets of the next level whose last part is among the given buckets."""
    step, longer = GRAINS[grain].minutes, GRAINS[next_grain].minutes
    start = F.window(F.col(ts), f"{longer} minutes")["start"]
    last_part = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(longer - step))
    return (
        buckets.withColumn("__start", start)
        .withColumn("__last", last_part)
        .where(F.col(ts) == F.col("__last"))
        .select(F.col("__start").alias(TIME))
        .distinct()
    )


# Bucket times (8 bytes each) that become literal rows of a plan.
LITERAL_BUCKETS = 20_000


def known_buckets(buckets: DataFrame, limit: int = LITERAL_BUCKETS) -> DataFrame:
    """Distinct buckets, evaluated once and broadcast as literal rows when there are few.

    More than ``limit`` buckets stay a plan of their own and join by shuffle.
    """
    distinct = buckets.select(TIME).distinct()
    rows = distinct.limit(limit + 1).collect()
    if len(rows) > limit:
        return distinct
    return F.broadcast(
        buckets.sparkSession.createDataFrame([(r[0],) for r in rows], f"{TIME} timestamp_ntz")
    )


def rows_of_buckets(facts: DataFrame, buckets: DataFrame, grain: str) -> DataFrame:
    """Facts whose bucket is listed.

    The first and last bucket become literal bounds, so that the scan skips everything
    outside.
    """
    span = buckets.agg(F.min(TIME).alias("a"), F.max(TIME).alias("b")).first()
    if span["a"] is None:
        return facts.limit(0)
    # A daily bucket is labelled by its date and starts hours later.
    end = span["b"] + timedelta(minutes=2 * GRAINS[grain].minutes)
    near = facts.where((F.col(TIME) >= ts_lit(span["a"])) & (F.col(TIME) < ts_lit(end)))
    wanted = buckets.select(F.col(TIME).alias("__bucket"))
    return (
        near.withColumn("__bucket", bucket(grain))
        .join(wanted, "__bucket", "left_semi")
        .drop("__bucket")
    )


def recompute(
    facts: DataFrame, buckets: DataFrame, grain: str, groups: bool = False, sketch: bool = True
) -> DataFrame:
    """Roll-up of exactly the given buckets (column ``__time``), all in one job."""
    rows = rows_of_buckets(facts, known_buckets(buckets), grain)
    build = rollup_group if groups else rollup_temporal
    return build(rows, grain, sketch)
