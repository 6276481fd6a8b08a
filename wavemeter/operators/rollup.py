"""Time and network-group roll-ups through mergeable partial aggregates.

Level 1 reads raw facts, every later level reads the level below. All aggregates combine
map-side, so a hot element or group is reduced before it is shuffled; later levels shuffle
only partials. Each call handles any number of buckets in one job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemeter.functions.quantiles import merge_sketches, value_sketch
from wavemeter.functions.timeutil import business_day, floor_minutes
from wavemeter.model import DIMENSIONS, GROUP_DIMENSIONS, MEASURES, TIME
from wavemeter.operators.predicates import with_rate_value


@dataclass(frozen=True)
class Grain:
    """A roll-up level: bucket length, and the raw cadence it reads when it is level 1."""

    minutes: int
    raw_cadence: int | None = None

    @property
    def seconds(self) -> int:
        return self.minutes * 60

    @property
    def tag(self) -> str:
        return f"PT{self.seconds}S"


# Bucket lengths and the raw cadence of each source family.
GRAINS = {
    "15m": Grain(15, 300),
    "30m": Grain(30, 900),
    "hourly": Grain(60),
    "daily": Grain(1440),
}


def bucket(grain: str) -> Column:
    spec = GRAINS[grain]
    if grain == "daily":
        return business_day(F.col(TIME))
    return floor_minutes(TIME, spec.minutes)


def _relabelled(df: DataFrame, grain: str) -> DataFrame:
    spec = GRAINS[grain]
    return (
        df.withColumn(TIME, bucket(grain))
        .withColumn("reportInterval", F.lit(spec.seconds))
        .withColumn("granularityInterval", F.lit(spec.tag))
    )


def _first_partials() -> list[Column]:
    out = [F.count(F.lit(1)).alias("count")]
    for m in MEASURES:
        out += [F.sum(m).alias(f"sum_{m}"), F.max(m).alias(f"max_{m}"), F.min(m).alias(f"min_{m}")]
    return out


def _merged_partials() -> list[Column]:
    out = [F.sum("count").alias("count")]
    for m in MEASURES:
        out += [
            F.sum(f"sum_{m}").alias(f"sum_{m}"),
            F.max(f"max_{m}").alias(f"max_{m}"),
            F.min(f"min_{m}").alias(f"min_{m}"),
        ]
    return out


def raw_rows(metrics: DataFrame, grain: str) -> DataFrame:
    """Raw facts a level-1 roll-up counts: its cadence, with a value."""
    return with_rate_value(metrics.where(F.col("reportInterval") == GRAINS[grain].raw_cadence))


def rollup_temporal(df: DataFrame, grain: str, sketch: bool = True) -> DataFrame:
    """Roll facts up to ``grain``; raw facts for 15m/30m, the level below for hourly/daily."""
    level1 = GRAINS[grain].raw_cadence is not None
    rows = _relabelled(raw_rows(df, grain) if level1 else df, grain)
    aggregates = _first_partials() if level1 else _merged_partials()
    if sketch:
        aggregates.append(
            (value_sketch("value") if level1 else merge_sketches("values_sketch")).alias(
                "values_sketch"
            )
        )
    return rows.groupBy(TIME, *DIMENSIONS).agg(*aggregates)


def explode_groups(df: DataFrame) -> DataFrame:
    """One row per (row, network group); rows without groups and null groups drop out."""
    return (
        df.where(F.col("networkGroups").isNotNull())
        .withColumn("networkGroup", F.explode("networkGroups"))
        .where(F.col("networkGroup").isNotNull())
    )


GROUP_SKETCHES = ("sum", "max", "min", "avg")


def rollup_group(df: DataFrame, grain: str, sketch: bool = True) -> DataFrame:
    """Roll facts up per network group.

    Level 1 first aggregates every raw timestamp, because the distinct element counts and
    the sketches describe single timestamps; then it floors to the bucket.
    """
    if GRAINS[grain].raw_cadence is not None:
        return _group_level1(df, grain, sketch)
    rows = _relabelled(df, grain)
    aggregates = _merged_partials() + _count_ranges()
    if sketch:
        aggregates += [
            merge_sketches(f"sketch_{f}_value").alias(f"sketch_{f}_value") for f in GROUP_SKETCHES
        ]
    out = rows.groupBy(TIME, *GROUP_DIMENSIONS).agg(*aggregates)
    return out.withColumn("avg_value", F.col("sum_value") / F.col("count"))


def _count_ranges() -> list[Column]:
    return [
        f(f"{name}_count_{c}").alias(f"{name}_count_{c}")
        for c in ("dn", "additionalDn")
        for name, f in (("max", F.max), ("min", F.min))
    ]


def _group_level1(metrics: DataFrame, grain: str, sketch: bool) -> DataFrame:
    # Columns are pruned before the explode multiplies the rows.
    needed = [TIME, *GROUP_DIMENSIONS[:-1], "networkGroups", *MEASURES, "dn", "additionalDn"]
    rows = explode_groups(raw_rows(metrics, grain).select(*needed))
    stamped = rows.groupBy(TIME, *GROUP_DIMENSIONS).agg(
        *_first_partials(),
        F.avg("value").alias("avg_value"),
        F.countDistinct("dn").alias("count_dn"),
        F.countDistinct("additionalDn").alias("count_additionalDn"),
    )
    ranges = [
        f(f"count_{c}").alias(f"{name}_count_{c}")
        for c in ("dn", "additionalDn")
        for name, f in (("max", F.max), ("min", F.min))
    ]
    sketches = [
        value_sketch(f"{f}_value").alias(f"sketch_{f}_value") for f in GROUP_SKETCHES if sketch
    ]
    out = (
        _relabelled(stamped, grain)
        .groupBy(TIME, *GROUP_DIMENSIONS)
        .agg(*_merged_partials(), *ranges, *sketches)
    )
    return out.withColumn("avg_value", F.col("sum_value") / F.col("count"))
