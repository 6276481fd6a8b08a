"""Busy hours: the hours with the highest KPI value per element and period.

Configs and metrics meet in one join, so all configs of a period are answered by one job.
Hourly values combine map-side before the ranking, which therefore sees at most one row
per element, hour and category.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavemeter.functions.timeutil import (
    day_numbers,
    day_start,
    days_interval,
    floor_minutes,
    hour_numbers,
    in_hours,
    on_days,
    period_tag,
    previous_period_bounds,
    ts_lit,
)
from wavemeter.model import TIME
from wavemeter.operators.chosen import aggregate_by_name
from wavemeter.operators.joins import BROADCAST_BYTES, row_bytes

# Period names and the calendar grain they cover.
PERIODS = {
    "DAILY_BUSY_HOUR": "DAY",
    "WEEKLY_BUSY_HOUR": "WEEK",
    "MONTHLY_BUSY_HOUR": "MONTH",
}
MAX_LEVEL = 3


def busy_hour_scope(cfg: DataFrame, run_ts: datetime, period: str) -> DataFrame:
    """Configs of a period with their half-open window and the days and hours they accept.

    Special-date configs replace the period window by their own day. A daily config whose
    day set does not hold the evaluated day drops out.
    """
    start, end = previous_period_bounds(run_ts, PERIODS[period])
    special = F.col("effectiveDay") == "SPECIALDATES"
    own_day = F.to_date(F.try_to_timestamp(F.substring("date", 1, 10), F.lit("yyyy-MM-dd")))
    own_day = own_day.cast("timestamp_ntz")
    named_days = (
        F.when(F.col("effectiveDay") == "PERIODDAYS", F.array_compact("day1"))
        .when(F.col("effectiveDay") == "SPECIFICDAYS", F.array_compact("day2"))
    )
    scoped = (
        cfg.where((F.col("period") == period) & (F.coalesce("dataTableName", F.lit("")) != ""))
        .withColumn("window_start", F.when(special, own_day).otherwise(ts_lit(start)))
        .withColumn(
            "window_end", F.when(special, own_day + days_interval(1)).otherwise(ts_lit(end))
        )
        .withColumn("days", day_numbers(named_days))
        .withColumn("hours", hour_numbers(F.col("effective_hours")))
        .withColumn("granularityInterval", period_tag(F.col("defaultTimeGranularity")))
    )
    if period == "DAILY_BUSY_HOUR":
        scoped = scoped.where(special | on_days(F.col("window_start"), F.col("days")))
    return scoped


@dataclass(frozen=True)
class ScopeFacts:
    """What the evaluation has to know about its configs before it builds the plan."""

    broadcastable: bool
    functions: frozenset[str]
    start: datetime | None
    end: datetime | None


def known_scope(scope: DataFrame) -> tuple[DataFrame, ScopeFacts]:
    """The settings with a ``setting`` each of its own, and what is known of them.

    Every setting is evaluated alone, also where two name the same node and KPI; settings that agree in
    everything are one. One small job measures them. Those that may be broadcast are then read
    once and become literal rows, numbered; others are named by a 256-bit digest.
    """
    columns = scope.columns
    found = scope.agg(
        F.sum(row_bytes(*columns)),
        F.collect_set(F.upper("aggregationFunction")),
        F.min("window_start"),
        F.max("window_end"),
    ).first()
    facts = ScopeFacts((found[0] or 0) <= BROADCAST_BYTES, frozenset(found[1]), found[2], found[3])
    if not facts.broadcastable:
        text = F.to_json(F.struct(*columns))
        return scope.withColumn("setting", F.unhex(F.sha2(text, 256))).dropDuplicates(["setting"]), facts
    once = {repr(row): row for row in scope.collect()}
    rows = [(n, *once[text]) for n, text in enumerate(sorted(once))]
    kind = T.StructType([T.StructField("setting", T.IntegerType()), *scope.schema.fields])
    return scope.sparkSession.createDataFrame(rows, kind), facts


def _in_scope(metrics: DataFrame, scope: DataFrame, known: ScopeFacts) -> DataFrame:
    if known.start is None:
        metrics = metrics.limit(0)
    else:
        # Literal bounds prune the scan; special dates of the configs widen them.
        metrics = metrics.where(
            (F.col(TIME) >= ts_lit(known.start)) & (F.col(TIME) < ts_lit(known.end))
        )
    facts = metrics.select(
        TIME, "metricId", "managedObjectId", "granularityInterval", "dn", "additionalDn",
        "category", "value",
    ).where(F.col("value").isNotNull())
    configs = scope.select(
        "node_id", "node_name", "kpi_id", "kpi_name", "managedObject_id", "managedObject_name",
        "granularityInterval", "window_start", "window_end", "days", "hours", "level", "setting",
        "aggregationFunction", F.coalesce("percentileValue", F.lit(0.0)).alias("percentileValue"),
    )
    on = (
        (facts["metricId"] == configs["kpi_id"])
        & (facts["managedObjectId"] == configs["managedObject_id"])
        & (facts["granularityInterval"] == configs["granularityInterval"])
        & (facts[TIME] >= configs["window_start"])
        & (facts[TIME] < configs["window_end"])
    )
    side = F.broadcast(configs) if known.broadcastable else configs
    joined = facts.join(side, on, "inner").drop(configs["granularityInterval"])
    return joined.where(
        on_days(F.col(TIME), F.col("days")) & in_hours(F.col(TIME), F.col("hours"))
    )


def scope_counts(metrics: DataFrame, scope: DataFrame) -> DataFrame:
    """Rows with a value per config and device."""
    return _in_scope(metrics, *known_scope(scope)).groupBy("node_id", "node_name", "additionalDn").agg(
        F.count("value").alias("conteo")
    )


def hourly_values(metrics: DataFrame, scope: DataFrame, known: ScopeFacts) -> DataFrame:
    """One row per config, element, category and hour with the configured aggregate."""
    rows = _in_scope(metrics, scope, known).withColumn("hour", floor_minutes(TIME, 60))
    keys = [
        "setting", "node_id", "kpi_id", "managedObject_id", "granularityInterval", "dn", "category", "hour",
    ]
    values = aggregate_by_name(
        rows, keys, "aggregationFunction", "percentileValue", "value", "metric",
        functions=known.functions,
    )
    # Ranks must not depend on the order in which doubles were added up.
    return values.withColumn("metric", F.round("metric", 9))


def busy_hours(
    metrics: DataFrame,
    cfg: DataFrame,
    run_ts: datetime,
    period: str,
    distinct_days: bool = False,
) -> DataFrame:
    """Top hours per config and element, at the levels (1 to 3) each config asks for.

    With ``distinct_days`` a weekly or monthly period ranks the best hour of every day, so
    no two levels share a day.
    """
    scope, known = known_scope(busy_hour_scope(cfg, run_ts, period))
    hours = hourly_values(metrics, scope, known)
    order = [F.desc("metric"), F.asc("hour"), F.asc_nulls_first("category")]
    if distinct_days and period != "DAILY_BUSY_HOUR":
        by_day = W.partitionBy("setting", "dn", day_start(F.col("hour"))).orderBy(*order)
        hours = hours.withColumn("rank_of_day", F.row_number().over(by_day)).where(
            F.col("rank_of_day") == 1
        )
    overall = W.partitionBy("setting", "dn").orderBy(*order)
    # The literal bound lets Spark drop lower ranks before the shuffle of the window.
    ranked = hours.withColumn("BH_level", F.row_number().over(overall)).where(
        F.col("BH_level") <= MAX_LEVEL
    )
    labels = scope.select(
        "setting", "node_name", "kpi_name", "managedObject_name", "level", "window_start", "window_end",
    )
    side = F.broadcast(labels) if known.broadcastable else labels
    named = ranked.join(side, "setting").where(
        F.array_contains("level", F.col("BH_level"))
    )
    return named.select(
        F.col("window_start").alias("data_date_start"),
        (F.col("window_end") - F.make_dt_interval(secs=F.lit(1))).alias("data_date_end"),
        F.weekofyear("window_start").alias("data_date_week"),
        F.month("window_start").alias("data_date_month"),
        F.col("node_id").alias("BH_configuration_id"),
        F.col("node_name").alias("BH_configuration_name"),
        F.lit(period.split("_")[0].lower()).alias("periodicity"),
        ts_lit(run_ts).alias("execution_date"),
        "dn",
        "kpi_id",
        "kpi_name",
        "category",
        F.col("managedObject_id").alias("MO_id"),
        F.col("managedObject_name").alias("MO_name"),
        "granularityInterval",
        F.col("hour").alias("BH_hour"),
        F.col("metric").alias("BH_value"),
        "BH_level",
    )

