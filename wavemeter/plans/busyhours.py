"""Busy-hour queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemeter.functions.timeutil import previous_period_bounds
from wavemeter.operators.busyhour import PERIODS, busy_hour_scope, busy_hours, scope_counts
from wavemeter.plans.fixtures import (
    EVENT_TYPES,
    METRICS_SQL,
    Query,
    derive,
    derive_sql,
    metrics,
    pick,
    r6,
)

K = "n_nationkey"
CONFIG = {
    "node_id": f"concat('bh-', {K})",
    "node_name": "concat('Busy hour ', n_name)",
    "kpi_id": pick(K, EVENT_TYPES),
    "kpi_name": f"concat('KPI ', {K} % 5)",
    "managedObject_id": f"concat('mo-', {K} % 3)",
    "managedObject_name": f"concat('Object ', {K} % 3)",
    "dataTableName": f"CASE WHEN {K} = 24 THEN '' ELSE 'metrics' END",
    "defaultTimeGranularity": f"CASE WHEN {K} % 7 = 6 THEN 'PT15M' ELSE 'PT5M' END",
    "aggregationFunction": pick(K, ["SUM", "AVG", "MAX", "PERCENTILE", "MIN", "COUNT"]),
    "percentileValue": f"CASE WHEN {K} % 2 = 0 THEN 50.0 ELSE 90.0 END",
    "levels": pick(K, ["1,2,3", "1", "1,3", "2"]),
    "effectiveDay": pick(
        K, ["PERIODDAYS", "SPECIFICDAYS", "SPECIALDATES", "PERIODDAYS", "PERIODDAYS"]
    ),
    "day1_list": pick(f"{K} % 5", ["WEEKEND", "X", "X", "WORKDAYS", "ALLDAYS"]),
    "day2_list": f"CASE WHEN {K} % 5 = 1 THEN 'MONDAY,FRIDAY' ELSE 'SUNDAY' END",
    "hours_list": pick(K, ["ALL", "_08_00,_09_00,_10_00,_18_00", "ALL"]),
    "date": "'2024-01-13T00:00:00+0000'",
}


def config(spark: SparkSession, sf_dir: str, period: str) -> DataFrame:
    flat = derive(spark, sf_dir, "nation", CONFIG)
    return flat.select(
        "*",
        F.lit(period).alias("period"),
        F.split("levels", ",").cast("array<int>").alias("level"),
        F.split("day1_list", ",").alias("day1"),
        F.split("day2_list", ",").alias("day2"),
        F.split("hours_list", ",").alias("effective_hours"),
    ).withColumn("percentileValue", F.col("percentileValue").cast("double"))


def hours(period: str, run_ts: datetime, distinct_days: bool = False, where: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = config(spark, sf_dir, period)
        if where:
            cfg = cfg.where(where)
        out = busy_hours(metrics(spark, sf_dir), cfg, run_ts, period, distinct_days)
        return out.withColumn("BH_value", F.round("BH_value", 6)).withColumn(
            "data_date_week", F.col("data_date_week").cast("long")
        )

    return run


def _stamp(t: datetime) -> str:
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def _hourly_sql(period: str, run_ts: datetime, where: str | None) -> str:
    start, end = previous_period_bounds(run_ts, PERIODS[period])
    day_match = """(CASE WHEN c."effectiveDay" = 'PERIODDAYS' AND day1_list = 'WEEKEND' THEN isodow({t}) IN (6, 7)
        WHEN c."effectiveDay" = 'PERIODDAYS' AND day1_list = 'WORKDAYS' THEN isodow({t}) <= 5
        WHEN c."effectiveDay" = 'SPECIFICDAYS' AND day2_list = 'MONDAY,FRIDAY' THEN isodow({t}) IN (1, 5)
        WHEN c."effectiveDay" = 'SPECIFICDAYS' THEN isodow({t}) = 7
        ELSE true END)"""
    daily = ""
    if period == "DAILY_BUSY_HOUR":
        daily = " AND " + day_match.format(t="c.ws")
    return f"""WITH {METRICS_SQL}, cfg AS ({derive_sql('nation', CONFIG)}), scope AS (
    SELECT *, CASE WHEN "effectiveDay" = 'SPECIALDATES' THEN TIMESTAMP '2024-01-13 00:00:00' ELSE {_stamp(start)} END AS ws,
        CASE WHEN "effectiveDay" = 'SPECIALDATES' THEN TIMESTAMP '2024-01-14 00:00:00' ELSE {_stamp(end)} END AS we,
        CASE WHEN "defaultTimeGranularity" = 'PT5M' THEN 'PT300S' ELSE 'PT900S' END AS gi
    FROM cfg WHERE "dataTableName" <> ''{f' AND ({where})' if where else ''}
), j AS (
    SELECT c.*, __time, dn, "additionalDn", category, value FROM m JOIN scope c
    ON m."metricId" = c.kpi_id AND m."managedObjectId" = c."managedObject_id"
        AND m."granularityInterval" = c.gi AND __time >= ws AND __time < we
    WHERE value IS NOT NULL AND {day_match.format(t="__time")}
        AND (hours_list = 'ALL' OR hour(__time) IN (8, 9, 10, 18)){daily}
)"""


def hours_sql(
    period: str, run_ts: datetime, distinct_days: bool = False, where: str | None = None
) -> str:
    pick_day = ""
    source = "h"
    if distinct_days:
        pick_day = """, d AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY node_id, dn, CAST(hour AS DATE)
        ORDER BY metric DESC, hour, category NULLS FIRST) AS rd FROM h) WHERE rd = 1)"""
        source = "d"
    return f"""{_hourly_sql(period, run_ts, where)}, h AS (
    SELECT node_id, node_name, kpi_id, kpi_name, "managedObject_id", "managedObject_name", gi, levels, ws, we,
        dn, category, time_bucket(INTERVAL 60 MINUTE, __time) AS hour,
        round(CASE "aggregationFunction" WHEN 'SUM' THEN sum(value) WHEN 'AVG' THEN avg(value)
            WHEN 'MAX' THEN max(value) WHEN 'MIN' THEN min(value) WHEN 'COUNT' THEN count(value)
            ELSE CASE WHEN "percentileValue" = 50 THEN quantile_cont(value, 0.5)
                 ELSE quantile_cont(value, 0.9) END END, 9) AS metric
    FROM j GROUP BY node_id, node_name, kpi_id, kpi_name, "managedObject_id", "managedObject_name",
        gi, levels, ws, we, dn, category, time_bucket(INTERVAL 60 MINUTE, __time),
        "aggregationFunction", "percentileValue"
){pick_day}, r AS (
    SELECT *, row_number() OVER (PARTITION BY node_id, dn
        ORDER BY metric DESC, hour, category NULLS FIRST) AS lvl FROM {source}
)
SELECT ws AS data_date_start, we - INTERVAL 1 SECOND AS data_date_end,
    CAST(weekofyear(ws) AS BIGINT) AS data_date_week, month(ws) AS data_date_month,
    node_id AS "BH_configuration_id", node_name AS "BH_configuration_name",
    '{period.split('_')[0].lower()}' AS periodicity, {_stamp(run_ts)} AS execution_date,
    dn, kpi_id, kpi_name, category, "managedObject_id" AS "MO_id", "managedObject_name" AS "MO_name",
    gi AS "granularityInterval", hour AS "BH_hour", round(metric, 6) AS "BH_value", lvl AS "BH_level"
FROM r WHERE lvl <= 3 AND list_contains(string_split(levels, ','), CAST(lvl AS VARCHAR))"""


def device_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = busy_hour_scope(config(spark, sf_dir, "WEEKLY_BUSY_HOUR"), WEEK_RUN, "WEEKLY_BUSY_HOUR")
    return scope_counts(metrics(spark, sf_dir), scope).orderBy(F.desc("conteo"))


DAY_RUN = datetime(2024, 1, 16, 4, 10)
WEEK_RUN = datetime(2024, 1, 22, 4, 10)
MONTH_RUN = datetime(2024, 2, 1, 4, 10)
PERCENTILES = "aggregationFunction = 'PERCENTILE'"
PERCENTILES_SQL = "\"aggregationFunction\" = 'PERCENTILE'"
WORKDAY_CONFIGS = "day1_list = 'WORKDAYS'"


def _pair(period, run_ts, distinct_days=False, where=None, where_sql=None) -> Query:
    return Query(
        hours(period, run_ts, distinct_days, where),
        hours_sql(period, run_ts, distinct_days, where_sql or where),
    )


QUERIES = {
    "busy_hour_daily": _pair("DAILY_BUSY_HOUR", DAY_RUN),
    "busy_hour_weekly": _pair("WEEKLY_BUSY_HOUR", WEEK_RUN),
    "busy_hour_monthly_distinct_day": _pair("MONTHLY_BUSY_HOUR", MONTH_RUN, True),
    "busy_hour_percentile": _pair(
        "MONTHLY_BUSY_HOUR", MONTH_RUN, False, PERCENTILES, PERCENTILES_SQL
    ),
    "busy_hour_workdays": _pair("MONTHLY_BUSY_HOUR", MONTH_RUN, False, WORKDAY_CONFIGS),
    "busy_hour_scope_counts": Query(
        device_counts,
        _hourly_sql("WEEKLY_BUSY_HOUR", WEEK_RUN, None)
        + ' SELECT node_id, node_name, "additionalDn", count(value) AS conteo FROM j GROUP BY ALL',
    ),
}
