"""Counter queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemeter.model import TIME
from wavemeter.operators.counters import (
    KEYS,
    TEMPLATES,
    base_samples,
    complete_buckets,
    counter_agg,
    counter_incremental,
    counter_multilevel,
    high_water_mark,
)
from wavemeter.operators.incremental import advance_mark, publish_run, published, read_mark, run_incremental
from wavemeter.plans.fixtures import COUNTERS_SQL, Query, counters, r6, table
from wavemeter.session import work_folder

COLUMNS = (
    TIME, "beginTime", "endTime", *KEYS, "name", "code", "reportInterval", "granularityInterval",
    "managerFilename",
)
MARK = datetime(2024, 1, 10, 7, 2, 30)
NOW = datetime(2024, 1, 20, 13, 7, 45)


def template(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = base_samples(counters(spark, sf_dir), 1, "SYS-C")
        return counter_agg(rows, TEMPLATES[name]).select(*COLUMNS, r6("value"))

    return run


def template_sql(name: str, where: str = "true") -> str:
    specs = TEMPLATES[name]
    keys = ", ".join(f'"{k}"' for k in KEYS)
    parts = []
    for s in specs:
        inner = f"""SELECT time_bucket(INTERVAL {s.minutes} MINUTE, __time) AS __time, {keys}, name, code,
            {s.function}(value) AS value, list("managerFilename") AS files
        FROM c WHERE {where} GROUP BY time_bucket(INTERVAL {s.minutes} MINUTE, __time), {keys}, name, code"""
        tail = f"{s.tag}_{s.function}"
        minutes = s.minutes
        if s.outer_minutes:
            minutes = s.outer_minutes
            inner = f"""SELECT time_bucket(INTERVAL {minutes} MINUTE, __time) AS __time, {keys}, name, code,
                {s.outer_function}(value) AS value, flatten(list(files)) AS files
            FROM ({inner}) GROUP BY time_bucket(INTERVAL {minutes} MINUTE, __time), {keys}, name, code"""
            tail += f"_{s.outer_function}"
        parts.append(f"""SELECT __time, epoch_ms(__time) AS "beginTime",
            epoch_ms(__time + INTERVAL {minutes} MINUTE) AS "endTime", {keys},
            name || '{tail}' AS name, code || '{tail}' AS code, {minutes * 60} AS "reportInterval",
            'PT{minutes * 60}S' AS "granularityInterval",
            array_to_string(list_sort(list_distinct(files)), ',') AS "managerFilename",
            round(CAST(value AS DOUBLE), 6) AS value
        FROM ({inner})""")
    return f"WITH {COUNTERS_SQL} " + " UNION ALL ".join(parts)


def multilevel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counter_multilevel(base_samples(counters(spark, sf_dir), 1, "SYS-C")).select(
        TIME, "device", r6("max"), r6("maxAvg"), r6("sum"), "count", r6("avg"),
        "aggregation_interval",
    )


MULTILEVEL_SQL = f"""WITH {COUNTERS_SQL}, a AS (
    SELECT time_bucket(INTERVAL 1 MINUTE, __time) AS t, "additionalDn" AS device, max(value) AS mx,
        sum(value) AS s, count(value) AS n, sum(value) / nullif(count(value), 0) AS av
    FROM c GROUP BY ALL
), b AS (
    SELECT time_bucket(INTERVAL 5 MINUTE, t) AS t, device, max(mx) AS mx, max(av) AS av, sum(s) AS s,
        sum(n) AS n FROM a GROUP BY ALL
)
SELECT time_bucket(INTERVAL 15 MINUTE, t) AS __time, device, round(max(mx), 6) AS max,
    round(max(av), 6) AS "maxAvg", round(sum(s), 6) AS sum, CAST(sum(n) AS BIGINT) AS count,
    round(sum(s) / nullif(sum(n), 0), 6) AS avg, '15_minute' AS aggregation_interval
FROM b GROUP BY ALL"""


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base_samples(counters(spark, sf_dir), 1, "SYS-C")
    return counter_incremental(rows, TEMPLATES["second_to_15_minute"], MARK, NOW).select(
        *COLUMNS, r6("value")
    )


def _incremental_sql() -> str:
    start, end = complete_buckets(MARK, NOW, 15)
    assert (start, end) == (datetime(2024, 1, 10, 7, 15), datetime(2024, 1, 20, 13, 0))
    return template_sql(
        "second_to_15_minute",
        "__time >= TIMESTAMP '2024-01-10 07:15:00' AND __time < TIMESTAMP '2024-01-20 13:00:00'",
    )


# A run that dies after publishing stands between two that end well.
RUN_TIMES = (datetime(2024, 1, 12, 3, 20), datetime(2024, 1, 16, 0, 10), NOW)
DEAD_RUN = datetime(2024, 1, 15, 11, 1)
JOB = "second_to_15_minute"


def _stored_runs(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    rows = base_samples(counters(spark, sf_dir), 1, "SYS-C")
    specs, folder = TEMPLATES[JOB], work_folder(spark, "incremental")
    out, marks = f"{folder}/out", f"{folder}/marks"
    advance_mark(spark, marks, JOB, MARK, MARK)
    run_incremental(spark, rows, specs, out, marks, JOB, RUN_TIMES[0])
    publish_run(spark, rows, specs, out, read_mark(spark, marks, JOB), DEAD_RUN)
    for now in RUN_TIMES[1:]:
        run_incremental(spark, rows, specs, out, marks, JOB, now)
    return out, marks


def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that several runs published, one of them twice."""
    out, _ = _stored_runs(spark, sf_dir)
    return published(spark, out).select(*COLUMNS, r6("value"))


def stored_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark that these runs left, as it is stored."""
    _, marks = _stored_runs(spark, sf_dir)
    return spark.read.parquet(marks).select(F.col("job").cast("string").alias("job"), "mark", "run_ts")


STORED_MARK_SQL = f"""WITH {COUNTERS_SQL}
SELECT '{JOB}' AS job, strftime(max(time_bucket(INTERVAL 15 MINUTE, __time)) + INTERVAL 15 MINUTE,
    '%Y-%m-%dT%H:%M:%SZ') AS mark, TIMESTAMP '{NOW}' AS run_ts
FROM c WHERE __time >= TIMESTAMP '2024-01-10 07:15:00' AND __time < TIMESTAMP '2024-01-20 13:00:00'"""


def mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest time among texts in several layouts, epoch milliseconds and unreadable ones."""
    text = (
        F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(F.col("event_id") % 4 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_id") % 8 == 3, F.date_format("ts", "dd-MM-yyyy HH:mm:ss"))
        .when(F.col("event_id") % 4 == 2, F.unix_millis(F.col("ts").cast("timestamp")).cast("string"))
        .otherwise(F.lit("n/a"))
    )
    landed = table(spark, sf_dir, "events").select(F.struct(text.alias("stamp")).alias("source"))
    return high_water_mark(landed, "source.stamp", ("dd-MM-yyyy HH:mm:ss",))


MARK_SQL = """SELECT max(CASE WHEN event_id % 4 = 0 THEN ts
    WHEN event_id % 4 = 1 OR event_id % 8 = 3 THEN date_trunc('second', ts)
    WHEN event_id % 4 = 2 THEN date_trunc('millisecond', ts) END) AS high_water_mark FROM events"""

QUERIES = {
    "counter_agg_1m": Query(template("second_to_1_minute"), template_sql("second_to_1_minute")),
    "counter_agg_5m": Query(template("second_to_5_minute"), template_sql("second_to_5_minute")),
    "counter_agg_15m": Query(template("second_to_15_minute"), template_sql("second_to_15_minute")),
    "counter_avg_then_max_5m": Query(
        template("1_minute_to_5_minute_max_avg"), template_sql("1_minute_to_5_minute_max_avg")
    ),
    "counter_avg_then_max_15m": Query(
        template("5_minute_to_15_minute_avg_max"), template_sql("5_minute_to_15_minute_avg_max")
    ),
    "counter_multilevel_15m": Query(multilevel, MULTILEVEL_SQL),
    "counter_incremental_15m": Query(incremental, _incremental_sql()),
    "counter_incremental_runs": Query(incremental_runs, _incremental_sql()),
    "counter_mark_stored": Query(stored_mark, STORED_MARK_SQL),
    "high_water_mark": Query(mark, MARK_SQL),
}
