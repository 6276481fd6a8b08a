"""Run intervals, recomputation, sink and stream queries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemeter.functions.timeutil import (
    bucket_series,
    busy_hour_period,
    minutes_interval,
    period_tag,
    previous_bucket,
    previous_period,
    zone_offset_minutes,
)
from wavemeter.model import ELEMENT_MESSAGE, TIME
from wavemeter.operators.busyhour import busy_hours
from wavemeter.operators.recompute import due_after, load_intervals, recompute
from wavemeter.operators.rollup import rollup_group, rollup_temporal
from wavemeter.plans import busyhours
from wavemeter.plans.fixtures import (
    EVENTS,
    METRICS_SQL,
    VALUED_SQL,
    Query,
    metric_view,
    metrics,
    pick,
    r6,
    table,
)
from wavemeter.plans.operations import ELEMENTS_CTE
from wavemeter.plans.rollups import group_sql, show_group
from wavemeter.session import work_folder
from wavemeter.sinks.messages import keyed_json, keyed_text
from wavemeter.sinks.tables import (
    append_control,
    compact,
    current_load_status,
    read_table,
    replace_interval,
    write_busy_hours,
)
from wavemeter.sources.landed import union_all
from wavemeter.streaming.elements import track_elements
from wavemeter.streaming.late import StreamedLevel, count_arrivals, late_ledger, rerun_late, roll_up
from wavemeter.streaming.jobs import (
    closed,
    drain,
    read_files,
    redirect,
    split_stream,
    stream_next_level,
    stream_rollup,
)

# ---------------------------------------------------------------- windows of a run

_RUN = "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 AS int), cast(o_custkey % 60 AS int), 0)"
_RUN_SQL = "o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + to_minutes(CAST(o_custkey % 60 AS INTEGER))"
_ZONES = pick("o_orderkey", ["Z", "-03:00,-02:00", "+00:00,+01:00", "+05:30,+06:00"])


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"{_RUN} AS run_ts", f"{_ZONES} AS zones",
        f"{pick('o_orderkey', ['PT5M', 'PT15M', 'PT30M', 'PT1H', 'P1D'])} AS period",
    )


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = F.col("run_ts")
    out = _runs(spark, sf_dir)
    columns = {}
    for grain in ("HOUR", "DAY", "WEEK", "MONTH", "FITTEEN_DAYS"):
        start, end = previous_period(run, grain)
        columns[f"{grain.lower()}_start"], columns[f"{grain.lower()}_end"] = start, end
    bh_start, _ = busy_hour_period(run, "WEEKLY_BUSY_HOUR")
    return out.select(
        "o_orderkey", "run_ts", *[c.alias(n) for n, c in columns.items()],
        F.weekofyear(bh_start).cast("long").alias("bh_week"),
        F.month(bh_start).cast("long").alias("bh_month"),
        zone_offset_minutes(F.col("zones")).alias("zone_minutes"),
        period_tag(F.col("period")).alias("tag"),
    )


WINDOWS_SQL = f"""WITH r AS (SELECT o_orderkey, {_RUN_SQL} AS run_ts FROM orders)
SELECT o_orderkey, run_ts,
    CAST(date_trunc('hour', run_ts) AS TIMESTAMP) - INTERVAL 1 HOUR AS hour_start,
    CAST(date_trunc('hour', run_ts) AS TIMESTAMP) AS hour_end,
    CAST(date_trunc('day', run_ts) AS TIMESTAMP) - INTERVAL 1 DAY AS day_start,
    CAST(date_trunc('day', run_ts) AS TIMESTAMP) AS day_end,
    CAST(date_trunc('week', run_ts) AS TIMESTAMP) - INTERVAL 7 DAY AS week_start,
    CAST(date_trunc('week', run_ts) AS TIMESTAMP) AS week_end,
    CAST(date_trunc('month', run_ts) AS TIMESTAMP) - INTERVAL 1 MONTH AS month_start,
    CAST(date_trunc('month', run_ts) AS TIMESTAMP) AS month_end,
    CASE WHEN day(run_ts) <= 15 THEN CAST(date_trunc('month', run_ts) AS TIMESTAMP) - INTERVAL 1 MONTH + INTERVAL 15 DAY
        ELSE CAST(date_trunc('month', run_ts) AS TIMESTAMP) END AS fitteen_days_start,
    CASE WHEN day(run_ts) <= 15 THEN CAST(date_trunc('month', run_ts) AS TIMESTAMP)
        ELSE CAST(date_trunc('month', run_ts) AS TIMESTAMP) + INTERVAL 15 DAY END AS fitteen_days_end,
    CAST(weekofyear(date_trunc('week', run_ts) - INTERVAL 7 DAY) AS BIGINT) AS bh_week,
    month(date_trunc('week', run_ts) - INTERVAL 7 DAY) AS bh_month,
    CASE o_orderkey % 4 WHEN 1 THEN -180 WHEN 3 THEN 330 ELSE 0 END AS zone_minutes,
    CASE o_orderkey % 5 WHEN 0 THEN 'PT300S' WHEN 1 THEN 'PT900S' WHEN 2 THEN 'PT1800S' WHEN 3 THEN 'PT3600S' END AS tag
FROM r"""

BUCKETS = ((5, 10), (5, 180), (15, 0), (30, 0), (60, 0))


def spatial_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = []
    for minutes, delay in BUCKETS:
        start, end = previous_bucket(F.col("run_ts"), minutes, delay)
        columns += [start.alias(f"start_{minutes}_{delay}"), end.alias(f"end_{minutes}_{delay}")]
    return _runs(spark, sf_dir).select("o_orderkey", *columns)


SPATIAL_WINDOWS_SQL = f"""WITH r AS (SELECT o_orderkey, {_RUN_SQL} AS t FROM orders)
SELECT o_orderkey, """ + ", ".join(
    f"""time_bucket(INTERVAL {m} MINUTE, t) - INTERVAL {m + d} MINUTE AS start_{m}_{d},
    time_bucket(INTERVAL {m} MINUTE, t) - INTERVAL {d} MINUTE AS end_{m}_{d}"""
    for m, d in BUCKETS
) + " FROM r"


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir).select("o_orderkey", "run_ts")
    parts = [
        load_intervals(runs, grain, "load", source_lag_hours=lag)
        .withColumn("grain", F.lit(grain))
        .withColumn("process", F.lit(f"load-{lag}"))
        for grain in ("15m", "30m", "hourly", "daily")
        for lag in (0, 3)
    ]
    parts.append(
        load_intervals(runs, "daily", "reprocess")
        .withColumn("grain", F.lit("daily"))
        .withColumn("process", F.lit("reprocess"))
    )
    return union_all(parts)


def _load_sql(grain: str, minutes: int, lag: int) -> str:
    if grain == "daily":
        end = f"CAST(date_trunc('day', run_ts - to_days(d) - INTERVAL {lag} HOUR) AS TIMESTAMP) + INTERVAL 3 HOUR"
    else:
        end = f"time_bucket(INTERVAL {minutes} MINUTE, run_ts - to_days(d) - INTERVAL {lag} HOUR)"
    return f"""SELECT o_orderkey, run_ts, d AS days_back, {end} - INTERVAL {minutes} MINUTE AS interval_start,
        {end} AS interval_end, '{grain}' AS grain, 'load-{lag}' AS process FROM r"""


INTERVALS_SQL = (
    f"WITH r AS (SELECT o_orderkey, {_RUN_SQL} AS run_ts, unnest([0, 1, 3]) AS d FROM orders) "
    + " UNION ALL ".join(
        _load_sql(g, m, lag)
        for g, m in (("15m", 15), ("30m", 30), ("hourly", 60), ("daily", 1440))
        for lag in (0, 3)
    )
    + """ UNION ALL SELECT o_orderkey, run_ts, 0, run_ts + INTERVAL 3 HOUR, run_ts + INTERVAL 27 HOUR,
        'daily', 'reprocess' FROM r WHERE d = 0"""
)


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = _runs(spark, sf_dir).select(
        "o_orderkey",
        F.col("run_ts").alias("start"),
        (F.col("run_ts") + minutes_interval((F.col("o_orderkey") % 200).cast("int"))).alias("end"),
    )
    return bucket_series(ranges, "start", "end", 30).select("o_orderkey", "bucket")


BACKFILL_SQL = f"""WITH r AS (SELECT o_orderkey, {_RUN_SQL} AS s FROM orders), x AS (
    SELECT o_orderkey, s + to_minutes(CAST(o_orderkey % 200 AS INTEGER)) AS e,
        unnest([s + to_minutes(30 * i) FOR i IN range(0, 7)]) AS bucket FROM r)
SELECT o_orderkey, bucket FROM x WHERE bucket < e"""

# ---------------------------------------------------------------- recomputation


def late_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs after hours with sign-ups recompute their bucket and those 1 and 3 days earlier."""
    facts = metrics(spark, sf_dir)
    runs = (
        facts.where(F.col("metricId") == "signup")
        .select((F.date_trunc("hour", TIME).cast("timestamp_ntz") + minutes_interval(60)).alias("run_ts"))
        .distinct()
    )
    due = load_intervals(runs, "hourly").select(F.col("interval_start").alias(TIME))
    # The hourly level reads the 15-minute level, rebuilt only inside the due hours.
    quarters = due.select(
        F.explode(
            F.sequence(F.col(TIME), F.col(TIME) + minutes_interval(45), minutes_interval(15))
        ).alias(TIME)
    )
    level1 = recompute(facts, quarters, "15m", sketch=False)
    return recompute(level1, due, "hourly", sketch=False).select(
        TIME, "dn", "metricId", "pollingRuleId", "count", r6("sum_value"), r6("max_value")
    )


LATE_SQL = f"""WITH {VALUED_SQL}, due AS (
    SELECT DISTINCT time_bucket(INTERVAL 1 HOUR, __time) - to_days(d) AS t
    FROM (SELECT __time, unnest([0, 1, 3]) AS d FROM m WHERE metricId = 'signup')
)
SELECT time_bucket(INTERVAL 1 HOUR, __time) AS __time, dn, metricId, pollingRuleId, count(*) AS count,
    round(sum(value), 6) AS sum_value, round(max(value), 6) AS max_value
FROM v WHERE reportInterval = 300 AND time_bucket(INTERVAL 1 HOUR, __time) IN (SELECT t FROM due)
GROUP BY time_bucket(INTERVAL 1 HOUR, __time), dn, metricId, pollingRuleId"""


def cascade_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours to build because their last quarter has been rolled up."""
    level1 = rollup_temporal(metrics(spark, sf_dir), "15m", sketch=False)
    return due_after(level1.select(TIME).distinct(), "15m", "hourly")


CASCADE_DUE_SQL = f"""WITH {VALUED_SQL}
SELECT DISTINCT time_bucket(INTERVAL 1 HOUR, __time) AS __time FROM v
WHERE reportInterval = 300 AND minute(__time) >= 45"""

# ---------------------------------------------------------------- sinks

CUT = datetime(2024, 1, 20)


def replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group roll-up written with damage, then one interval replaced twice."""
    path = work_folder(spark, "group-15m")
    facts = metrics(spark, sf_dir)
    rolled = rollup_group(facts, "15m", sketch=False)
    cluster = ("networkGroup", "metricId")
    start, end = datetime(2024, 1, 1), datetime(2024, 2, 1)
    lost = rolled.where(F.to_date(TIME) != F.lit("2024-01-20"))
    replace_interval(spark, lost, path, start, end, cluster, "day")
    day = rolled.where(F.to_date(TIME) == F.lit(CUT.date()))
    for _ in range(2):
        replace_interval(spark, day, path, CUT, CUT + timedelta(days=1), cluster, "day")
    return show_group(spark.read.parquet(path))


def busy_hour_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Busy hours staged by config, compacted into the lake and read back."""
    stage, lake = work_folder(spark, "bh-stage"), work_folder(spark, "bh-lake")
    cfg = busyhours.config(spark, sf_dir, "WEEKLY_BUSY_HOUR")
    out = busy_hours(metrics(spark, sf_dir), cfg, busyhours.WEEK_RUN, "WEEKLY_BUSY_HOUR")
    write_busy_hours(out, stage)
    write_busy_hours(out, stage)
    compact(spark, stage, lake, ("periodicity", "data_date", "BH_configuration_id"))
    back = spark.read.parquet(lake)
    return back.drop("data_date").withColumns(
        {"BH_value": F.round("BH_value", 6), "data_date_week": F.col("data_date_week").cast("long")}
    )


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load attempts appended in two runs, with the status of the last one."""
    path = work_folder(spark, "control")
    attempts = table(spark, sf_dir, "orders").selectExpr(
        "concat('th-', o_custkey) AS threshold_id", "concat('k-', o_orderkey % 5) AS kpi_id",
        "o_orderkey AS records", "CASE WHEN o_orderstatus = 'F' THEN 'PARTIAL' ELSE 'LOAD' END AS status",
        "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey) AS load_datatime",
    )
    half = F.col("records") % 2 == 0
    append_control(attempts.where(half), path)
    append_control(attempts.where(~half), path)
    return current_load_status(spark.read.parquet(path))


CONTROL_SQL = """WITH a AS (SELECT 'th-' || o_custkey AS threshold_id, 'k-' || (o_orderkey % 5) AS kpi_id,
    o_orderkey AS records, CASE WHEN o_orderstatus = 'F' THEN 'PARTIAL' ELSE 'LOAD' END AS status,
    o_orderdate + to_seconds(o_orderkey) AS load_datatime FROM orders)
SELECT threshold_id, kpi_id, arg_max(records, load_datatime) AS records,
    arg_max(status, load_datatime) AS status, max(load_datatime) AS load_datatime
FROM a GROUP BY threshold_id, kpi_id"""


def lookup_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    devices = metrics(spark, sf_dir).select("additionalDn", "managerIp").distinct()
    return keyed_text(devices, "additionalDn", "managerIp")


LOOKUP_SQL = f"""WITH {METRICS_SQL} SELECT DISTINCT "additionalDn" AS key, "managerIp" AS value FROM m"""


def row_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return keyed_json(rows, F.col("c_custkey")).unionByName(
        keyed_json(rows, "constant")
    )


ROW_MESSAGES_SQL = """WITH v AS (SELECT *, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name ||
    '","c_nationkey":' || c_nationkey || '}' AS value FROM customer)
SELECT CAST(c_custkey AS VARCHAR) AS key, value FROM v
UNION ALL SELECT 'constant', value FROM v"""

# ---------------------------------------------------------------- streams

STREAM_KEYS = ("metricId", "additionalDn", "isRate")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern serves a table kept as one file as well as one kept as a folder of files.
    return read_files(spark, f"{sf_dir}/events.parquet*", EVENTS)


def streamed(levels: tuple[str, ...], delay: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = work_folder(spark, "stream-rollup")
        first, *later = levels
        out = stream_rollup(metric_view(_event_stream(spark, sf_dir)), first, STREAM_KEYS, delay)
        for grain in later:
            out = stream_next_level(out, grain, STREAM_KEYS)
        drain(closed(out), f"{folder}/out", f"{folder}/checkpoint")
        return spark.read.parquet(f"{folder}/out").select(
            TIME, *STREAM_KEYS, "count", r6("sum_value"), r6("max_value"), r6("min_value")
        )

    return run


def _stream_sql(minutes: int, limit: str) -> str:
    return f"""WITH {VALUED_SQL}
SELECT time_bucket(INTERVAL {minutes} MINUTE, __time) AS __time, metricId, "additionalDn", "isRate",
    count(*) AS count, round(sum(value), 6) AS sum_value, round(max(value), 6) AS max_value,
    round(min(value), 6) AS min_value
FROM v WHERE reportInterval = 300 AND time_bucket(INTERVAL {minutes} MINUTE, __time) + INTERVAL {minutes} MINUTE
    <= (SELECT date_trunc('millisecond', max(__time)) - {limit} FROM v WHERE reportInterval = 300)
GROUP BY ALL"""


# Every seventh event lands after all others, up to a month late.
LATE_EVENT = "event_id % 7 = 3"


def _late_job(spark: SparkSession, sf_dir: str):
    """A level streamed in two waves, the second of which is late, and its ledger."""
    folder = work_folder(spark, "stream-late")
    job = StreamedLevel(folder, "15m", STREAM_KEYS, "1 hour", "day")
    events = table(spark, sf_dir, "events")
    for wave in (f"NOT ({LATE_EVENT})", LATE_EVENT):
        events.where(wave).write.mode("append").parquet(f"{folder}/landed")
        facts = metric_view(read_files(spark, f"{folder}/landed", EVENTS))
        count_arrivals(facts, job)
        watermark = roll_up(spark, facts, job)
    return job, late_ledger(spark, job, watermark), metric_view(events)


def late_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets with rows that came behind the watermark."""
    return _late_job(spark, sf_dir)[1]


def late_made_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The level after the listed buckets were rebuilt; nothing is late any more."""
    job, ledger, facts = _late_job(spark, sf_dir)
    rerun_late(spark, facts, job, ledger)
    return spark.read.parquet(job.level).select(
        TIME, *STREAM_KEYS, "count", r6("sum_value"), r6("max_value"), r6("min_value")
    )


LATE_LEDGER_SQL = f"""WITH {VALUED_SQL}, e AS (
    SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS b, {LATE_EVENT} AS second_wave, ts
    FROM events WHERE event_id % 8 <> 7 AND (CASE WHEN user_id % 2 = 0
        AND (CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 4 END) <> 0
        THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) / (event_id % 4)
        WHEN event_id % 50 = 0 THEN NULL ELSE value END) IS NOT NULL
), w AS (
    SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR AS last_mark,
        date_trunc('millisecond', max(ts) FILTER (NOT second_wave)) - INTERVAL 1 HOUR AS first_mark FROM e
), x AS (
    SELECT b AS __time, count(*) AS arrived,
        count(*) FILTER (second_wave AND b + INTERVAL 15 MINUTE <= first_mark) AS late
    FROM e, w WHERE b + INTERVAL 15 MINUTE <= last_mark GROUP BY b
)
SELECT __time, arrived, arrived - late AS rolled, late FROM x WHERE late > 0"""


def stream_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "stream-elements")
    messages = _event_stream(spark, sf_dir).selectExpr(
        "ts AS __time", "event_id", "concat('dn-', user_id) AS dn",
        "concat('dev-', event_id % 10) AS additionalDn", "concat('sys-', event_type) AS sourceSystem",
        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('vn-', event_id % 3) END AS vendorName",
        "CASE WHEN event_id % 17 = 0 THEN NULL ELSE concat('192.0.2.', event_id % 8) END AS managerIp",
        "'CELL' AS elementType",
    )
    track_elements(spark, messages, f"{folder}/elements", f"{folder}/checkpoint", order=(TIME, "event_id"))
    return read_table(spark, f"{folder}/elements")


# An element ends when its last message is a day older than the latest of all.
STREAM_ELEMENTS_SQL = ELEMENTS_CTE + """ SELECT *, date_trunc('millisecond', created_at)
    >= date_trunc('millisecond', max(created_at) OVER ()) - INTERVAL 1 DAY AS ativo FROM s"""


def _raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_stream(spark, sf_dir).selectExpr(
        "event_id",
        """CASE WHEN event_id % 9 = 0 THEN concat('{"dn": ', event_id, ' oops') ELSE
            to_json(named_struct('dn', concat('dn-', user_id), 'vendorName', event_type)) END AS value""",
    )


def stream_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "stream-errors")
    split_stream(
        _raw_messages(spark, sf_dir), ELEMENT_MESSAGE, "collector-1", f"{folder}/good",
        f"{folder}/bad", f"{folder}/checkpoint",
    )
    good = spark.read.parquet(f"{folder}/good").select("event_id", "dn", "vendorName")
    bad = spark.read.parquet(f"{folder}/bad")
    return good.select(
        F.col("dn").alias("key"), F.col("vendorName").alias("value")
    ).unionByName(bad.select("key", F.get_json_object("value", "$.data").alias("value")))


STREAM_ERRORS_SQL = """SELECT CASE WHEN event_id % 9 = 0 THEN 'collector-1' ELSE 'dn-' || user_id END AS key,
    CASE WHEN event_id % 9 = 0 THEN '{"dn": ' || event_id || ' oops' ELSE event_type END AS value FROM events"""


def stream_redirect(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "stream-redirect")
    drain(
        redirect(_raw_messages(spark, sf_dir), "redirected"), f"{folder}/out", f"{folder}/checkpoint"
    )
    return spark.read.parquet(f"{folder}/out")


REDIRECT_SQL = """SELECT 'redirected' AS key, CASE WHEN event_id % 9 = 0 THEN '{"dn": ' || event_id || ' oops'
    ELSE '{"dn":"dn-' || user_id || '","vendorName":"' || event_type || '"}' END AS value FROM events"""

QUERIES = {
    "period_windows": Query(windows, WINDOWS_SQL),
    "spatial_bucket_windows": Query(spatial_windows, SPATIAL_WINDOWS_SQL),
    "rollup_intervals": Query(intervals, INTERVALS_SQL),
    "backfill_intervals": Query(backfill, BACKFILL_SQL),
    "late_rerun": Query(late_rerun, LATE_SQL),
    "cascade_due": Query(cascade_due, CASCADE_DUE_SQL),
    "sink_replace_interval": Query(replaced, group_sql(15, 300)),
    "sink_busy_hour_files": Query(
        busy_hour_files, busyhours.hours_sql("WEEKLY_BUSY_HOUR", busyhours.WEEK_RUN)
    ),
    "load_control_status": Query(control, CONTROL_SQL),
    "lookup_messages": Query(lookup_messages, LOOKUP_SQL),
    "row_messages": Query(row_messages, ROW_MESSAGES_SQL),
    "stream_rollup_15m": Query(streamed(("15m",), "1 hour"), _stream_sql(15, "INTERVAL 1 HOUR")),
    "stream_rollup_late_2h": Query(streamed(("15m",), "2 hours"), _stream_sql(15, "INTERVAL 2 HOUR")),
    "stream_cascade_hourly": Query(
        streamed(("15m", "hourly"), "1 hour"), _stream_sql(60, "INTERVAL 1 HOUR")
    ),
    "stream_late_ledger": Query(late_listed, LATE_LEDGER_SQL),
    "stream_late_rerun_15m": Query(late_made_good, _stream_sql(15, "INTERVAL 1 HOUR")),
    "stream_element_status": Query(stream_elements, STREAM_ELEMENTS_SQL),
    "stream_dead_letters": Query(stream_errors, STREAM_ERRORS_SQL),
    "stream_redirect": Query(stream_redirect, REDIRECT_SQL),
}
