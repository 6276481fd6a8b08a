"""Queries over stored roll-up levels."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemeter.functions.timeutil import business_day
from wavemeter.model import TIME
from wavemeter.operators.busyhour import busy_hours
from wavemeter.operators.quality import reconcile_content
from wavemeter.operators.recompute import LATE_DAYS
from wavemeter.operators.rollup import rollup_temporal
from wavemeter.operators.stored import cascade, repair_stored, roll_stored, store_level
from wavemeter.plans.busyhours import WEEK_RUN, config, hours_sql
from wavemeter.plans.fixtures import VALUED_SQL, Query, metrics
from wavemeter.plans.rollups import group_sql, show_group, show_temporal, temporal_sql
from wavemeter.session import work_folder
from wavemeter.sources.landed import PARTITION

DAY = timedelta(days=1)
LATE_RUN = datetime(2024, 1, 20)
LATE_SOURCES = ("f-3", "f-13")


def _paths(spark: SparkSession, purpose: str) -> dict[str, str]:
    folder = work_folder(spark, purpose)
    return {grain: f"{folder}/{grain}" for grain in ("15m", "hourly", "daily")}


def _days(facts: DataFrame) -> list[datetime]:
    """All business days from the first fact to the last."""
    first, last = facts.agg(F.min(business_day(F.col(TIME))), F.max(business_day(F.col(TIME)))).first()
    return [first + n * DAY for n in range((last - first).days + 1)]


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PARTITION)


def stored(grain: str):
    """Levels written one after another, each from the stored one below, and once more."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        facts, paths = metrics(spark, sf_dir), _paths(spark, "stored")
        days = _days(facts)
        cascade(spark, facts, paths, days)
        cascade(spark, facts, paths, days[:1])
        return show_temporal(_read(spark, paths[grain]))

    return run


def stored_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, paths = metrics(spark, sf_dir), _paths(spark, "stored-group")
    days = _days(facts)
    # Hours before 03:00 belong to the business day before, so the range is moved likewise.
    start, end = days[0] + timedelta(hours=3), days[-1] + DAY + timedelta(hours=3)
    store_level(spark, facts, paths["15m"], "15m", start, end, groups=True)
    roll_stored(spark, paths["15m"], "15m", paths["hourly"], "hourly", start, end, groups=True)
    return show_group(_read(spark, paths["hourly"]))


# Days of which the level first missed a source, or held another value or element; equal counts on two of them.
LOST_DAYS, CHANGED_DAY, SWAPPED_DAY = (9, 21), 13, 17


def _damaged(facts: DataFrame) -> DataFrame:
    day, source = F.dayofmonth(business_day(F.col(TIME))), F.col("managerFilename").isin(*LATE_SOURCES)
    return facts.where(~(day.isin(*LOST_DAYS) & source)).withColumns(
        {
            "value": F.when((day == CHANGED_DAY) & source, F.col("value") + 1).otherwise(F.col("value")),
            "dn": F.when((day == SWAPPED_DAY) & source, F.lit("dn-other")).otherwise(F.col("dn")),
        }
    )


def repaired_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels built from damaged facts, found out and rebuilt up to the day."""
    facts, paths = metrics(spark, sf_dir), _paths(spark, "stored-repair")
    days = _days(facts)
    cascade(spark, _damaged(facts), paths, days)
    start = timedelta(hours=3)
    repair_stored(spark, facts, paths, days[0] + start, days[-1] + DAY + start)
    return show_temporal(_read(spark, paths["daily"]))


def reconciled_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets of a damaged level and what is wrong with each."""
    facts = metrics(spark, sf_dir)
    return reconcile_content(facts, rollup_temporal(_damaged(facts), "15m", sketch=False), "15m")


_SOURCES = ", ".join(f"'{s}'" for s in LATE_SOURCES)
RECONCILED_CONTENT_SQL = f"""WITH {VALUED_SQL}, r AS (
    SELECT time_bucket(INTERVAL 15 MINUTE, __time) AS t, count(*) AS n,
        bool_or(hit AND d IN {LOST_DAYS}) AS lost, count(*) FILTER (NOT (hit AND d IN {LOST_DAYS})) AS kept,
        bool_or(hit AND d = {SWAPPED_DAY}) AS swapped,
        bool_or(hit AND d = {CHANGED_DAY} AND NOT coalesce("isRate" AND denominator <> 0, false)) AS changed
    FROM (SELECT *, managerFilename IN ({_SOURCES}) AS hit, day(__time - INTERVAL 3 HOUR) AS d FROM v
        WHERE reportInterval = 300) GROUP BY 1
)
SELECT t AS __time, n AS raw_count, kept AS rolled_count,
    CASE WHEN n <> kept THEN 'rows' WHEN swapped THEN 'identity' ELSE 'measures' END AS what
FROM r WHERE n <> kept OR swapped OR changed"""


def late_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run repeats its day and those late sources usually fill; other days stay as stored."""
    facts, paths = metrics(spark, sf_dir), _paths(spark, "stored-late")
    prompt = ~F.col("managerFilename").isin(*LATE_SOURCES)
    cascade(spark, facts.where(prompt), paths, _days(facts))
    cascade(spark, facts, paths, [LATE_RUN - days * DAY for days in LATE_DAYS])
    return show_temporal(_read(spark, paths["daily"]))


_RERUN = ", ".join(f"DATE '{LATE_RUN - d * DAY:%Y-%m-%d}'" for d in LATE_DAYS)
_NAMES = ", ".join(f"'{s}'" for s in LATE_SOURCES)
LATE_STORED_SQL = temporal_sql(1440, 300).replace(
    "FROM v WHERE",
    f"FROM v WHERE (managerFilename NOT IN ({_NAMES}) OR CAST(__time - INTERVAL 3 HOUR AS DATE) IN ({_RERUN})) AND",
)


def two_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every weekly setting twice for one node and KPI, the second by its own function."""
    cfg = config(spark, sf_dir, "WEEKLY_BUSY_HOUR")
    second = cfg.withColumns(
        {"node_name": F.concat("node_name", F.lit("-max")), "aggregationFunction": F.lit("MAX")}
    )
    out = busy_hours(metrics(spark, sf_dir), cfg.unionByName(second), WEEK_RUN, "WEEKLY_BUSY_HOUR")
    return out.withColumn("BH_value", F.round("BH_value", 6)).withColumn(
        "data_date_week", F.col("data_date_week").cast("long")
    )


TWO_SETTINGS_SQL = (
    hours_sql("WEEKLY_BUSY_HOUR", WEEK_RUN)
    .replace("FROM cfg WHERE", "FROM both_cfg WHERE")
    .replace(
        ", scope AS (",
        """, both_cfg AS (SELECT * FROM cfg UNION ALL BY NAME
    SELECT * REPLACE (node_name || '-max' AS node_name, 'MAX' AS "aggregationFunction") FROM cfg), scope AS (""",
    )
    .replace("PARTITION BY node_id, dn", "PARTITION BY node_id, node_name, dn")
)

QUERIES = {
    "rollup_stored_hourly": Query(stored("hourly"), temporal_sql(60, 300)),
    "rollup_stored_daily": Query(stored("daily"), temporal_sql(1440, 300)),
    "rollup_stored_group_hourly": Query(stored_group, group_sql(60, 300)),
    "rollup_reconcile_content": Query(reconciled_content, RECONCILED_CONTENT_SQL),
    "rollup_repair_daily": Query(repaired_daily, temporal_sql(1440, 300)),
    "late_rerun_stored": Query(late_stored, LATE_STORED_SQL),
    "busy_hour_two_settings": Query(two_settings, TWO_SETTINGS_SQL),
}
