"""Roll-up queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemeter.functions.quantiles import merge_sketches, sketch_quantile
from wavemeter.model import DIMENSIONS, GROUP_DIMENSIONS, MEASURES, TIME
from wavemeter.operators.rollup import raw_rows, rollup_group, rollup_temporal
from wavemeter.plans.fixtures import VALUED_SQL, Query, joined_groups, metrics, r6

_PARTIALS = [f"{f}_{m}" for m in MEASURES for f in ("sum", "max", "min")]
_COUNTS = ["max_count_dn", "min_count_dn", "max_count_additionalDn", "min_count_additionalDn"]


def show_temporal(df: DataFrame) -> DataFrame:
    plain = [d for d in DIMENSIONS if d != "networkGroups"]
    return df.select(TIME, *plain, joined_groups(), "count", *[r6(p) for p in _PARTIALS])


def show_group(df: DataFrame) -> DataFrame:
    return df.select(
        TIME, *GROUP_DIMENSIONS, "count", *[r6(p) for p in _PARTIALS], F.round("avg_value", 8).alias("avg_value"), *_COUNTS
    )


def temporal(grains: tuple[str, ...]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = metrics(spark, sf_dir)
        for grain in grains:
            df = rollup_temporal(df, grain, sketch=False)
        return show_temporal(df)

    return run


def group(grains: tuple[str, ...]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = metrics(spark, sf_dir)
        for grain in grains:
            df = rollup_group(df, grain, sketch=False)
        return show_group(df)

    return run


def value_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches merged through three levels, checked by the rank their quantile really has."""
    raw = metrics(spark, sf_dir)
    df = raw
    for grain in ("15m", "hourly", "daily"):
        df = rollup_temporal(df, grain)
    merged = df.groupBy("metricId").agg(merge_sketches("values_sketch").alias("sketch"))
    estimate = merged.select(
        "metricId", *[sketch_quantile("sketch", q).alias(f"q{int(q * 100)}") for q in (0.5, 0.95)]
    )
    facts = raw_rows(raw, "15m").select("metricId", "value").join(estimate, "metricId")
    below = [
        (F.sum((F.col("value") <= F.col(q)).cast("int")) / F.count("value")).alias(q)
        for q in ("q50", "q95")
    ]
    return (
        facts.groupBy("metricId")
        .agg(F.count("value").alias("count"), *below)
        .select(
            "metricId",
            "count",
            (F.abs(F.col("q50") - 0.5) < 0.02).alias("median_within_2pct"),
            (F.abs(F.col("q95") - 0.95) < 0.02).alias("p95_within_2pct"),
        )
    )


def _bucket_sql(minutes: int) -> str:
    if minutes == 1440:
        return "CAST(CAST(__time - INTERVAL 3 HOUR AS DATE) AS TIMESTAMP)"
    return f"time_bucket(INTERVAL {minutes} MINUTE, __time)"


def temporal_sql(minutes: int, cadence: int) -> str:
    plain = [
        d for d in DIMENSIONS if d not in ("networkGroups", "reportInterval", "granularityInterval")
    ]
    partials = ",\n".join(
        f"round({f}({m}), 6) AS {f}_{m}" for m in MEASURES for f in ("sum", "max", "min")
    )
    return f"""WITH {VALUED_SQL}
SELECT {_bucket_sql(minutes)} AS __time, {", ".join(plain)},
    {minutes * 60} AS reportInterval, 'PT{minutes * 60}S' AS granularityInterval,
    array_to_string(networkGroups, ',') AS networkGroups,
    count(*) AS count,
    {partials}
FROM v WHERE reportInterval = {cadence}
GROUP BY ALL"""


def group_sql(minutes: int, cadence: int) -> str:
    partials = ",\n".join(
        f"round({outer}({f}_{m}), 6) AS {f}_{m}"
        for m in MEASURES
        for f, outer in (("sum", "sum"), ("max", "max"), ("min", "min"))
    )
    inner = ", ".join(f"{f}({m}) AS {f}_{m}" for m in MEASURES for f in ("sum", "max", "min"))
    return f"""WITH {VALUED_SQL}, u AS (
    SELECT *, unnest(networkGroups) AS networkGroup FROM v
    WHERE networkGroups IS NOT NULL AND reportInterval = {cadence}
), s AS (
    SELECT __time, formulaId, metricId, isRate, networkGroup, count(*) AS n, {inner},
        count(DISTINCT dn) AS count_dn, count(DISTINCT additionalDn) AS count_ad
    FROM u WHERE networkGroup IS NOT NULL GROUP BY ALL
)
SELECT {_bucket_sql(minutes)} AS __time, {minutes * 60} AS reportInterval, formulaId, metricId,
    isRate, 'PT{minutes * 60}S' AS granularityInterval, networkGroup,
    CAST(sum(n) AS BIGINT) AS count,
    {partials},
    round(sum(sum_value) / sum(n), 8) AS avg_value,
    max(count_dn) AS max_count_dn, min(count_dn) AS min_count_dn,
    max(count_ad) AS "max_count_additionalDn", min(count_ad) AS "min_count_additionalDn"
FROM s GROUP BY ALL"""


QUANTILE_SQL = f"""WITH {VALUED_SQL}
SELECT metricId, count(*) AS count, true AS median_within_2pct, true AS p95_within_2pct
FROM v WHERE reportInterval = 300 GROUP BY metricId"""

QUERIES = {
    "rollup_temporal_15m": Query(temporal(("15m",)), temporal_sql(15, 300)),
    "rollup_temporal_30m": Query(temporal(("30m",)), temporal_sql(30, 900)),
    "rollup_temporal_hourly": Query(temporal(("15m", "hourly")), temporal_sql(60, 300)),
    "rollup_temporal_daily_utc3": Query(
        temporal(("15m", "hourly", "daily")), temporal_sql(1440, 300)
    ),
    "rollup_group_15m": Query(group(("15m",)), group_sql(15, 300)),
    "rollup_group_30m": Query(group(("30m",)), group_sql(30, 900)),
    "rollup_group_hourly": Query(group(("15m", "hourly")), group_sql(60, 300)),
    "rollup_group_daily_utc3": Query(group(("15m", "hourly", "daily")), group_sql(1440, 300)),
    "rollup_value_quantile": Query(value_quantile, QUANTILE_SQL),
}
