"""Analytics inputs derived from the driver tables, once for Spark and once as SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Query:
    """A registered query and, where SQL can express it, the text it must agree with."""

    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Small rows that become large documents: a file of them is one split, however many there are.
ROWS_PER_TASK = 20_000


def spread(rows: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows dealt by their values over tasks of about ``per_task`` rows each."""
    return rows.repartition(max(1, -(-rows.count() // per_task)), *rows.columns)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched metric facts."""
    return metric_view(table(spark, sf_dir, "events"))


def metric_view(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "ts AS __time",
        "concat('dn-', user_id) AS dn",
        "concat('dev-', user_id % 10) AS additionalDn",
        "event_type AS metricId",
        "concat('fm-', event_type) AS formulaId",
        "concat('pr-', user_id % 4) AS pollingRuleId",
        "concat('fn-', user_id % 2) AS functionId",
        "concat('mo-', user_id % 3) AS managedObjectId",
        "concat('eq-', user_id % 25) AS equipmentId",
        "concat('et-', user_id % 5) AS equipmentTypeId",
        "concat('loc-', user_id % 6) AS locationId",
        "concat('vd-', user_id % 4) AS vendorId",
        "concat('sv-', user_id % 4) AS sourceVendor",
        "CASE WHEN user_id % 2 = 0 THEN 'SYS-A' ELSE 'SYS-B' END AS sourceSystem",
        "CASE WHEN user_id % 5 < 3 THEN 'CELL' ELSE 'ROUTER' END AS elementType",
        "concat('192.0.2.', user_id % 10) AS managerIp",
        "concat('f-', event_id % 20) AS managerFilename",
        "CASE WHEN user_id % 9 = 0 THEN NULL ELSE concat('cat-', event_id % 2) END AS category",
        """CASE WHEN user_id % 7 = 0 THEN NULL
                WHEN user_id % 3 = 0 THEN array(concat('g-', user_id % 5), concat('g-', 5 + user_id % 4))
                ELSE array(concat('g-', user_id % 5)) END AS networkGroups""",
        """concat('{"topology":{"mo-0":"eq-', (user_id + 1) % 25, '"},"location":{"CITY":"city-',
                user_id % 6, '","STATE":"state-', user_id % 3, '"}}') AS enrichment""",
        "user_id % 2 = 0 AS isRate",
        "CASE WHEN event_id % 8 = 7 THEN 900 ELSE 300 END AS reportInterval",
        "CASE WHEN event_id % 8 = 7 THEN 'PT900S' ELSE 'PT300S' END AS granularityInterval",
        "CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value",
        "cast(get_json_object(props, '$.k') AS double) AS numerator",
        "CASE WHEN event_id % 11 = 0 THEN NULL ELSE cast(event_id % 4 AS double) END AS denominator",
    )


METRICS_SQL = """m AS (
    SELECT ts AS __time,
        'dn-' || user_id AS dn,
        'dev-' || (user_id % 10) AS additionalDn,
        event_type AS metricId,
        'fm-' || event_type AS formulaId,
        'pr-' || (user_id % 4) AS pollingRuleId,
        'fn-' || (user_id % 2) AS functionId,
        'mo-' || (user_id % 3) AS managedObjectId,
        'eq-' || (user_id % 25) AS equipmentId,
        'et-' || (user_id % 5) AS equipmentTypeId,
        'loc-' || (user_id % 6) AS locationId,
        'vd-' || (user_id % 4) AS vendorId,
        'sv-' || (user_id % 4) AS sourceVendor,
        CASE WHEN user_id % 2 = 0 THEN 'SYS-A' ELSE 'SYS-B' END AS sourceSystem,
        CASE WHEN user_id % 5 < 3 THEN 'CELL' ELSE 'ROUTER' END AS elementType,
        '192.0.2.' || (user_id % 10) AS managerIp,
        'f-' || (event_id % 20) AS managerFilename,
        CASE WHEN user_id % 9 = 0 THEN NULL ELSE 'cat-' || (event_id % 2) END AS category,
        CASE WHEN user_id % 7 = 0 THEN NULL
             WHEN user_id % 3 = 0 THEN ['g-' || (user_id % 5), 'g-' || (5 + user_id % 4)]
             ELSE ['g-' || (user_id % 5)] END AS networkGroups,
        '{"topology":{"mo-0":"eq-' || ((user_id + 1) % 25) || '"},"location":{"CITY":"city-'
            || (user_id % 6) || '","STATE":"state-' || (user_id % 3) || '"}}' AS enrichment,
        user_id % 2 = 0 AS isRate,
        CASE WHEN event_id % 8 = 7 THEN 900 ELSE 300 END AS reportInterval,
        CASE WHEN event_id % 8 = 7 THEN 'PT900S' ELSE 'PT300S' END AS granularityInterval,
        CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value,
        CAST(json_extract_string(props, '$.k') AS DOUBLE) AS numerator,
        CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 4 AS DOUBLE) END AS denominator
    FROM events
)"""

# The metric view with the rate value in place of the value, rows without a value removed.
VALUED_SQL = (
    METRICS_SQL
    + """, v AS (
    SELECT * REPLACE (CASE WHEN isRate AND denominator <> 0 THEN numerator / denominator
                           ELSE value END AS value)
    FROM m
    WHERE (CASE WHEN isRate AND denominator <> 0 THEN numerator / denominator ELSE value END)
          IS NOT NULL
)"""
)


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter samples."""
    return table(spark, sf_dir, "events").selectExpr(
        "ts AS __time",
        "concat('dev-', user_id % 10) AS additionalDn",
        "concat('dn-', user_id % 20) AS dn",
        "concat('vn-', user_id % 2) AS vendorName",
        "event_type AS name",
        "concat('c_', event_type) AS code",
        "concat('fam-', user_id % 2) AS familyId",
        "'CELL' AS elementType",
        "'SYS-C' AS sourceSystem",
        "concat('192.0.2.', user_id % 10) AS managerIp",
        "'true' AS isReliable",
        "concat('f-', event_id % 20) AS managerFilename",
        "1 AS reportInterval",
        "CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value",
    )


COUNTERS_SQL = """c AS (
    SELECT ts AS __time,
        'dev-' || (user_id % 10) AS additionalDn,
        'dn-' || (user_id % 20) AS dn,
        'vn-' || (user_id % 2) AS vendorName,
        event_type AS name,
        'c_' || event_type AS code,
        'fam-' || (user_id % 2) AS familyId,
        'CELL' AS elementType,
        'SYS-C' AS sourceSystem,
        '192.0.2.' || (user_id % 10) AS managerIp,
        'true' AS isReliable,
        'f-' || (event_id % 20) AS managerFilename,
        1 AS reportInterval,
        CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value
    FROM events
)"""


def r6(column: str | Column, name: str | None = None) -> Column:
    """Six decimals: summation order differs between engines."""
    col = F.col(column) if isinstance(column, str) else column
    return F.round(col, 6).alias(name or column)


def joined_groups() -> Column:
    return F.array_join("networkGroups", ",").alias("networkGroups")


def derive(spark: SparkSession, sf_dir: str, source: str, columns: dict[str, str]) -> DataFrame:
    """Select expressions that read the same in Spark SQL and in the oracle."""
    return table(spark, sf_dir, source).selectExpr(
        *[f"{expr} AS `{name}`" for name, expr in columns.items()]
    )


def derive_sql(source: str, columns: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + f" FROM {source}"


def pick(expr: str, options: list[str]) -> str:
    """``CASE`` that cycles through text options by a number."""
    arms = " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(options))
    return f"CASE ({expr}) % {len(options)} {arms} END"


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
