"""Threshold queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemeter.operators.threshold import (
    DESCRIPTION,
    HISTORY_ALGORITHM,
    alarm_records,
    bundle_messages,
    evaluate_spatial,
    evaluate_temporal,
    evaluate_temporal_run,
    history_bundle,
    record_messages,
    record_range,
    spatial_run_bounds,
    spatial_scope,
    temporal_scope,
    thresholds_for,
)
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
DNS = ",".join(f"dn-{i}" for i in range(1, 80, 3))
CONFIG = {
    "node_id": f"concat('th-', {K})",
    "node_name": f"concat('Threshold ', {K})",
    "kpi_id": pick(K, EVENT_TYPES),
    "kpi_name": f"concat('KPI ', {K} % 5)",
    "managedObject_id": f"concat('mo-', {K} % 3)",
    "managedObject_name": f"concat('Object ', {K} % 3)",
    "fn": pick(K, ["DEFAULT", "SUM", "AVG", "MAX", "PERCENTILE", "MIN", "COUNT"]),
    "kpi_fn": pick(K, ["AVG", "MAX", "SUM"]),
    "level": pick(K, ["BY_GROUP", "BY_LOCATION", "BY_TOPOLOGY", "NONE"]),
    "sfn": pick(K, ["AVG", "SUM", "MAX", "PERCENTILE", "MIN"]),
    "loc": pick(K, ["CITY", "STATE"]),
    "gran": pick(K, ["PT5M", "null", "PT5M", "PT15M"]),
    "ng": pick(K, ["", "g-1,g-2,g-5", "g-3,g-6,g-0"]),
    "assoc": pick(K, ["GROUP", "SUPERGROUP", "GROUP,SUPERGROUP"]),
    "dns": f"CASE WHEN {K} % 8 = 7 THEN '{DNS}' ELSE '' END",
    "tz": pick(K, ["Z", "-03:00,-02:00", "+00:00,+01:00", "+05:30,+06:00"]),
    "off": f"CASE {K} % 4 WHEN 1 THEN -180 WHEN 3 THEN 330 ELSE 0 END",
    "hours": pick(K, ["ALL", "08,09,10,11,12,18,19,20", "ALL"]),
    "opt": pick(K, ["ALLDAYS", "WORKDAYS", "ALLDAYS", "WEEKEND"]),
    "rate": f"{K} % 2 = 0",
    "unit": f"CASE WHEN {K} % 4 = 0 THEN 'Percentage' ELSE 'Count' END",
}
CONFIG_SQL = "cfg AS (" + derive_sql("nation", CONFIG) + ")"
FIRST, LAST = datetime(2024, 1, 1), datetime(2024, 2, 1)


def _list(column: str) -> Column:
    return F.filter(F.split(column, ","), lambda x: x != "")


def config(
    spark: SparkSession, sf_dir: str, grain: str = "NONE", level: str | None = None,
    granularity: str | None = None,
) -> DataFrame:
    """Threshold rows; ``grain``, ``level`` and ``granularity`` override the derived ones."""
    flat = derive(spark, sf_dir, "nation", CONFIG)
    gran = F.lit(granularity) if granularity else F.col("gran")
    return flat.select(
        "node_id", "node_name", "kpi_id", "kpi_name", "managedObject_id", "managedObject_name",
        F.lit("metrics").alias("dataTableName"),
        F.lit(grain).alias("dataAggregationTime"),
        gran.alias("dataAggregationTimeGranularity"),
        F.col("fn").alias("dataAggregationFunction"),
        F.lit(90.0).alias("dataAggregationPercentileValue"),
        (F.lit(level) if level else F.col("level")).alias("spatialAggregation"),
        F.col("sfn").alias("spatialAggregationFunction"),
        F.lit(75.0).alias("spatialAggregationPercentileValue"),
        F.col("loc").alias("spatialLocationTypeAggregation"),
        F.lit("mo-0").alias("id_spatialManagedObjectAggregation"),
        _list("ng").alias("id_ngInclusion"),
        F.array(F.lit("g-4"), F.lit("g-7")).alias("id_ngInclusion_SG"),
        _list("assoc").alias("typeAssociation"),
        _list("dns").alias("equipmentInclusion"),
        F.lit("PT5M").alias("kpi_defaultTimeGranularity"),
        F.col("unit").alias("kpi_unit"),
        F.col("rate").alias("kpi_isRate"),
        *[
            F.col("kpi_fn").alias(f"kpi_{g}")
            for g in ("hourly", "daily", "weekly", "monthly", "yearly")
        ],
        *[
            F.lit(90.0).alias(f"{g}Percentile")
            for g in ("hourly", "daily", "weekly", "monthly", "yearly")
        ],
        F.when(F.col("rate"), F.lit(HISTORY_ALGORITHM)).otherwise(F.lit("ABSOLUTE_VALUE")).alias(
            "algorithm"
        ),
        F.lit(4.0).alias("algorithmComparisonValue"),
        F.lit(1).alias("intervalDays"),
        F.lit(3).alias("times"),
        F.lit("PERIODDAYS").alias("effectiveDays"),
        F.array("opt").alias("optionsDays"),
        F.split("hours", ",").alias("effectiveHours"),
        F.lit("Completed").alias("load_status"),
        F.col("tz").alias("timeZone"),
    )


# ---------------------------------------------------------------- SQL side


def _scope_sql(level: str | None, tag: str | None, options: bool = True) -> str:
    lvl = f"'{level}'" if level else "c.level"
    fact_tag = f"'{tag}'" if tag else "CASE WHEN c.gran = 'PT15M' THEN 'PT900S' ELSE 'PT300S' END"
    opt = (
        """ AND (hours = 'ALL' OR hour(__time) IN (8, 9, 10, 11, 12, 18, 19, 20))
        AND CASE opt WHEN 'WORKDAYS' THEN isodow(__time) <= 5
                     WHEN 'WEEKEND' THEN isodow(__time) >= 6 ELSE true END"""
        if options
        else ""
    )
    return f"""WITH {METRICS_SQL}, {CONFIG_SQL}, g AS (
    SELECT c.* REPLACE ({lvl} AS level),
        CASE WHEN assoc = 'SUPERGROUP' THEN ['g-4', 'g-7'] WHEN ng = '' THEN CAST([] AS VARCHAR[])
             ELSE string_split(ng, ',') END AS groups,
        CASE WHEN dns = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(dns, ',') END AS dn_list
    FROM cfg c
), j AS (
    SELECT c.*, m.*, CASE WHEN rate AND denominator <> 0 THEN numerator / denominator ELSE value END AS v
    FROM m JOIN g c ON m."metricId" = c.kpi_id AND m."managedObjectId" = c."managedObject_id"
        AND m."granularityInterval" = {fact_tag}
    WHERE (len(groups) = 0 OR coalesce(list_has_any("networkGroups", groups), false))
        AND (len(dn_list) = 0 OR list_contains(dn_list, dn)){opt}
)"""


SLICES_SQL = """unnest(CASE level
        WHEN 'BY_GROUP' THEN CASE WHEN len(groups) = 0 THEN "networkGroups"
                                  ELSE list_intersect("networkGroups", groups) END
        WHEN 'BY_LOCATION' THEN [json_extract_string(enrichment, '$.location.' || loc)]
        WHEN 'BY_TOPOLOGY' THEN [json_extract_string(enrichment, '$.topology."mo-0"')]
        ELSE [CAST(NULL AS VARCHAR)] END)"""


def _choose(fn: str, value: str, rank: float, ratio: bool) -> str:
    plain = f"""CASE {fn} WHEN 'SUM' THEN sum({value}) WHEN 'AVG' THEN avg({value})
        WHEN 'MAX' THEN max({value}) WHEN 'MIN' THEN min({value})
        WHEN 'COUNT' THEN CAST(count({value}) AS DOUBLE)
        WHEN 'PERCENTILE' THEN quantile_cont({value}, {rank}) END"""
    if not ratio:
        return plain
    return f"""coalesce(CASE WHEN rate AND {fn} IN ('SUM', 'AVG') AND sum(denominator) <> 0
        THEN sum(numerator) / sum(denominator) END, {plain})"""


PERCENT = "* CASE WHEN rate AND unit = 'Percentage' THEN 100 ELSE 1 END"
ELEMENTS = 'dn, "additionalDn", "elementType", "vendorId", "equipmentId", "locationId"'


def _window_sql(grain: str) -> tuple[str, str, str]:
    """Local start, start and end of the window of ``__time``."""
    local = "__time" if grain == "HOUR" else "(__time + to_minutes(off))"
    back = "" if grain == "HOUR" else " - to_minutes(off)"
    if grain == "FITTEEN_DAYS":
        first = f"date_trunc('month', {local})"
        start = f"CASE WHEN day({local}) <= 15 THEN {first} ELSE {first} + INTERVAL 15 DAY END"
        end = f"CASE WHEN day({local}) <= 15 THEN {first} + INTERVAL 15 DAY ELSE {first} + INTERVAL 1 MONTH END"
    else:
        start = f"date_trunc('{grain.lower()}', {local})"
        end = f"{start} + INTERVAL 1 {grain}"
    cast = "CAST(({}) AS TIMESTAMP)"
    return cast.format(start), cast.format(start) + back, cast.format(end) + back


def temporal_sql(grain: str, start: datetime, end: datetime) -> str:
    local, ws, we = _window_sql(grain)
    default_fn = "NULL" if grain == "FITTEEN_DAYS" else "kpi_fn"
    fn = f"CASE WHEN fn = 'DEFAULT' THEN {default_fn} ELSE fn END"
    return f"""{_scope_sql(None, None)}, s AS (
    SELECT *, {fn} AS f, {ws} AS ws, {we} AS we, {SLICES_SQL} AS slice
    FROM j WHERE {local} >= TIMESTAMP '{start}' AND {local} < TIMESTAMP '{end}' AND v IS NOT NULL
), e AS (
    SELECT node_id, kpi_id, ws, we, level, sfn, rate, unit, slice, {ELEMENTS}, count(v) AS records,
        {_choose("f", "v", 0.9, True)} AS metric0
    FROM s WHERE f IS NOT NULL
    GROUP BY node_id, kpi_id, ws, we, level, sfn, rate, unit, slice, {ELEMENTS}, f
)
SELECT node_id, kpi_id, ws AS window_start, we AS window_end, 'temporal' AS aggregation, level, slice,
    {ELEMENTS}, records, round(metric0 {PERCENT}, 6) AS metric0
FROM e WHERE level = 'NONE'
UNION ALL
SELECT node_id, kpi_id, ws, we, 'temporal-spatial', level, slice, NULL, NULL, NULL, NULL, NULL, NULL,
    count(metric0), round({_choose("sfn", "metric0", 0.75, False)} {PERCENT}, 6)
FROM e WHERE level <> 'NONE'
GROUP BY node_id, kpi_id, ws, we, level, slice, sfn, rate, unit"""


def _looks_sql(minutes: int) -> str:
    """Look-backs of the history algorithm: 4 buckets, then one more day each, 3 in all."""
    step = 4 * minutes
    return f"CASE WHEN rate THEN [0, {step}, {step + 1440}, {step + 2880}] ELSE [0] END"


def _spatial_cte(level: str | None, minutes: int, tag: str, start: datetime, end: datetime, options=True) -> str:
    return f"""{_scope_sql(level, tag, options)}, b AS (
    SELECT *, time_bucket(INTERVAL {minutes} MINUTE, __time) AS ws, unnest({_looks_sql(minutes)}) AS back FROM j
), k AS (
    SELECT *, ws + to_minutes(back) AS run_start, ws + INTERVAL {minutes} MINUTE AS we FROM b
    WHERE ws + to_minutes(back) >= TIMESTAMP '{start}' AND ws + to_minutes(back) < TIMESTAMP '{end}'
)"""


def spatial_result_sql(level: str | None, minutes: int, tag: str, start, end) -> str:
    return f"""{_spatial_cte(level, minutes, tag, start, end)}, s AS (
    SELECT *, {SLICES_SQL} AS slice FROM k WHERE v IS NOT NULL AND level <> 'NONE'
), res AS (
    SELECT node_id, kpi_id, run_start, ws, we, level, slice, rate, unit, count(v) AS records,
        {_choose("sfn", "v", 0.75, True)} {PERCENT} AS metric0
    FROM s GROUP BY node_id, kpi_id, run_start, ws, we, level, slice, rate, unit, sfn
)"""


def spatial_sql(level: str | None, minutes: int, tag: str, start: datetime, end: datetime) -> str:
    return f"""{spatial_result_sql(level, minutes, tag, start, end)}
SELECT node_id, kpi_id, run_start, ws AS window_start, we AS window_end, 'spatial' AS aggregation,
    level, slice, records, round(metric0, 6) AS metric0 FROM res"""


# ---------------------------------------------------------------- Spark side


def temporal(grain: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = thresholds_for(config(spark, sf_dir, grain), "dataAggregationTime", grain)
        out = evaluate_temporal(metrics(spark, sf_dir), cfg, grain, FIRST, LAST)
        return out.withColumn("metric0", r6("metric0"))

    return run


def temporal_run(grain: str, run_ts: datetime):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = config(spark, sf_dir, grain)
        out = evaluate_temporal_run(metrics(spark, sf_dir), cfg, grain, run_ts)
        return out.withColumn("metric0", r6("metric0"))

    return run


def spatial(level: str, minutes: int, granularity: str, start: datetime, end: datetime):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = thresholds_for(
            config(spark, sf_dir, "NONE", level, granularity),
            "dataAggregationTimeGranularity", granularity,
        )
        out = evaluate_spatial(metrics(spark, sf_dir), cfg, minutes, start, end)
        return out.select(
            "node_id", "kpi_id", "run_start", "window_start", "window_end", "aggregation", "level",
            "slice", "records", r6("metric0"),
        )

    return run


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = temporal_scope(metrics(spark, sf_dir), config(spark, sf_dir, "DAY"), "DAY", FIRST, LAST)
    return record_range(scope).select("node_id", "kpi_id", "window_start", "min_record", "max_record", "records")


def _described(facts: DataFrame) -> DataFrame:
    """Facts with the fields that describe them; element names as they are stored."""
    return facts.withColumns(
        {
            "networkType": F.concat(F.lit("nt-"), F.substring("metricId", 1, 1)),
            "subcategory": F.concat(F.lit("sub-"), "metricId"),
            "familyId": F.concat(F.lit("fam-"), "metricId"),
            "familyName": F.when(F.col("metricId") != "view", F.concat(F.lit("Family "), "metricId")),
            "metricType": F.when(F.col("isRate"), F.lit("RATE")).otherwise(F.lit("COUNTER")),
            "technology": F.concat(F.lit("tech-"), "vendorId"),
            "domain": F.lit("RAN"),
            "equipmentType": F.concat(F.lit("Type "), "equipmentTypeId"),
        }
    )


_DESCRIBED_SQL = """'nt-' || left(any_value(kpi_id), 1) AS "networkType", {category} AS category,
    'sub-' || any_value(kpi_id) AS subcategory, 'fam-' || any_value(kpi_id) AS "familyId",
    CASE WHEN any_value(kpi_id) <> 'view' THEN 'Family ' || any_value(kpi_id) END AS "familyName",
    CASE WHEN min("isRate") = max("isRate") THEN CASE WHEN max("isRate") THEN 'RATE' ELSE 'COUNTER' END END AS "metricType",
    'tech-' || {vendorId} AS technology, 'RAN' AS domain, {equipmentTypeId} AS "equipmentTypeId",
    'Type ' || {equipmentTypeId} AS "equipmentType" """.format(
    **{c: f'CASE WHEN min("{c}") = max("{c}") THEN max("{c}") END' for c in ("category", "vendorId", "equipmentTypeId")}
)
DESCRIBED = ", ".join(f'"{c}"' for c in DESCRIPTION)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = config(spark, sf_dir, "NONE", "BY_GROUP", "PT5M")
    facts = _described(metrics(spark, sf_dir))
    result = evaluate_spatial(facts, cfg, 5, HISTORY_FROM, LAST)
    spans = record_range(spatial_scope(facts, cfg, 5, HISTORY_FROM, LAST))
    return alarm_records(result, spans, cfg, 300, "PT300S", HISTORY_FROM)


SHOWN = (
    "metricId", "name", "dn", "additionalDn", "cellName", "beginTime", "endTime", "reportInterval",
    "granularityInterval", "managedObject", "isRate", "aggregation", "load_status", "thresholdId",
    "aggregationLevel",
)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select(
        "run_start", *SHOWN, *DESCRIPTION, r6("value"),
        F.array_join("networkGroups", ",").alias("networkGroups"),
    )


def temporal_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily records of single elements and of slices; stored names carry commas and quotes."""
    cfg = config(spark, sf_dir, "DAY")
    facts = _described(metrics(spark, sf_dir)).withColumn("locationId", F.concat(F.lit("l$$"), "locationId"))
    facts = facts.withColumn("additionalDn", F.concat(F.lit("a-"), "dn"))
    named = facts.withColumn("dn", F.concat(F.lit('"n$$'), "dn", F.lit('"')))
    # Limits of the config name elements as they are stored.
    cfg = cfg.withColumn("equipmentInclusion", F.transform("equipmentInclusion", lambda d: F.concat(F.lit('"n$$'), d, F.lit('"'))))
    result = evaluate_temporal(named, cfg, "DAY", FIRST, LAST)
    spans = record_range(temporal_scope(named, cfg, "DAY", FIRST, LAST))
    return alarm_records(result, spans, cfg, 86400, "P1D", HISTORY_FROM).select(
        *SHOWN, *DESCRIPTION, r6("value"), "vendorId", "equipmentId", "locationId", "elementType"
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read back from their JSON."""
    out = record_messages(_records(spark, sf_dir))
    return out.select(
        "key",
        F.get_json_object("value", "$.beginTime").cast("long").alias("beginTime"),
        F.round(F.get_json_object("value", "$.value").cast("double"), 6).alias("value"),
        F.size(F.json_object_keys("value")).alias("fields"),
    )


def bundle_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of bundles, read back from their JSON."""
    out = bundle_messages(history_bundle(_records(spark, sf_dir)))
    value = F.col("value")
    return out.select(
        "key",
        F.get_json_object(value, "$.thresholdId").alias("thresholdId"),
        F.get_json_object(value, "$.current.beginTime").cast("long").alias("current_begin"),
        F.get_json_object(value, "$.current.domain").alias("domain"),
        F.array_join(F.array_sort(F.json_object_keys(F.get_json_object(value, "$.values"))), ",").alias("history"),
        F.size(F.json_object_keys(F.get_json_object(value, "$.current"))).alias("fields"),
    )


def bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = history_bundle(_records(spark, sf_dir))
    current = F.col("current")
    return out.select(
        "thresholdId", "dn", "run_start",
        current["beginTime"].alias("current_begin"),
        F.round(current["value"], 6).alias("current_value"),
        F.explode_outer("values").alias("begin", "record"),
    ).select(
        "thresholdId", "dn", "run_start", "current_begin", "current_value",
        F.col("begin").alias("history_begin"),
        F.round(F.col("record")["value"], 6).alias("history_value"),
    )


HISTORY_FROM = FIRST
_RECORDS_SQL = f"""{spatial_result_sql('BY_GROUP', 5, 'PT300S', HISTORY_FROM, LAST)}, span AS (
    SELECT node_id, kpi_id, run_start, ws, min(__time) AS lo, {_DESCRIBED_SQL}
    FROM k GROUP BY node_id, kpi_id, run_start, ws
), rec AS (
    SELECT r.*, {DESCRIBED}, epoch_ms(date_trunc('second', lo)) AS "beginTime", c.kpi_name,
        c."managedObject_name", c.groups,
        r.kpi_id || '-' || c.kpi_name || '-BY_GROUP-' || slice AS rdn
    FROM res r JOIN span USING (node_id, kpi_id, run_start, ws) JOIN g c USING (node_id, kpi_id)
)"""
RECORDS_SQL = f"""{_RECORDS_SQL}
SELECT run_start, kpi_id AS "metricId", kpi_name AS name, rdn AS dn, 'BY_GROUP' AS "additionalDn",
    '' AS "cellName", "beginTime", "beginTime" + 299000 AS "endTime", 300 AS "reportInterval",
    'PT300S' AS "granularityInterval", round(metric0, 6) AS value,
    "managedObject_name" AS "managedObject", array_to_string(groups, ',') AS "networkGroups",
    rate AS "isRate", 'spatial' AS aggregation, 'Completed' AS load_status,
    node_id AS "thresholdId", 'BY_GROUP' AS "aggregationLevel", {DESCRIBED} FROM rec"""
_DAY = _window_sql("DAY")
TEMPORAL_RECORDS_SQL = f"""WITH res AS (SELECT * FROM ({temporal_sql("DAY", FIRST, LAST)})), described AS (
    SELECT node_id, kpi_id, {_DAY[1]} AS window_start, min(__time) AS lo, max(__time) AS hi, {_DESCRIBED_SQL}
    FROM ({_scope_sql(None, None, options=False)} SELECT * FROM j)
    WHERE {_DAY[0]} >= TIMESTAMP '{FIRST}' AND {_DAY[0]} < TIMESTAMP '{LAST}'
    GROUP BY node_id, kpi_id, {_DAY[1]}
), labels AS ({_scope_sql(None, None).split(", j AS (")[0]} SELECT * FROM g), rec AS (
    SELECT r.*, lo, hi, {DESCRIBED}, c.kpi_name, c."managedObject_name", c.rate, c.loc,
        r.aggregation <> 'temporal' AS sliced
    FROM res r JOIN described d USING (node_id, kpi_id, window_start) JOIN labels c USING (node_id, kpi_id)
)
SELECT kpi_id AS "metricId", kpi_name AS name,
    CASE WHEN sliced THEN kpi_id || '-' || kpi_name || '-' || level || coalesce('-' || slice, '') ELSE 'n,' || dn END AS dn,
    CASE WHEN sliced THEN level ELSE 'a-' || dn END AS "additionalDn",
    CASE level WHEN 'BY_LOCATION' THEN loc WHEN 'BY_TOPOLOGY' THEN 'mo-0' ELSE '' END AS "cellName",
    epoch_ms(date_trunc('second', lo)) AS "beginTime", epoch_ms(date_trunc('second', hi)) AS "endTime",
    86400 AS "reportInterval", 'P1D' AS "granularityInterval", "managedObject_name" AS "managedObject", rate AS "isRate",
    aggregation, 'Completed' AS load_status, node_id AS "thresholdId", level AS "aggregationLevel", {DESCRIBED},
    metric0 AS value, CASE WHEN sliced THEN '' ELSE "vendorId" END AS "vendorId",
    CASE WHEN sliced THEN '' ELSE "equipmentId" END AS "equipmentId",
    CASE WHEN sliced THEN '' ELSE 'l$$' || "locationId" END AS "locationId",
    CASE WHEN sliced THEN '' ELSE "elementType" END AS "elementType" FROM rec"""
BUNDLE_MESSAGES_SQL = f"""{_RECORDS_SQL}, n AS (
    SELECT *, max("beginTime") OVER (PARTITION BY node_id, kpi_id, rdn, run_start) AS newest FROM rec
)
SELECT any_value(rdn) || '+' || node_id AS key, node_id AS "thresholdId", newest AS current_begin, 'RAN' AS domain,
    coalesce(string_agg(DISTINCT CAST("beginTime" AS VARCHAR), ',' ORDER BY CAST("beginTime" AS VARCHAR))
        FILTER ("beginTime" < newest), '') AS history, 41 AS fields
FROM n GROUP BY node_id, kpi_id, rdn, run_start, newest"""
MESSAGES_SQL = f"""{_RECORDS_SQL}
SELECT rdn || '+' || node_id AS key, "beginTime", round(metric0, 6) AS value, 41 AS fields FROM rec"""
BUNDLE_SQL = f"""{_RECORDS_SQL}, n AS (
    SELECT *, max("beginTime") OVER (PARTITION BY node_id, kpi_id, rdn, run_start) AS newest FROM rec
)
SELECT c.node_id AS "thresholdId", c.rdn AS dn, c.run_start, c.newest AS current_begin,
    round(c.metric0, 6) AS current_value, o."beginTime" AS history_begin,
    round(o.metric0, 6) AS history_value
FROM n c LEFT JOIN n o ON c.node_id = o.node_id AND c.kpi_id = o.kpi_id AND c.rdn = o.rdn
    AND c.run_start = o.run_start AND o."beginTime" < o.newest
WHERE c."beginTime" = c.newest"""
RANGES_SQL = f"""{_scope_sql(None, None, options=False)}
SELECT node_id, kpi_id, {_window_sql('DAY')[1]} AS window_start, min(__time) AS min_record,
    max(__time) AS max_record, count(*) AS records
FROM j WHERE {_window_sql('DAY')[0]} >= TIMESTAMP '{FIRST}' AND {_window_sql('DAY')[0]} < TIMESTAMP '{LAST}'
GROUP BY ALL"""


def _temporal(grain: str) -> Query:
    return Query(temporal(grain), temporal_sql(grain, FIRST, LAST))


def _spatial(level: str, minutes: int, granularity: str, tag: str) -> Query:
    return Query(
        spatial(level, minutes, granularity, FIRST, LAST),
        spatial_sql(level, minutes, tag, FIRST, LAST),
    )


RUN = datetime(2024, 1, 17, 9, 25, 30)

QUERIES = {
    "threshold_temporal_hour": _temporal("HOUR"),
    "threshold_temporal_day": _temporal("DAY"),
    "threshold_temporal_week": _temporal("WEEK"),
    "threshold_temporal_month": _temporal("MONTH"),
    "threshold_temporal_half_month": _temporal("FITTEEN_DAYS"),
    "threshold_temporal_single_run": Query(
        temporal_run("DAY", RUN),
        temporal_sql("DAY", datetime(2024, 1, 16), datetime(2024, 1, 17)),
    ),
    "threshold_spatial_group": _spatial("BY_GROUP", 15, "PT15M", "PT900S"),
    "threshold_spatial_location": _spatial("BY_LOCATION", 5, "PT5M", "PT300S"),
    "threshold_spatial_topology": _spatial("BY_TOPOLOGY", 5, "PT5M", "PT300S"),
    "threshold_spatial_single_run": Query(
        spatial("BY_GROUP", 5, "PT5M", *spatial_run_bounds(RUN, 5, 10)),
        spatial_sql(
            "BY_GROUP", 5, "PT300S", datetime(2024, 1, 17, 9, 10), datetime(2024, 1, 17, 9, 15)
        ),
    ),
    "threshold_record_range": Query(ranges, RANGES_SQL),
    "threshold_alarm_records": Query(records, RECORDS_SQL),
    "threshold_alarm_messages": Query(messages, MESSAGES_SQL),
    "threshold_temporal_records": Query(temporal_records, TEMPORAL_RECORDS_SQL),
    "threshold_history_bundle": Query(bundle, BUNDLE_SQL),
    "threshold_bundle_messages": Query(bundle_json, BUNDLE_MESSAGES_SQL),
}
