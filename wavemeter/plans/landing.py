"""Config, log, message and inventory queries over documents built from the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavemeter.functions.scalars import (
    any_contains,
    bracketed_lists,
    literal_boolean,
    literal_text,
    quoted_equals,
    quoted_list,
    quoted_times,
)
from wavemeter.model import ELEMENT_MESSAGE
from wavemeter.operators.threshold import expand_supergroups
from wavemeter.plans.fixtures import Query, pick, spread, table
from wavemeter.sources.configs import (
    flatten_busy_hours,
    flatten_thresholds,
    group_children,
    loadable_thresholds,
)
from wavemeter.sources.landed import (
    alert_rows,
    chart_rows,
    element_feeds,
    element_rows,
    index_documents,
    inventory_rows,
    map_fields,
    parse_query_log,
    promql_rows,
    recent_log_lines,
    report_requests,
    run_stored_query,
    split_malformed,
)

K = "p_partkey"

# ---------------------------------------------------------------- threshold documents


def _node(id_: str) -> str:
    def kpi(n: int) -> str:
        return (
            f"named_struct('kpi', named_struct('id', concat('k{n}-', {K} % 7), 'name',"
            f" concat('KPI {n}-', {K} % 7), 'defaultTimeGranularity', 'PT5M', 'isRate',"
            f" {K} % 2 = 0, 'unit', 'Percentage', 'hourly', 'AVG'))"
        )

    return f"""named_struct('node', named_struct(
        'id', {id_}, 'name', p_name, 'status', {K} % 5 <> 0,
        'dataAggregationTime', {pick(K, ['hour', 'DAY', 'NONE'])},
        'spatialAggregation', {pick(f'{K} % 4', ['NONE', 'BY_GROUP', 'BY_LOCATION', 'NONE'])},
        'dataAggregationPercentileValue', CASE WHEN {K} % 2 = 0 THEN 95.0D END,
        'spatialLocationTypeAggregation',
            CASE WHEN {K} % 4 = 2 THEN named_struct('id', 'lt-1', 'name', 'CITY') END,
        'managedObject', named_struct('id', concat('mo-', {K} % 3), 'name', 'object',
            'model', CASE WHEN {K} % 4 <> 0 THEN named_struct('tableName', 'metrics') END),
        'expression', named_struct('id', concat('ex-', {K}), 'terms',
            CASE WHEN {K} % 6 = 0 THEN array({kpi(1)}, named_struct('kpi', null))
                 WHEN {K} % 6 = 1 THEN array({kpi(1)}, {kpi(2)}) ELSE array({kpi(1)}) END),
        'equipmentAssociation', transform(array(0, 1), i -> named_struct(
            'ngInclusion', CASE WHEN i = 0 THEN array(
                named_struct('id', concat('sg-', {K} % 25), 'name', 'a', 'typeAssociation', 'SUPERGROUP'),
                named_struct('id', concat('sg-', ({K} + 1) % 25), 'name', 'b', 'typeAssociation',
                    CASE WHEN {K} % 3 = 0 THEN 'GROUP' ELSE 'SUPERGROUP' END)) END,
            'equipmentInclusion', CASE WHEN i = 0 THEN
                array(named_struct('id', 'e1', 'dn', concat('dn-', {K} % 50))) END,
            'ngExclusion', CASE WHEN i = 1 THEN array(named_struct('id', 'x-1', 'name', 'x')) END)),
        'effectiveHours', CASE WHEN {K} % 2 = 0 THEN array(
            named_struct('optionsEffectiveHours', '_08_00'),
            named_struct('optionsEffectiveHours', '_21_30'))
            ELSE array(named_struct('optionsEffectiveHours', 'ALL')) END,
        'days', array(named_struct('optionsDays', 'WORKDAYS')), 'timeZone', 'Z'))"""


def threshold_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per part with two thresholds; the second id repeats across documents."""
    own, shared = _node(f"concat('th-', {K})"), _node(f"concat('shared-', {K} % 40)")
    return spread(table(spark, sf_dir, "part").select(K, "p_name")).selectExpr(
        f"{K} AS doc_order",
        f"""CASE WHEN {K} % 50 = 7 THEN '{{"thresholds": broken' ELSE to_json(named_struct(
            'thresholds', named_struct('edges', array({own}, {shared})))) END AS value""",
    )


ORDER = ("doc_order", "edge_pos", "term_pos")


def thresholds_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_thresholds(threshold_documents(spark, sf_dir)).select(
        "doc_order", "edge_pos", "term_pos", "node_id", "node_name", "dataAggregationTime",
        "dataAggregationPercentileValue", "spatialAggregation", "spatialLocationTypeAggregation",
        "managedObject_id", "dataTableName", "expression_id",
        F.array_join("id_ngInclusion", ",").alias("id_ngInclusion"),
        F.array_join("typeAssociation", ",").alias("typeAssociation"),
        F.array_join("id_ngExclusion", ",").alias("id_ngExclusion"),
        F.array_join("equipmentInclusion", ",").alias("equipmentInclusion"),
        "kpi_id", "kpi_name", "kpi_isRate", "kpi_hourly",
        F.array_join("optionsDays", ",").alias("optionsDays"),
        F.array_join("effectiveHours", ",").alias("effectiveHours"),
    )


_FLAT_CTE = f"""WITH p AS (
    SELECT *, unnest([0, 1]) AS edge_pos FROM part
    WHERE {K} % 50 <> 7 AND {K} % 5 <> 0
        AND NOT ({K} % 3 = 2 AND {K} % 4 IN (0, 3))
), f AS (
    SELECT *, unnest(CASE WHEN {K} % 6 = 1 THEN [0, 1] ELSE [0] END) AS term_pos FROM p
), flat AS (
    SELECT {K} AS doc_order, edge_pos, term_pos,
        CASE edge_pos WHEN 0 THEN 'th-' || {K} ELSE 'shared-' || ({K} % 40) END AS node_id,
        p_name AS node_name, upper({pick(K, ['hour', 'DAY', 'NONE'])}) AS "dataAggregationTime",
        CASE WHEN {K} % 2 = 0 THEN 95.0::DOUBLE END AS "dataAggregationPercentileValue",
        {pick(f'{K} % 4', ['NONE', 'BY_GROUP', 'BY_LOCATION', 'NONE'])} AS "spatialAggregation",
        CASE WHEN {K} % 4 = 2 THEN 'CITY' ELSE '' END AS "spatialLocationTypeAggregation",
        'mo-' || ({K} % 3) AS "managedObject_id",
        CASE WHEN {K} % 4 <> 0 THEN 'metrics' END AS "dataTableName", 'ex-' || {K} AS expression_id,
        'sg-' || ({K} % 25) || ',sg-' || (({K} + 1) % 25) AS "id_ngInclusion",
        CASE WHEN {K} % 3 = 0 THEN 'SUPERGROUP,GROUP' ELSE 'SUPERGROUP,SUPERGROUP' END AS "typeAssociation",
        'x-1' AS "id_ngExclusion", 'dn-' || ({K} % 50) AS "equipmentInclusion",
        'k' || (term_pos + 1) || '-' || ({K} % 7) AS kpi_id,
        'KPI ' || (term_pos + 1) || '-' || ({K} % 7) AS kpi_name,
        {K} % 2 = 0 AS "kpi_isRate", 'AVG' AS kpi_hourly, 'WORKDAYS' AS "optionsDays",
        CASE WHEN {K} % 2 = 0 THEN '08,21' ELSE 'ALL' END AS "effectiveHours"
    FROM f
)"""


def config_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_thresholds(threshold_documents(spark, sf_dir))
    return loadable_thresholds(flat, ORDER).select(
        "doc_order", "node_id", "kpi_name", "kpi_id", "dataAggregationTime", "spatialAggregation",
        "dataAggregationPercentileValue", "spatialAggregationPercentileValue",
    )


CONFIG_LOAD_SQL = f"""{_FLAT_CTE}, r AS (
    SELECT *, row_number() OVER (PARTITION BY node_id, kpi_name
        ORDER BY doc_order, edge_pos, term_pos) AS rn FROM flat
)
SELECT doc_order, node_id, kpi_name, kpi_id, "dataAggregationTime", "spatialAggregation",
    coalesce("dataAggregationPercentileValue", 0.0) AS "dataAggregationPercentileValue",
    0.0::DOUBLE AS "spatialAggregationPercentileValue" FROM r WHERE rn = 1"""


def supergroups(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = loadable_thresholds(flatten_thresholds(threshold_documents(spark, sf_dir)), ORDER)
    pages = table(spark, sf_dir, "supplier").selectExpr(
        """to_json(named_struct('networkGroups', named_struct('edges', array(named_struct('node',
            named_struct('id', concat('g-', s_suppkey), 'name', s_name, 'parentId',
                concat('sg-', s_nationkey), 'targetGroups',
                CASE WHEN s_suppkey % 3 = 0 THEN array('REPORTS') ELSE array('REPORTS', 'ALARMS') END
            )))))) AS value"""
    )
    return expand_supergroups(cfg, group_children(pages)).select(
        "node_id", "kpi_id", F.array_join("id_ngInclusion_SG", ",").alias("id_ngInclusion_SG")
    )


SUPERGROUP_SQL = f"""{_FLAT_CTE}, r AS (
    SELECT *, row_number() OVER (PARTITION BY node_id, kpi_name
        ORDER BY doc_order, edge_pos, term_pos) AS rn FROM flat
), x AS (SELECT * FROM r WHERE rn = 1), c AS (
    SELECT 'g-' || s_suppkey AS child, 'sg-' || s_nationkey AS parent FROM supplier WHERE s_suppkey % 3 <> 0
), e AS (
    SELECT node_id, kpi_id, list_sort(list(DISTINCT child)) AS kids
    FROM x JOIN c ON list_contains(string_split("id_ngInclusion", ','), parent)
    WHERE "typeAssociation" = 'SUPERGROUP,SUPERGROUP' GROUP BY ALL
)
SELECT x.node_id, x.kpi_id, coalesce(array_to_string(kids, ','), '') AS "id_ngInclusion_SG"
FROM x LEFT JOIN e ON e.node_id = x.node_id AND e.kpi_id = x.kpi_id"""

# ---------------------------------------------------------------- busy-hour documents


def busy_hours_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "part").selectExpr(
        f"""to_json(named_struct('busyHours', named_struct('edges', array(named_struct('node', named_struct(
            'id', concat('bh-', {K}), 'name', p_name, 'status',
            CASE WHEN {K} % 4 = 0 THEN 'DISABLE' ELSE 'ENABLE' END,
            'aggregationFunction', {pick(K, ['SUM', 'AVG', 'PERCENTILE'])},
            'percentileValue', CASE WHEN {K} % 3 = 2 THEN 95.0D END,
            'kpi', named_struct('id', concat('k-', {K} % 7), 'name', 'kpi', 'defaultTimeGranularity', 'PT15M'),
            'managedObject', named_struct('id', concat('mo-', {K} % 3), 'name', 'object',
                'model', CASE WHEN {K} % 5 <> 0 THEN named_struct('tableName', 'metrics') END),
            'timeSettings', array(
                named_struct('period', 'DAILY_BUSY_HOUR', 'firstBH', true, 'secondBH', {K} % 2 = 0, 'thirdBH', {K} % 3 = 0),
                named_struct('period', 'WEEKLY_BUSY_HOUR', 'firstBH', false, 'secondBH', true, 'thirdBH', false)),
            'effectiveDay', 'SPECIFICDAYS',
            'days', array(named_struct('day2', 'MONDAY'), named_struct('day2', 'FRIDAY')),
            'effectiveHour', array(named_struct('optionsEffectiveHours', '_07_00'),
                named_struct('optionsEffectiveHours', 'ALL'))
        )))))) AS value"""
    )
    return flatten_busy_hours(docs).select(
        "node_id", "node_name", "aggregationFunction", "percentileValue", "kpi_id",
        "defaultTimeGranularity", "managedObject_id", "dataTableName", "period",
        F.array_join(F.col("level").cast("array<string>"), ",").alias("level"), "effectiveDay",
        F.array_join("day2", ",").alias("day2"),
        F.array_join("effective_hours", ",").alias("effective_hours"),
    )


BUSY_HOURS_SQL = f"""WITH p AS (SELECT *, unnest(['DAILY_BUSY_HOUR', 'WEEKLY_BUSY_HOUR']) AS period
    FROM part WHERE {K} % 4 <> 0)
SELECT 'bh-' || {K} AS node_id, p_name AS node_name,
    {pick(K, ['SUM', 'AVG', 'PERCENTILE'])} AS "aggregationFunction",
    CASE WHEN {K} % 3 = 2 THEN 95.0 ELSE 0.0 END::DOUBLE AS "percentileValue", 'k-' || ({K} % 7) AS kpi_id,
    'PT15M' AS "defaultTimeGranularity", 'mo-' || ({K} % 3) AS "managedObject_id",
    CASE WHEN {K} % 5 <> 0 THEN 'metrics' ELSE '' END AS "dataTableName", period,
    CASE WHEN period = 'WEEKLY_BUSY_HOUR' THEN '2' ELSE '1' || CASE WHEN {K} % 2 = 0 THEN ',2' ELSE '' END
        || CASE WHEN {K} % 3 = 0 THEN ',3' ELSE '' END END AS level,
    'SPECIFICDAYS' AS "effectiveDay", 'MONDAY,FRIDAY' AS day2, '07:00,ALL' AS effective_hours FROM p"""

# ---------------------------------------------------------------- PromQL

TEMPLATES = {"cell": "Site=<sitename>,Cell=<cell>,Dev=<additionalDn>", "host": "Host=<host>,Zone=<zone>"}
METRIC_TEMPLATE = {
    "ctf5g_click": "cell", "CTF4G_error": "cell", "node_purchase": "host", "node_signup": "host",
    "ctf5g_view": "cell",
}


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "events").selectExpr(
        "concat('192.0.2.', user_id % 4) AS ip",
        f"""to_json(named_struct('status', 'success', 'data', named_struct('resultType', 'vector', 'result',
            array(named_struct('metric', map_filter(map(
                '__name__', {_METRIC_NAME},
                'sitename', concat('S', user_id % 30),
                'cell', CASE WHEN event_id % 3 > 0 THEN concat('C', user_id) END,
                'host', concat('h', user_id % 5),
                'zone', CASE WHEN event_id % 4 > 0 THEN 'z.1' END), (k, v) -> v IS NOT NULL),
                'value', array(cast(unix_seconds(cast(ts AS timestamp)) AS string), cast(cast(value AS decimal(12,2)) AS string))
            ))))) AS value""",
    )
    return promql_rows(docs, TEMPLATES, METRIC_TEMPLATE, "-GW01", "family-1", "vendor-1").select(
        "code", "dn", "value", "beginTime", "endTime", "additionalDn", "sourceSystem", "managerIp",
        "granularityInterval", "reportInterval",
    )


_METRIC_NAME = """CASE event_type WHEN 'click' THEN 'ctf5g_click' WHEN 'error' THEN 'CTF4G_error'
    WHEN 'purchase' THEN 'node_purchase' WHEN 'signup' THEN 'node_signup' ELSE 'ctf5g_view' END"""
VECTORS_SQL = f"""WITH e AS (SELECT *, {_METRIC_NAME} AS code FROM events)
SELECT code, CASE WHEN code LIKE 'node%' THEN 'Host=h' || (user_id % 5) || ',Zone=' ||
        CASE WHEN event_id % 4 > 0 THEN 'z.1' ELSE 'null' END
    ELSE 'Site=S' || (user_id % 30) || ',Cell=' || CASE WHEN event_id % 3 > 0 THEN 'C' || user_id ELSE 'null' END
        || ',Dev=S' || (user_id % 30) || '-GW01' END AS dn,
    CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS value,
    CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS "beginTime",
    CAST(epoch(date_trunc('minute', ts)) AS BIGINT) + 300 AS "endTime",
    'S' || (user_id % 30) || '-GW01' AS "additionalDn",
    CASE WHEN code LIKE 'ctf5g%' THEN 'ctf5g' WHEN lower(code) LIKE 'ctf4g%' THEN 'ctf4g' ELSE 'ctf_infra' END AS "sourceSystem",
    '192.0.2.' || (user_id % 4) AS "managerIp", 'PT300S' AS "granularityInterval", 300 AS "reportInterval"
FROM e"""

# ---------------------------------------------------------------- query logs

LOG_SINCE = datetime(2024, 1, 10, 12)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines, every one twice; some without a timestamp, some with broken JSON."""
    lines = table(spark, sf_dir, "events").selectExpr(
        r"""concat_ws('\t',
            CASE WHEN event_id % 19 = 0 THEN 'at' ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") END,
            concat('192.0.2.', user_id % 9),
            CASE WHEN event_id % 7 = 0 THEN concat('{"queryType":"scan","broken":', event_id)
                 WHEN event_id % 3 = 0 THEN concat('{"queryType":"timeseries","id":', event_id,
                    ',"intervals":{"segments":[{"a":[1,2]},{"a":[3]},', user_id, ']}}')
                 WHEN event_id % 3 = 1 THEN concat('{"queryType":"groupBy","id":', event_id, '}') END,
            CASE WHEN event_id % 2 = 0 THEN concat('{"query":"SELECT ', event_id, '"}') END,
            concat('{"sqlQuery/time":', user_id, '}')) AS value"""
    )
    return lines.unionByName(lines)


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_query_log(recent_log_lines(log_lines(spark, sf_dir), LOG_SINCE)).select(
        "timestamp",
        F.get_json_object("queryType_json", "$.queryType").alias("query_type"),
        F.get_json_object("queryType_json", "$.intervals.segments").alias("segments"),
        "query_json",
        "sqlquery_time",
    )


LOGS_SQL = """SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(CAST(epoch_ms(date_trunc('millisecond', ts)) % 1000 AS INTEGER) AS VARCHAR), 3, '0') || 'Z' AS timestamp,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'timeseries' WHEN event_id % 3 = 1 THEN 'groupBy' END AS query_type,
    CASE WHEN event_id % 7 <> 0 AND event_id % 3 = 0 THEN '3' END AS segments,
    CASE WHEN event_id % 2 = 0 THEN '{"query":"SELECT ' || event_id || '"}' END AS query_json,
    '{"sqlQuery/time":' || user_id || '}' AS sqlquery_time
FROM events WHERE event_id % 19 <> 0 AND date_trunc('millisecond', ts) >= TIMESTAMP '2024-01-10 12:00:00'"""

# ---------------------------------------------------------------- notifications


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "events").selectExpr(
        f"""CASE WHEN event_id % 23 = 0 THEN 'not json' ELSE to_json(named_struct(
            'alarmId', concat('a-', event_id), 'alarmTypeName', concat('Type ', event_type),
            'alarmedObjectName', CASE WHEN user_id % 3 > 0 THEN concat('dn-', user_id) END,
            'thresholdRuleName', concat('rule-', user_id % 4), 'value', cast(event_id AS string),
            'alarmRaisedTime', unix_millis(cast(ts AS timestamp)), 'timeZone', 'UTC',
            'eventType', CASE WHEN event_id % 2 = 0 THEN 'x1' ELSE 'x2' END,
            'perceivedSeverity', {pick('event_id', ['critical', 'MAJOR', 'Minor', 'WARNING'])},
            'cleared', event_id % 5 = 0,
            'sendToEmail', named_struct('list', CASE WHEN event_id % 2 = 0
                THEN array('a@example.com', 'b@example.com') ELSE array('c@example.com') END)
        )) END AS value"""
    )
    return alert_rows(messages)


_SEVERITY = f"upper({pick('event_id', ['critical', 'MAJOR', 'Minor', 'WARNING'])})"
ALERTS_SQL = f"""WITH e AS (
    SELECT *, {_SEVERITY} AS sev, CASE WHEN event_id % 5 = 0 THEN 'CLEAR' ELSE {_SEVERITY} END AS lvl,
        unnest(CASE WHEN event_id % 2 = 0 THEN ['a@example.com', 'b@example.com'] ELSE ['c@example.com'] END) AS recipient
    FROM events WHERE event_id % 23 <> 0
), x AS (
    SELECT *, CASE sev WHEN 'CRITICAL' THEN '🔴' WHEN 'MAJOR' THEN '🟠' WHEN 'MINOR' THEN '🟡' ELSE '🔵' END AS si
    FROM e
)
SELECT recipient, 'a-' || event_id AS "alarmId",
    si || ' ' || sev || ' ALERTA: Type ' || event_type || ' REGRA: rule-' || (user_id % 4) AS subject,
    lvl AS severity, CASE lvl WHEN 'CLEAR' THEN '🟢' ELSE si END AS icon,
    CASE lvl WHEN 'CLEAR' THEN '#00FF00' WHEN 'CRITICAL' THEN '#FF0000' WHEN 'MAJOR' THEN '#FFA500'
        WHEN 'MINOR' THEN '#FFFF00' ELSE '#3399FF' END AS colour,
    'Type ' || event_type AS "alarmTypeName",
    CASE WHEN user_id % 3 > 0 THEN 'dn-' || user_id ELSE 'Sem informação' END AS "alarmedObjectName",
    'rule-' || (user_id % 4) AS "thresholdRuleName", CAST(event_id AS VARCHAR) AS value,
    strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS raised,
    CASE WHEN event_id % 2 = 0 THEN 'ATIVO' ELSE 'ENCERRADO' END AS event_status FROM x"""


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "orders").selectExpr(
        """to_json(named_struct('storekey', concat('exports/Relatório Ação ', o_orderpriority, ' ', o_orderkey, '.csv'),
            'exportFormat', '.csv', 'recipients', concat('[u', o_custkey, '@example.com,v@example.com]'))) AS value"""
    )
    return report_requests(messages).withColumn("recipients", F.array_join("recipients", "|"))


REPORTS_SQL = """SELECT 'exports/Relatório Ação ' || o_orderpriority || ' ' || o_orderkey || '.csv' AS storekey,
    '.csv' AS "exportFormat", 'u' || o_custkey || '@example.com|v@example.com' AS recipients,
    'Relatório Ação ' || o_orderpriority || ' ' || o_orderkey AS subject,
    lower(replace('Relatorio Acao ' || o_orderpriority || ' ' || o_orderkey, ' ', '_')) AS attachment,
    'Relatório Ação ' || o_orderpriority || ' ' || o_orderkey || '.csv' AS info FROM orders"""

# ---------------------------------------------------------------- inventory, charts, documents, feeds

ATTRIBUTES = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("site", T.StructType([T.StructField("city", T.StringType())]))]
)
DISCOVERY = T.StructType([T.StructField("ip", T.StringType()), T.StructField("model", T.StringType())])


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "customer").selectExpr(
        """to_json(named_struct('size', 1, 'payLoad', named_struct('nodes', array(named_struct(
            'attributes', named_struct('name', c_name, 'site', named_struct('city', concat('city-', c_nationkey))),
            'discoveryAttributes', named_struct('ip', concat('192.0.2.', c_custkey % 250), 'model', c_mktsegment)
        ))))) AS value"""
    )
    mapped = map_fields(
        inventory_rows(pages, ATTRIBUTES, DISCOVERY),
        {
            "device.name": "attributes.name",
            "device.city": "attributes.site.city",
            "device.rack": "attributes.rack.id",
            "net.ip": "discoveryAttributes.ip",
            "raw.*": "discoveryAttributes",
        },
        {"description": "nightly inventory", "domain": "access", "export_extra_data": True},
    )
    return mapped.select(
        F.col("device.name").alias("name"), F.col("device.city").alias("city"),
        F.col("device.rack").alias("rack"), F.col("net.ip").alias("ip"),
        F.col("raw.model").alias("raw_model"), "description", "domain", "export_extra_data",
    )


INVENTORY_SQL = """SELECT c_name AS name, 'city-' || c_nationkey AS city, CAST(NULL AS VARCHAR) AS rack,
    '192.0.2.' || (c_custkey % 250) AS ip, c_mktsegment AS raw_model, 'nightly inventory' AS description,
    'access' AS domain, true AS export_extra_data FROM customer"""


def charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart rows whose any column holds the tag."""
    landed = table(spark, sf_dir, "part").selectExpr(
        """to_json(named_struct('result', array(named_struct('data', array(
            named_struct('chart_id', p_partkey, 'chart_name', p_name, 'dashboard_name', p_brand),
            named_struct('chart_id', -p_partkey, 'chart_name', p_type, 'dashboard_name', p_brand)
        ))))) AS value"""
    )
    rows = chart_rows(landed, T.StructType([
        T.StructField("chart_id", T.LongType()),
        T.StructField("chart_name", T.StringType()),
        T.StructField("dashboard_name", T.StringType()),
    ]))
    return rows.where(any_contains([F.col(c) for c in rows.columns], "12"))


CHARTS_SQL = """WITH r AS (
    SELECT p_partkey AS chart_id, p_name AS chart_name, p_brand AS dashboard_name FROM part
    UNION ALL SELECT -p_partkey, p_type, p_brand FROM part
)
SELECT * FROM r WHERE contains(CAST(chart_id AS VARCHAR), '12') OR contains(chart_name, '12')
    OR contains(dashboard_name, '12')"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index documents with their own date field, as ISO text or epoch milliseconds."""
    landed = table(spark, sf_dir, "events").selectExpr(
        f"""CASE event_id % 4
            WHEN 0 THEN to_json(named_struct('_index', 'alarms-2024', '_source',
                named_struct('RootTime', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), 'id', event_id)))
            WHEN 1 THEN to_json(named_struct('_index', 'score', '_source',
                named_struct('Custom Data', named_struct('End', unix_millis(cast(ts AS timestamp))), 'id', event_id)))
            WHEN 2 THEN to_json(named_struct('_index', 'alarms-old', '_source',
                named_struct('RootTime', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), 'id', event_id)))
            ELSE to_json(named_struct('_index', 'other', '_source', named_struct('id', event_id))) END AS value"""
    )
    out = index_documents(
        landed, {"alarms*": "RootTime", "score": "Custom Data.End"},
        datetime(2024, 1, 5), datetime(2024, 1, 25), ("alarms-old",),
    )
    return out.select("_index", "date", F.get_json_object("_source", "$.id").cast("long").alias("id"))


DOCUMENTS_SQL = """WITH e AS (SELECT *, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts)
    ELSE date_trunc('millisecond', ts) END AS d FROM events WHERE event_id % 4 < 2)
SELECT CASE event_id % 4 WHEN 0 THEN 'alarms-2024' ELSE 'score' END AS _index, d AS date, event_id AS id
FROM e WHERE d BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'"""


def parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = table(spark, sf_dir, "customer").selectExpr(
        """to_json(named_struct('d', array(named_struct('ID', c_custkey, 'AgentID', c_nationkey, 'Name', c_name,
            'Type', CASE WHEN c_custkey % 4 = 0 THEN 'Service' ELSE 'Element' END,
            'State', CASE WHEN c_custkey % 5 = 0 THEN 'Paused' ELSE 'Active' END,
            'Parameters', array(named_struct('pid', 1, 'text', c_mktsegment),
                named_struct('pid', 2, 'text', concat('n', c_nationkey))))))) AS value"""
    )
    kind = T.StructType([T.StructField("pid", T.IntegerType()), T.StructField("text", T.StringType())])
    return element_feeds(element_rows(landed, kind, "AgentID"), "AgentID")[1]


PARAMETERS_SQL = """WITH p AS (SELECT c_custkey AS "ID", CAST(c_nationkey AS BIGINT) AS "AgentID",
    unnest([{'pid': 1, 'text': c_mktsegment}, {'pid': 2, 'text': 'n' || c_nationkey}]) AS p
    FROM customer WHERE c_custkey % 4 <> 0 AND c_custkey % 5 <> 0)
SELECT "ID", "AgentID", p.pid AS pid, p.text AS text FROM p"""


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable messages and error records side by side."""
    landed = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """CASE WHEN event_id % 9 = 0 THEN concat('{"dn": ', event_id, ' oops') ELSE
            to_json(named_struct('dn', concat('dn-', user_id), 'vendorName', event_type)) END AS value""",
    )
    good, bad = split_malformed(landed, ELEMENT_MESSAGE, "collector-1")
    return good.select(
        "event_id", "dn", "vendorName", F.lit(None).cast("string").alias("erro"),
        F.lit(None).cast("string").alias("data"),
    ).unionByName(
        bad.select(
            "event_id", F.lit(None).cast("string").alias("dn"),
            F.lit(None).cast("string").alias("vendorName"), "erro", "data",
        )
    )


DEAD_LETTERS_SQL = """SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN 'dn-' || user_id END AS dn,
    CASE WHEN event_id % 9 <> 0 THEN event_type END AS "vendorName",
    CASE WHEN event_id % 9 = 0 THEN 'malformed JSON' END AS erro,
    CASE WHEN event_id % 9 = 0 THEN '{"dn": ' || event_id || ' oops' END AS data FROM events"""


def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text forms of null and boolean read as values."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"{pick('event_id', ['None', 'x', 'y'])} AS a",
        f"{pick('event_id', ['True', 'False', 'None', 'other'])} AS b",
    )
    flag = literal_boolean(F.col("b"))
    return rows.select(
        "event_id", literal_text(F.col("a")).alias("a"), flag.cast("string").alias("b")
    )


NORMALISED_SQL = f"""SELECT event_id, nullif({pick('event_id', ['None', 'x', 'y'])}, 'None') AS a,
    CASE event_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS b FROM events"""


def sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scope of a query read back from its text."""
    texts = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        """concat('SELECT min(__time) FROM "t" WHERE "metricId" IN (\\'k', o_orderkey % 9, '\\', \\'k', o_custkey % 9,
            '\\') AND "managedObjectId" = \\'mo-', o_custkey % 3, '\\' AND __time BETWEEN TIME_PARSE(\\'',
            date_format(o_orderdate, 'yyyy-MM-dd'), '\\') AND TIME_PARSE(\\'2024-01-01\\')',
            CASE WHEN o_orderkey % 2 = 0 THEN ' AND ARRAY_OVERLAP("networkGroups", ARRAY [\\'g1\\',\\'g2\\'])' ELSE '' END) AS q""",
    )
    q = F.col("q")
    return texts.select(
        "o_orderkey",
        F.array_join(quoted_list(q, "metricId"), "|").alias("metrics"),
        quoted_equals(q, "managedObjectId").alias("managed_object"),
        F.array_join(quoted_times(q), "|").alias("times"),
        F.array_join(bracketed_lists(q), "|").alias("groups"),
    )


SQL_TEXT_SQL = """SELECT o_orderkey, 'k' || (o_orderkey % 9) || '|k' || (o_custkey % 9) AS metrics,
    'mo-' || (o_custkey % 3) AS managed_object, strftime(o_orderdate, '%Y-%m-%d') || '|2024-01-01' AS times,
    CASE WHEN o_orderkey % 2 = 0 THEN '''g1'',''g2''' ELSE '' END AS groups FROM orders"""


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """SELECT event_type AS metricId, count(*) AS n, round(max(value), 6) AS top
        FROM {facts} WHERE ts > cast(:start AS timestamp_ntz) GROUP BY event_type"""
    facts = table(spark, sf_dir, "events")
    return run_stored_query(spark, text, datetime(2024, 1, 12, 6), {"facts": facts})


STORED_SQL = """SELECT event_type AS "metricId", count(*) AS n, round(max(value), 6) AS top FROM events
WHERE ts > TIMESTAMP '2024-01-12 06:00:00' GROUP BY event_type"""

QUERIES = {
    "flatten_thresholds": Query(thresholds_flat, _FLAT_CTE + " SELECT * FROM flat"),
    "threshold_config_load": Query(config_load, CONFIG_LOAD_SQL),
    "supergroup_expand": Query(supergroups, SUPERGROUP_SQL),
    "flatten_busyhours": Query(busy_hours_flat, BUSY_HOURS_SQL),
    "promql_rows": Query(vectors, VECTORS_SQL),
    "query_log_parse": Query(logs, LOGS_SQL),
    "alert_rows": Query(alerts, ALERTS_SQL),
    "report_requests": Query(reports, REPORTS_SQL),
    "inventory_mapping": Query(inventory, INVENTORY_SQL),
    "chart_rows_tagged": Query(charts, CHARTS_SQL),
    "index_documents": Query(documents, DOCUMENTS_SQL),
    "parameter_feed": Query(parameters, PARAMETERS_SQL),
    "dead_letters": Query(dead_letters, DEAD_LETTERS_SQL),
    "text_normalisation": Query(normalised, NORMALISED_SQL),
    "sql_text_scope": Query(sql_text, SQL_TEXT_SQL),
    "parametrised_sql": Query(stored, STORED_SQL),
}
