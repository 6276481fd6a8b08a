"""Quality, status and enrichment queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemeter.functions.timeutil import floor_minutes
from wavemeter.model import TIME
from wavemeter.operators.enrich import (
    active_rows,
    address_rows,
    dimension_table,
    inventory_match,
    lookup,
    own_or_enriched_id,
    seen_recently,
    volume_by_dimension,
    wide_agg,
    WIDE_KEYS,
)
from wavemeter.operators.predicates import split_time_outliers
from wavemeter.operators.quality import (
    candidate_range,
    compaction_candidates,
    completeness,
    missing_sources,
    reconcile,
    repair,
)
from wavemeter.operators.rollup import rollup_temporal
from wavemeter.operators.status import (
    absent_devices,
    collector_status,
    element_status,
    expire,
    last_seen,
    live_elements,
    upsert,
)
from wavemeter.plans.fixtures import METRICS_SQL, VALUED_SQL, Query, metrics, r6, table

# ---------------------------------------------------------------- reconciliation


def _damaged(facts: DataFrame) -> DataFrame:
    """15-minute roll-up that lost the ``view`` metric of every 05:00 hour."""
    rolled = rollup_temporal(facts, "15m", sketch=False)
    return rolled.where(~((F.hour(TIME) == 5) & (F.col("metricId") == "view")))


def reconciled(by_rate: bool = False):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        facts = metrics(spark, sf_dir)
        return reconcile(facts, _damaged(facts), "15m", by_rate=by_rate)

    return run


def reconciled_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = metrics(spark, sf_dir)
    hourly = rollup_temporal(_damaged(facts), "hourly", sketch=False)
    return reconcile(facts, hourly, "hourly", cadence=300)


def _reconcile_sql(raw: str, where: str, minutes: int = 15) -> str:
    return f"""WITH {VALUED_SQL}, a AS (
    SELECT time_bucket(INTERVAL {minutes} MINUTE, __time) AS t, count(*) AS n FROM {raw}
    WHERE reportInterval = 300 AND {where} GROUP BY 1
), b AS (
    SELECT time_bucket(INTERVAL {minutes} MINUTE, __time) AS t, count(*) AS n FROM v
    WHERE reportInterval = 300 AND NOT (hour(__time) = 5 AND metricId = 'view') GROUP BY 1
)
SELECT coalesce(a.t, b.t) AS __time, coalesce(a.n, 0) AS raw_count, coalesce(b.n, 0) AS rolled_count,
    abs(coalesce(a.n, 0) - coalesce(b.n, 0)) AS difference
FROM a FULL JOIN b ON a.t = b.t WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)"""


def repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = metrics(spark, sf_dir)
    fixed = repair(facts, _damaged(facts), "15m", lambda df: rollup_temporal(df, "15m", sketch=False))
    return fixed.select(
        TIME, "dn", "metricId", "isRate", "pollingRuleId", "count", r6("sum_value"), r6("max_value")
    )


REPAIRED_SQL = f"""WITH {VALUED_SQL}
SELECT time_bucket(INTERVAL 15 MINUTE, __time) AS __time, dn, metricId, isRate, pollingRuleId,
    count(*) AS count, round(sum(value), 6) AS sum_value, round(max(value), 6) AS max_value
FROM v WHERE reportInterval = 300 GROUP BY ALL"""

# ---------------------------------------------------------------- gaps and outliers


def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = table(spark, sf_dir, "orders").selectExpr(
        "concat('f-', o_orderkey) AS managerFilename", "o_orderpriority AS type",
        "o_orderdate AS mtime",
    )
    facts = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('f-', l_orderkey) AS managerFilename", "l_shipdate AS __time"
    )
    return missing_sources(listing, facts, datetime(2000, 1, 1), days_back=1096)


MISSING_SQL = """SELECT 'f-' || o_orderkey AS "managerFilename", o_orderpriority AS type,
    o_orderdate AS mtime FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey
    AND l_shipdate >= TIMESTAMP '1996-12-31' AND l_shipdate < TIMESTAMP '2000-01-01')"""


def outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with some clocks 400 days ahead and some 1000 days behind, set aside again."""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE event_id % 997 WHEN 0 THEN ts + INTERVAL 400 DAYS WHEN 1 THEN ts - INTERVAL 1000 DAYS"
        " ELSE ts END AS __time",
    )
    clean, bad = split_time_outliers(events, datetime(2024, 1, 31))
    return (
        clean.withColumn("part", F.lit("clean"))
        .unionByName(bad.withColumn("part", F.lit("quarantine")))
    )


OUTLIERS_SQL = """WITH e AS (SELECT event_id, CASE event_id % 997 WHEN 0 THEN ts + INTERVAL 400 DAY
    WHEN 1 THEN ts - INTERVAL 1000 DAY ELSE ts END AS __time FROM events)
SELECT event_id, __time, CASE WHEN __time >= TIMESTAMP '2024-02-01' OR __time <= TIMESTAMP '2022-01-01'
    THEN 'quarantine' ELSE 'clean' END AS part FROM e"""

CHUNK_LIMIT = 14
MONTH = (datetime(2024, 1, 1), datetime(2024, 2, 1))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction_candidates(
        metrics(spark, sf_dir), floor_minutes(TIME, 60), CHUNK_LIMIT, *MONTH
    )


_CANDIDATES_SQL = f"""SELECT date_trunc('hour', ts) AS chunk, count(*) AS rows FROM events
    WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'
    GROUP BY 1 HAVING count(*) < {CHUNK_LIMIT}"""
CANDIDATES_SQL = f"SELECT CAST(chunk AS TIMESTAMP) AS chunk, rows FROM ({_CANDIDATES_SQL})"
CANDIDATE_RANGE_SQL = f"""SELECT CAST(min(chunk) AS DATE) AS first_day, CAST(max(chunk) AS DATE) AS last_day,
    count(*) AS chunks FROM ({_CANDIDATES_SQL})"""

# ---------------------------------------------------------------- completeness

GATE_DAY = datetime(2024, 1, 21)


def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = (
        metrics(spark, sf_dir)
        .groupBy(
            F.col("metricId").alias("kpi_id"),
            F.col("managedObjectId").alias("managedobject_id"),
            F.col("granularityInterval").alias("granularityinterval"),
            F.lit("DAY").alias("aggregation_time"),
            F.to_date(TIME).alias("day"),
        )
        .agg(F.count(F.lit(1)).alias("records"))
    )
    history = daily.where(F.col("day") < F.lit(GATE_DAY.date()))
    today = daily.where(F.col("day") == F.lit(GATE_DAY.date())).drop("day")
    # A scope that is silent on the day has history alone and must be judged all the same.
    return completeness(today.where("managedobject_id != 'mo-1'"), history.drop("day"), 95)


GATE_SQL = f"""WITH {METRICS_SQL}, d AS (
    SELECT metricId AS kpi_id, managedObjectId AS managedobject_id, granularityInterval AS granularityinterval,
        CAST(__time AS DATE) AS day, count(*) AS records FROM m GROUP BY ALL
), h AS (
    SELECT kpi_id, managedobject_id, granularityinterval, quantile_cont(records, 0.5) AS med
    FROM d WHERE day < DATE '2024-01-21' GROUP BY ALL
), t AS (
    SELECT * FROM d WHERE day = DATE '2024-01-21' AND managedobject_id <> 'mo-1'
), x AS (
    SELECT kpi_id, managedobject_id, granularityinterval, coalesce(records, 0) AS records,
        CAST(round_even(coalesce(med, 0) * 0.95, 0) AS BIGINT) AS acceptable
    FROM h FULL JOIN t USING (kpi_id, managedobject_id, granularityinterval)
)
SELECT kpi_id, managedobject_id, granularityinterval, 'DAY' AS aggregation_time, records, acceptable,
    CASE WHEN records >= acceptable AND records > 0 THEN 'LOAD' ELSE 'PARTIAL' END AS status,
    CASE WHEN records >= acceptable AND records > 0 THEN 'Completed' ELSE 'Partial' END AS load_status
FROM x"""

# ---------------------------------------------------------------- collector and element status

STATE_AT, NOW = datetime(2024, 1, 20), datetime(2024, 1, 28, 12)


def _devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Element and metric together, so that some devices are silent in any two days.
    return metrics(spark, sf_dir).withColumn("additionalDn", F.concat_ws("/", "dn", "metricId"))


def _before(facts: DataFrame, limit: datetime) -> DataFrame:
    return facts.where(F.col(TIME) < F.lit(limit.isoformat()).cast("timestamp_ntz"))


def collectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _devices(spark, sf_dir)
    previous = last_seen(_before(facts, STATE_AT), STATE_AT, full_load=True)
    current = last_seen(_before(facts, NOW), NOW, full_load=False)
    return collector_status(current, previous, NOW)


_COLLECTOR_CTE = f"""WITH {METRICS_SQL}, p AS (
    SELECT dn || '/' || metricId AS device, max(__time) AS t FROM m
    WHERE __time > TIMESTAMP '2024-01-13' AND __time < TIMESTAMP '2024-01-20' GROUP BY 1
), n AS (
    SELECT dn || '/' || metricId AS device, max(__time) AS t FROM m
    WHERE __time > TIMESTAMP '2024-01-26 12:00:00' AND __time < TIMESTAMP '2024-01-28 12:00:00' GROUP BY 1
)"""
COLLECTORS_SQL = f"""{_COLLECTOR_CTE}, x AS (
    SELECT coalesce(n.device, p.device) AS device, coalesce(n.t, p.t) AS "lastSeen", n.t AS seen,
        round((epoch_us(TIMESTAMP '2024-01-28 12:00:00') - epoch_us(coalesce(n.t, p.t))) / 3600000000.0, 3) AS h
    FROM n FULL JOIN p ON n.device = p.device
)
SELECT device, "lastSeen", h AS "offlineHours",
    CASE WHEN seen IS NOT NULL AND h <= 1 THEN 'ONLINE' ELSE 'OFFLINE' END AS status,
    TIMESTAMP '2024-01-28 12:00:00' AS dt_load FROM x"""


def absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _devices(spark, sf_dir)
    previous = last_seen(_before(facts, STATE_AT), STATE_AT, full_load=True)
    return absent_devices(last_seen(_before(facts, NOW), NOW, full_load=False), previous)


ABSENT_SQL = f"{_COLLECTOR_CTE} SELECT device FROM p WHERE device NOT IN (SELECT device FROM n)"


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element messages, some without vendor or manager."""
    return table(spark, sf_dir, "events").selectExpr(
        "ts AS __time",
        "event_id",
        "concat('dn-', user_id) AS dn",
        "concat('dev-', event_id % 10) AS additionalDn",
        "concat('sys-', event_type) AS sourceSystem",
        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('vn-', event_id % 3) END AS vendorName",
        "CASE WHEN event_id % 17 = 0 THEN NULL ELSE concat('192.0.2.', event_id % 8) END AS managerIp",
        "'CELL' AS elementType",
    )


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return element_status(messages(spark, sf_dir), (TIME, "event_id"))


ELEMENTS_CTE = """WITH e AS (
    SELECT 'dn-' || user_id AS dn, 'dev-' || (event_id % 10) AS "additionalDn", ts AS created_at,
        'sys-' || event_type AS "sourceSystem", 'CELL' AS "elementType",
        CASE WHEN event_id % 13 = 0 THEN 'não_informado' ELSE 'vn-' || (event_id % 3) END AS "vendorName",
        CASE WHEN event_id % 17 = 0 THEN 'não_informado' ELSE '192.0.2.' || (event_id % 8) END AS "managerIp",
        row_number() OVER (PARTITION BY user_id, event_id % 10 ORDER BY ts DESC, event_id DESC) AS rn
    FROM events
), s AS (SELECT * EXCLUDE (rn) FROM e WHERE rn = 1)"""
ELEMENTS_SQL = ELEMENTS_CTE + " SELECT * FROM s"


def expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expire(elements(spark, sf_dir), datetime(2024, 1, 30)).select(
        "dn", "additionalDn", "created_at", "ativo"
    )


EXPIRED_SQL = ELEMENTS_CTE + """ SELECT dn, "additionalDn", created_at,
    created_at >= TIMESTAMP '2024-01-29' AS ativo FROM s"""


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_elements(elements(spark, sf_dir), datetime(2024, 1, 30))


LIVE_SQL = ELEMENTS_CTE + " SELECT * FROM s WHERE created_at >= TIMESTAMP '2024-01-29'"


def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element state of the first half of January with the second half merged in."""
    landed = messages(spark, sf_dir)
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    state = element_status(landed.where(F.col(TIME) < middle), (TIME, "event_id"))
    news = element_status(landed.where(F.col(TIME) >= middle), (TIME, "event_id"))
    return upsert(state, news, ("dn", "additionalDn"))


# ---------------------------------------------------------------- enrichment


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Key/value lookups from nation, region and supplier."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    supplier = table(spark, sf_dir, "supplier")
    equipment = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).selectExpr(
        "concat('eq-', n_nationkey) AS id", "r_name AS network_type", "n_name AS device_type"
    )
    regions = region.selectExpr("concat('et-', r_regionkey) AS id", "r_name AS name")
    # Shifted by one, so that vendor vd-0 and object mo-0 have no entry.
    vendors = supplier.selectExpr("concat('vd-', s_suppkey + 1) AS id", "s_name AS name")
    objects = region.selectExpr("concat('mo-', r_regionkey + 1) AS id", "r_name AS name")
    kinds = table(spark, sf_dir, "events").select(F.col("event_type").alias("id")).distinct()
    return {
        "equipment": dimension_table(equipment, "id", ("network_type", "device_type")),
        "equipment_type": dimension_table(regions, "id", ("name",)),
        "vendor": dimension_table(vendors, "id", ("name",)),
        "managed_object": dimension_table(objects, "id", ("name",)),
        "metric": dimension_table(kinds.withColumn("name", F.upper("id")), "id", ("name",)),
    }


def volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume_by_dimension(
        metrics(spark, sf_dir), tables(spark, sf_dir), "mo-0",
        {"tipo_de_rede": "network_type", "tipo_device": "device_type"}, "SNMP",
    )


_EQUIPMENT_SQL = """eqp AS (
    SELECT 'eq-' || n_nationkey AS id, r_name AS network_type, n_name AS device_type
    FROM nation JOIN region ON n_regionkey = r_regionkey)"""
_OWN_SQL = """CASE WHEN m."managedObjectId" = 'mo-0' THEN m."equipmentId"
    ELSE json_extract_string(enrichment, '$.topology."mo-0"') END"""
VOLUMES_SQL = f"""WITH {METRICS_SQL}, {_EQUIPMENT_SQL}
SELECT 'SNMP' AS fonte, CAST(date_trunc('hour', __time) AS TIMESTAMP) AS __time, t.r_name AS "Eq_Type",
    o.r_name AS "MO", s_name AS vendor, "additionalDn", "reportInterval", network_type AS tipo_de_rede,
    device_type AS tipo_device, upper(m."metricId") AS name_lookup, count(*) AS count
FROM m LEFT JOIN region t ON m."equipmentTypeId" = 'et-' || t.r_regionkey
    LEFT JOIN region o ON m."managedObjectId" = 'mo-' || (o.r_regionkey + 1)
    LEFT JOIN supplier ON m."vendorId" = 'vd-' || (s_suppkey + 1)
    LEFT JOIN eqp ON eqp.id = {_OWN_SQL}
GROUP BY ALL"""


def conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = metrics(spark, sf_dir).select(
        TIME, "dn", "metricId", "managedObjectId", "equipmentId", "enrichment"
    )
    named = lookup(
        facts, tables(spark, sf_dir)["equipment"], "network_type", own_or_enriched_id("mo-0"),
        "network_type",
    )
    return named.drop("enrichment")


CONDITIONAL_SQL = f"""WITH {METRICS_SQL}, {_EQUIPMENT_SQL}
SELECT __time, dn, "metricId", "managedObjectId", "equipmentId", network_type
FROM m LEFT JOIN eqp ON eqp.id = {_OWN_SQL}"""


def _show_wide(df: DataFrame) -> DataFrame:
    plain = [k for k in WIDE_KEYS if k != "networkGroups"]
    return df.select(
        TIME, *plain, F.array_join("networkGroups", ",").alias("networkGroups"),
        "granularityInterval", r6("value_sum"), r6("value_max"), r6("value_min"), "value_count",
        F.array_join(F.transform("value_array", lambda v: F.round(v, 6).cast("decimal(20,6)")), ",").alias("listed"),
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_wide(wide_agg(metrics(spark, sf_dir)))


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = metrics(spark, sf_dir)
    now = datetime(2024, 1, 30, 12)
    recent = seen_recently(facts, now, minutes=24 * 60)
    return _show_wide(wide_agg(active_rows(facts, recent)))


def _wide_sql(where: str = "true") -> str:
    plain = ", ".join(f'"{k}"' for k in WIDE_KEYS if k != "networkGroups")
    return f"""WITH {METRICS_SQL}
SELECT time_bucket(INTERVAL 15 MINUTE, __time) - INTERVAL 3 HOUR AS __time, {plain},
    array_to_string("networkGroups", ',') AS "networkGroups", 900 AS "granularityInterval",
    round(sum(value), 6) AS value_sum, round(max(value), 6) AS value_max,
    round(min(value), 6) AS value_min, count(value) AS value_count,
    coalesce(string_agg(CAST(CAST(round(value, 6) AS DECIMAL(20,6)) AS VARCHAR), ',' ORDER BY value), '') AS listed
FROM m WHERE {where} GROUP BY ALL"""


STAMP = datetime(2024, 1, 30, 8)
ABSENT_MARKER = "n/a"
UNKNOWN_ADDRESS = "unknown"


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = table(spark, sf_dir, "customer").selectExpr(
        "c_name AS DEVICENAME",
        "c_mktsegment AS MODELO",
        "CASE WHEN c_custkey % 10 = 0 THEN 'unknown' WHEN c_custkey % 3 = 0"
        " THEN concat('192.0.2.', c_custkey, '; 192.0.2.', c_custkey % 40)"
        " ELSE concat('192.0.2.', c_custkey) END AS cleaned_ip",
    )
    discovered = table(spark, sf_dir, "supplier").selectExpr(
        "concat('192.0.2.', s_suppkey) AS IP", "s_name AS Name",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'UP' END AS Status",
    )
    return inventory_match(
        address_rows(inventory, "cleaned_ip", UNKNOWN_ADDRESS), discovered,
        {"DEVICENAME": "inventory_device", "MODELO": "inventory_model"},
        {"Name": "discovered_name", "Status": "discovered_status"}, STAMP, ABSENT_MARKER,
    )


MATCHED_SQL = """WITH i AS (
    SELECT c_name, c_mktsegment, CASE WHEN c_custkey % 3 = 0
        THEN ['192.0.2.' || c_custkey, '192.0.2.' || (c_custkey % 40)]
        ELSE ['192.0.2.' || c_custkey] END AS ips FROM customer WHERE c_custkey % 10 <> 0
), u AS (SELECT c_name, c_mktsegment, unnest(ips) AS ip FROM i)
SELECT ip AS "IP", c_name AS inventory_device, c_mktsegment AS inventory_model,
    coalesce(s_name, 'n/a') AS discovered_name,
    coalesce(CASE WHEN s_suppkey % 2 = 0 THEN 'UP' END, 'n/a') AS discovered_status,
    TIMESTAMP '2024-01-30 08:00:00' AS processing_date
FROM u LEFT JOIN supplier ON ip = '192.0.2.' || s_suppkey"""

QUERIES = {
    "rollup_reconcile": Query(reconciled(), _reconcile_sql("v", "true")),
    "rollup_reconcile_hourly": Query(reconciled_hourly, _reconcile_sql("v", "true", 60)),
    "rollup_reconcile_rate_rows": Query(
        reconciled(True),
        _reconcile_sql("m", "CASE WHEN isRate THEN denominator <> 0 ELSE true END"),
    ),
    "rollup_repair": Query(repaired, REPAIRED_SQL),
    "missing_sources": Query(missing, MISSING_SQL),
    "time_outliers": Query(outliers, OUTLIERS_SQL),
    "compaction_candidates": Query(_candidates, CANDIDATES_SQL),
    "compaction_range": Query(
        lambda spark, sf_dir: candidate_range(_candidates(spark, sf_dir)), CANDIDATE_RANGE_SQL
    ),
    "completeness_gate": Query(gate, GATE_SQL),
    "collector_status": Query(collectors, COLLECTORS_SQL),
    "collector_absent": Query(absent, ABSENT_SQL),
    "element_status": Query(elements, ELEMENTS_SQL),
    "element_expiry": Query(expired, EXPIRED_SQL),
    "element_live": Query(live, LIVE_SQL),
    "element_upsert": Query(upserted, ELEMENTS_SQL),
    "volume_by_dimension": Query(volumes, VOLUMES_SQL),
    "conditional_lookup": Query(conditional, CONDITIONAL_SQL),
    "wide_15m_values": Query(wide, _wide_sql()),
    "active_elements_agg": Query(
        active, _wide_sql("dn IN (SELECT dn FROM m WHERE __time >= TIMESTAMP '2024-01-29 12:00:00')")
    ),
    "inventory_match": Query(matched, MATCHED_SQL),
}
