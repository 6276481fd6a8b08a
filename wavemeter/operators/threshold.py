"""Config-driven threshold evaluation.

All thresholds of a run share one plan: facts meet the config on KPI, object and
granularity, the window of a fact follows from its own time, and two combinable
aggregations apply the temporal function per element and the spatial function per slice.
A range of runs (backfill) costs one pass, not one pass per run.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemeter.functions.scalars import clean_dn, spatial_dn
from wavemeter.functions.timeutil import (
    day_numbers,
    day_start,
    days_interval,
    epoch_millis,
    floor_minutes,
    hour_start,
    hour_numbers,
    in_hours,
    minutes_interval,
    month_shift,
    month_start,
    on_days,
    period_tag,
    previous_period_bounds,
    ts_lit,
    week_start,
    zone_offset_minutes,
)
from wavemeter.model import TIME
from wavemeter.operators.chosen import aggregate_by_name
from wavemeter.operators.joins import BROADCAST_BYTES, ROW_BYTES, broadcast_if_small, row_bytes
from wavemeter.operators.predicates import any_shared, rate_value

ELEMENT = ("dn", "additionalDn", "elementType", "vendorId", "equipmentId", "locationId")
THRESHOLD = ("node_id", "kpi_id")
WINDOW = ("window_start", "window_end")

# Algorithms whose results carry earlier windows along; the first takes its
# number of look-backs from the config, the others have one.
HISTORY_ALGORITHM = "AVERAGE_HISTORICAL_VALUE"
SINGLE_LOOK_BACK = ("HISTORICAL_VALUE", "SLOPE_COMPARATION")

# Minutes a 5-minute evaluation lags behind its run time, per generation of
# the evaluation.
SOURCE_DELAY_MINUTES = {"current": 10, "earlier": 180}


def present(col: str) -> Column:
    """Column with the text ``null`` read as a missing value."""
    return F.when(F.lower(F.col(col)) != "null", F.col(col))


def thresholds_for(cfg: DataFrame, column: str, grain: str) -> DataFrame:
    """Config rows of a grain; for the granularity column only rows without a time grain."""
    rows = cfg.where(F.upper(F.col(column)) == grain)
    if column == "dataAggregationTimeGranularity":
        time_grain = F.upper(F.coalesce(present("dataAggregationTime"), F.lit("NONE")))
        rows = rows.where(time_grain == "NONE")
    return rows


def effective_groups() -> Column:
    """Groups a threshold is limited to: the children when every association is a super-group."""
    all_super = (F.size("typeAssociation") > 0) & F.forall(
        "typeAssociation", lambda t: t == "SUPERGROUP"
    )
    return F.when(F.coalesce(all_super, F.lit(False)), F.col("id_ngInclusion_SG")).otherwise(
        F.col("id_ngInclusion")
    )


def time_function() -> Column:
    """Configured function, or for ``DEFAULT`` the one the KPI prescribes for the grain."""
    grain = F.upper(F.col("dataAggregationTime"))
    default = (
        F.when(grain == "HOUR", F.col("kpi_hourly"))
        .when(grain == "DAY", F.col("kpi_daily"))
        .when(grain == "WEEK", F.col("kpi_weekly"))
        .when(grain == "MONTH", F.col("kpi_monthly"))
        .when(grain == "YEAR", F.col("kpi_yearly"))
    )
    configured = F.upper(present("dataAggregationFunction"))
    return F.when(configured == "DEFAULT", F.upper(default)).otherwise(configured)


def time_percentile() -> Column:
    grain = F.upper(F.col("dataAggregationTime"))
    default = (
        F.when(grain == "HOUR", F.col("hourlyPercentile"))
        .when(grain == "DAY", F.col("dailyPercentile"))
        .when(grain == "WEEK", F.col("weeklyPercentile"))
        .when(grain == "MONTH", F.col("monthlyPercentile"))
        .when(grain == "YEAR", F.col("yearlyPercentile"))
    )
    is_default = F.upper(F.col("dataAggregationFunction")) == "DEFAULT"
    return F.coalesce(
        F.when(is_default, default).otherwise(F.col("dataAggregationPercentileValue")), F.lit(0.0)
    ).cast("double")


def spatial_function() -> Column:
    by_slice = F.upper(F.coalesce(present("spatialAggregation"), F.lit("NONE"))) != "NONE"
    return F.when(by_slice, F.upper(present("spatialAggregationFunction")))


def prepared(cfg: DataFrame, *extra: str) -> DataFrame:
    """The columns an evaluation needs from the config, and ``extra`` ones as they are."""
    granularity = F.coalesce(
        present("dataAggregationTimeGranularity"), F.col("kpi_defaultTimeGranularity")
    )
    options = F.when(F.col("effectiveDays") == "PERIODDAYS", F.col("optionsDays"))
    return cfg.select(
        *THRESHOLD,
        "managedObject_id",
        period_tag(granularity).alias("tag"),
        effective_groups().alias("groups"),
        F.col("equipmentInclusion").alias("only_dn"),
        time_function().alias("time_function"),
        time_percentile().alias("time_percentile"),
        spatial_function().alias("spatial_function"),
        F.coalesce("spatialAggregationPercentileValue", F.lit(0.0))
        .cast("double")
        .alias("spatial_percentile"),
        F.upper(F.coalesce(present("spatialAggregation"), F.lit("NONE"))).alias("level"),
        "spatialLocationTypeAggregation",
        "id_spatialManagedObjectAggregation",
        F.coalesce("kpi_isRate", F.lit(False)).alias("kpi_rate"),
        (F.col("kpi_unit") == "Percentage").alias("percentage"),
        hour_numbers(F.col("effectiveHours")).alias("hours"),
        day_numbers(options).alias("days"),
        zone_offset_minutes(F.col("timeZone")).alias("offset_minutes"),
        *extra,
    )


@dataclass(frozen=True)
class ConfigFacts:
    """What an evaluation has to know about its config before it builds the plan."""

    index_bytes: int
    back_bytes: int
    kinds: frozenset[str]
    time_functions: frozenset[str]
    spatial_functions: frozenset[str]
    furthest_minutes: int

    @property
    def broadcastable(self) -> bool:
        """Whether the index of the config may be broadcast."""
        return self.index_bytes <= BROADCAST_BYTES

    @property
    def backs_broadcastable(self) -> bool:
        """Whether one row per config row and look-back may be broadcast."""
        return self.back_bytes <= BROADCAST_BYTES


def config_facts(cfg: DataFrame, minutes: int | None = None) -> ConfigFacts:
    """One small job over the config; ``minutes`` adds the look-backs of a spatial run."""
    backs = F.array(F.lit(0)) if minutes is None else look_backs(minutes)
    ready = prepared(cfg.withColumn("__backs", backs), "__backs")
    payload = [c for c in ready.columns if c not in ("only_dn", "__backs")]
    found = ready.agg(
        F.sum(F.size(spots()) * row_bytes(*payload)),
        F.sum(F.size("__backs") * 4 * ROW_BYTES),
        F.collect_set(scope_kind()),
        F.collect_set("time_function"),
        F.collect_set("spatial_function"),
        F.max(F.array_max("__backs")),
    ).first()
    return ConfigFacts(
        found[0] or 0, found[1] or 0, frozenset(found[2]), frozenset(found[3]), frozenset(found[4]), found[5] or 0
    )


# Fields of a published record that describe the facts behind it.
DESCRIPTION = (
    "networkType", "category", "subcategory", "familyId", "familyName", "metricType", "technology",
    "domain", "equipmentTypeId", "equipmentType",
)


def _facts(metrics: DataFrame, start: datetime, end: datetime) -> DataFrame:
    described = [c for c in DESCRIPTION if c in metrics.columns]
    return metrics.where((F.col(TIME) >= ts_lit(start)) & (F.col(TIME) < ts_lit(end))).select(
        TIME, "metricId", "managedObjectId", "granularityInterval", *ELEMENT, "networkGroups",
        "enrichment", "value", "numerator", "denominator", *described,
    )


# How a threshold is limited: to elements, else to groups, else not at all.
BY_DN, BY_GROUP, EVERYWHERE = "dn", "group", "any"


def scope_kind() -> Column:
    """The limit of a config row that its index is made of."""
    return (
        F.when(F.coalesce(F.size("only_dn") > 0, F.lit(False)), F.lit(BY_DN))
        .when(F.coalesce(F.size("groups") > 0, F.lit(False)), F.lit(BY_GROUP))
        .otherwise(F.lit(EVERYWHERE))
    )


def _named(kind: str, names: Column) -> Column:
    return F.transform(F.array_distinct(F.array_compact(names)), lambda n: F.concat(F.lit(f"{kind}:"), n))


def spots() -> Column:
    """Where a config row applies: one entry per element or group it is limited to, or one for all."""
    kind = scope_kind()
    return (
        F.when(kind == BY_DN, _named(BY_DN, F.col("only_dn")))
        .when(kind == BY_GROUP, _named(BY_GROUP, F.col("groups")))
        .otherwise(F.array(F.lit(EVERYWHERE)))
    )


def _fact_spots(kinds: frozenset[str]) -> Column:
    """Entries of the index a fact can meet, of the kinds the config has."""
    parts = [F.array(F.lit(EVERYWHERE))] if EVERYWHERE in kinds else []
    if BY_DN in kinds:
        parts.append(_named(BY_DN, F.array("dn")))
    if BY_GROUP in kinds:
        parts.append(F.coalesce(_named(BY_GROUP, F.col("networkGroups")), F.array().cast("array<string>")))
    return F.concat(*parts)


def scoped(facts: DataFrame, cfg: DataFrame, known: ConfigFacts) -> DataFrame:
    """Facts in the scope of each threshold: KPI, object, granularity, groups and elements.

    The config is an index with a row per element or group a threshold is limited to, so every
    limit is an equal key of the join, however long the lists are. The index is broadcast when its
    bytes allow, and joins by shuffle otherwise.
    """
    index = cfg.withColumns({"__kind": scope_kind(), "__spot": F.explode(spots())}).drop("only_dn")
    met = facts
    spot = F.lit(EVERYWHERE)
    if known.kinds - {EVERYWHERE}:
        met = facts.withColumn("__at", F.explode(_fact_spots(known.kinds)))
        spot = F.col("__at")
    on = (
        (met["metricId"] == index["kpi_id"])
        & (met["managedObjectId"] == index["managedObject_id"])
        & (met["granularityInterval"] == index["tag"])
        & (spot == index["__spot"])
    )
    side = F.broadcast(index) if known.broadcastable else index
    joined = met.join(side, on, "inner")
    if known.kinds - {EVERYWHERE}:
        # Rows that met: a fact counts once for a threshold, by the first of its groups that does, and an
        # element list may be limited to groups as well.
        first = F.element_at(_named(BY_GROUP, F.array_intersect("networkGroups", "groups")), 1)
        unlimited = F.coalesce(F.size("groups") == 0, F.lit(True))
        joined = joined.where(
            F.when(F.col("__kind") == BY_GROUP, F.col("__spot") == first)
            .when(F.col("__kind") == BY_DN, unlimited | any_shared(F.col("networkGroups"), F.col("groups")))
            .otherwise(F.lit(True))
        )
    return joined.drop("__at", "__spot", "__kind")


def _in_options(rows: DataFrame) -> DataFrame:
    return rows.where(
        in_hours(F.col(TIME), F.col("hours")) & on_days(F.col(TIME), F.col("days"))
    )


def _valued(rows: DataFrame) -> DataFrame:
    return rows.withColumn("value", rate_value("kpi_rate"))


def with_slices(rows: DataFrame) -> DataFrame:
    """Slice of every fact: location or topology name, one row per network group, or none."""
    location = F.call_function(
        "get_json_object", F.col("enrichment"),
        F.concat(F.lit("$.location."), F.col("spatialLocationTypeAggregation")),
    )
    topology = F.call_function(
        "get_json_object", F.col("enrichment"),
        F.concat(F.lit("$.topology."), F.col("id_spatialManagedObjectAggregation")),
    )
    wanted = F.when(
        F.coalesce(F.size("groups"), F.lit(0)) > 0,
        F.array_intersect("networkGroups", "groups"),
    ).otherwise(F.col("networkGroups"))
    single = F.array(
        F.when(F.col("level") == "BY_LOCATION", location).when(
            F.col("level") == "BY_TOPOLOGY", topology
        )
    )
    # Rows by group without a group have no slice and drop out of the explode.
    slices = F.when(F.col("level") == "BY_GROUP", F.array_compact(wanted)).otherwise(single)
    return rows.withColumn("slice", F.explode(slices)).drop("networkGroups", "enrichment")


def period_of(ts: Column, grain: str) -> tuple[Column, Column]:
    """Calendar window that holds ``ts``, half-open."""
    if grain == "HOUR":
        start = hour_start(ts)
        return start, start + minutes_interval(60)
    if grain == "DAY":
        start = day_start(ts)
        return start, start + days_interval(1)
    if grain == "WEEK":
        start = week_start(ts)
        return start, start + days_interval(7)
    first = month_start(ts)
    following = month_shift(first, 1)
    if grain == "MONTH":
        return first, following
    if grain == "FITTEEN_DAYS":
        middle = first + days_interval(15)
        early = F.dayofmonth(ts) <= 15
        return F.when(early, first).otherwise(middle), F.when(early, middle).otherwise(following)
    if grain == "YEAR":
        january = F.date_trunc("YEAR", ts).cast("timestamp_ntz")
        return january, month_shift(january, 12)
    raise ValueError(f"unknown grain {grain!r}")


def temporal_scope(
    metrics: DataFrame, cfg: DataFrame, grain: str, start: datetime, end: datetime,
    known: ConfigFacts | None = None,
) -> DataFrame:
    """Scoped facts with their window; windows whose local start lies in ``[start, end)``.

    Windows other than hours follow the time zone of the threshold.
    """
    slack = timedelta(0) if grain == "HOUR" else timedelta(hours=14)
    known = known or config_facts(cfg)
    rows = scoped(_facts(metrics, start - slack, end + slack), prepared(cfg), known)
    offset = F.lit(0) if grain == "HOUR" else F.col("offset_minutes")
    shift = minutes_interval(offset)
    window_start, window_end = period_of(F.col(TIME) + shift, grain)
    return (
        rows.withColumn("__local", window_start)
        .withColumn("window_start", window_start - shift)
        .withColumn("window_end", window_end - shift)
        .where((F.col("__local") >= ts_lit(start)) & (F.col("__local") < ts_lit(end)))
        .drop("__local")
    )


def _percent(df: DataFrame, value: str) -> DataFrame:
    scale = F.when(F.col("kpi_rate") & F.coalesce("percentage", F.lit(False)), 100.0).otherwise(1.0)
    return df.withColumn(value, F.col(value) * scale)


_RATE = ("kpi_rate", "numerator", "denominator")


def evaluate_temporal(
    metrics: DataFrame, cfg: DataFrame, grain: str, start: datetime, end: datetime
) -> DataFrame:
    """Temporal value per element, and per slice for thresholds that also aggregate in space.

    Both kinds go through the same second step: a slice gathers its elements, a purely
    temporal threshold keeps every element as a group of its own.
    """
    known = config_facts(cfg)
    in_time, in_space = known.time_functions, known.spatial_functions
    scope = temporal_scope(metrics, cfg, grain, start, end, known)
    rows = with_slices(_valued(_in_options(scope)))
    carried = ("level", "spatial_function", "spatial_percentile", "kpi_rate", "percentage")
    keys = [*THRESHOLD, *WINDOW, *carried, "slice", *ELEMENT]
    elements = aggregate_by_name(
        rows, keys, "time_function", "time_percentile", "value", "metric0", _RATE,
        functions=in_time,
    ).withColumnRenamed("records", "facts")
    alone = F.col("spatial_function").isNull()
    grouped = elements.withColumns(
        {
            "alone": alone,
            "spatial_function": F.coalesce("spatial_function", F.lit("MAX")),
            **{c: F.when(alone, F.col(c)) for c in ELEMENT},
        }
    )
    result = aggregate_by_name(
        grouped,
        [*THRESHOLD, *WINDOW, "alone", "level", "slice", "kpi_rate", "percentage", *ELEMENT],
        "spatial_function", "spatial_percentile", "metric0", "result",
        functions=in_space,
        sums=("facts",),
    )
    return _percent(result, "result").select(
        *THRESHOLD, *WINDOW,
        F.when(F.col("alone"), "temporal").otherwise("temporal-spatial").alias("aggregation"),
        "level", "slice", *ELEMENT,
        F.when(F.col("alone"), F.col("facts")).otherwise(F.col("records")).alias("records"),
        F.col("result").alias("metric0"),
    )


def evaluate_temporal_run(
    metrics: DataFrame, cfg: DataFrame, grain: str, run_ts: datetime
) -> DataFrame:
    """The last complete window before ``run_ts``."""
    return evaluate_temporal(metrics, cfg, grain, *previous_period_bounds(run_ts, grain))


def look_backs(minutes: int) -> Column:
    """Minutes each look-back of a config row lies before the evaluated window, 0 included.

    The first look-back lies ``int(comparison value)`` buckets back, each further one
    ``intervalDays`` days earlier, ``times`` look-backs in all. The comparison algorithms
    have one look-back, the others none.
    """
    configured = F.greatest(F.coalesce("times", F.lit(0)), F.lit(0))
    times = (
        F.when(F.col("algorithm") == HISTORY_ALGORITHM, configured)
        .when(F.col("algorithm").isin(*SINGLE_LOOK_BACK), F.lit(1))
        .otherwise(F.lit(0))
    )
    step = F.coalesce(F.col("algorithmComparisonValue").cast("int"), F.lit(0)) * F.lit(minutes)
    days = F.coalesce(F.col("intervalDays").cast("int"), F.lit(0))
    return F.array_distinct(
        F.transform(
            F.sequence(F.lit(0), times.cast("int")),
            lambda i: F.when(i == 0, F.lit(0)).otherwise(step + (i - 1) * days * F.lit(1440)),
        )
    )


def spatial_scope(
    metrics: DataFrame, cfg: DataFrame, minutes: int, start: datetime, end: datetime,
    known: ConfigFacts | None = None,
) -> DataFrame:
    """Scoped facts with their bucket, for runs in ``[start, end)`` and what they look back at."""
    known = known or config_facts(cfg, minutes)
    ready = prepared(
        cfg.withColumn("furthest", F.array_max(look_backs(minutes))), "furthest"
    )
    facts = _facts(metrics, start - timedelta(minutes=known.furthest_minutes), end)
    return (
        scoped(facts, ready, known)
        .withColumn("window_start", floor_minutes(TIME, minutes))
        .withColumn("window_end", F.col("window_start") + minutes_interval(minutes))
        .where(F.col("window_start") + minutes_interval(F.col("furthest")) >= ts_lit(start))
    )


def served_runs(
    windows: DataFrame, cfg: DataFrame, minutes: int, start: datetime, end: datetime,
    known: ConfigFacts,
) -> DataFrame:
    """One row per window and run in ``[start, end)`` that uses it, named by ``run_start``.

    A window serves the run of its own bucket and those that look back at it. Only finished
    results are repeated, so the facts behind a window are aggregated once.
    """
    backs = cfg.select(*THRESHOLD, F.explode(look_backs(minutes)).alias("__back"))
    side = F.broadcast(backs) if known.backs_broadcastable else backs
    return (
        windows.join(side, list(THRESHOLD))
        .withColumn("run_start", F.col("window_start") + minutes_interval(F.col("__back")))
        .where((F.col("run_start") >= ts_lit(start)) & (F.col("run_start") < ts_lit(end)))
        .drop("__back")
    )


def evaluate_spatial(
    metrics: DataFrame, cfg: DataFrame, minutes: int, start: datetime, end: datetime
) -> DataFrame:
    """Spatial value per slice for every N-minute bucket in ``[start, end)`` and look-back."""
    known = config_facts(cfg, minutes)
    rows = with_slices(
        _valued(_in_options(spatial_scope(metrics, cfg, minutes, start, end, known)))
    )
    keys = [*THRESHOLD, *WINDOW, "level", "slice", "kpi_rate", "percentage"]
    sliced = aggregate_by_name(
        rows.where(F.col("spatial_function").isNotNull()), keys,
        "spatial_function", "spatial_percentile", "value", "result", _RATE,
        functions=known.spatial_functions,
    )
    results = served_runs(_percent(sliced, "result"), cfg, minutes, start, end, known)
    return results.select(
        *THRESHOLD, "run_start", *WINDOW, F.lit("spatial").alias("aggregation"),
        "level", "slice", *[F.lit(None).cast("string").alias(c) for c in ELEMENT], "records",
        F.col("result").alias("metric0"),
    )


def spatial_run_bounds(
    run_ts: datetime, minutes: int, delay_minutes: int = 0
) -> tuple[datetime, datetime]:
    """Bucket a run at ``run_ts`` evaluates, after the delay of its source."""
    base = run_ts.replace(second=0, microsecond=0)
    end = base - timedelta(minutes=base.minute % minutes) - timedelta(minutes=delay_minutes)
    return end - timedelta(minutes=minutes), end


def record_range(scope: DataFrame, keys: tuple[str, ...] = (*THRESHOLD, "window_start")) -> DataFrame:
    """First and last fact time and number of facts per threshold scope, and what describes the facts.

    A descriptive field has a value where all facts of the scope that have one agree.
    """

    def shared(name: str) -> Column:
        return F.when(F.min(name) == F.max(name), F.max(name)).cast("string").alias(name)

    return scope.groupBy(*keys).agg(
        F.min(TIME).alias("min_record"),
        F.max(TIME).alias("max_record"),
        F.count(F.lit(1)).alias("records"),
        *[shared(c) for c in DESCRIPTION if c in scope.columns],
    )


# Field names of a published threshold record, in order.
RECORD_FIELDS = (
    "metricId", "code", "name", "networkType", "category", "subcategory", "familyId",
    "familyName", "metricType", "dn", "additionalDn", "technology", "cellName", "elementType",
    "beginTime", "endTime", "timestamp", "reportInterval", "granularityInterval", "vendorId",
    "equipmentId", "locationId", "sourceSystem", "domain", "managerIp", "managerFilename",
    "value", "numerator", "denominator", "enrichment", "equipmentTypeId", "equipmentType",
    "managedObjectId", "managedObject", "networkGroups", "processTime", "isRate", "aggregation",
    "load_status", "thresholdId", "aggregationLevel",
)


def alarm_records(
    result: DataFrame, ranges: DataFrame, cfg: DataFrame, report_interval: int, tag: str,
    process_ts: datetime,
) -> DataFrame:
    """Published record of every result row, joined to its own threshold and record range.

    Fields that describe the facts come from the range; those that the facts do not have are null. A pure spatial record ends one second before its interval does, others at their last
    fact. Sliced results carry a synthetic element name.
    """
    labels = cfg.select(
        *THRESHOLD,
        "kpi_name",
        F.coalesce("kpi_isRate", F.lit(False)).alias("isRate"),
        F.col("managedObject_id").alias("managedObjectId"),
        F.col("managedObject_name").alias("managedObject"),
        effective_groups().alias("networkGroups"),
        "load_status",
        F.col("spatialLocationTypeAggregation").alias("__location"),
        F.col("id_spatialManagedObjectAggregation").alias("__topology"),
    )
    at = [c for c in (*THRESHOLD, "run_start", "window_start") if c in ranges.columns]
    described = [c for c in DESCRIPTION if c in ranges.columns]
    spans = ranges.select(*at, "min_record", "max_record", *described)
    joined = result.join(broadcast_if_small(labels), list(THRESHOLD)).join(spans, at)
    begin = F.floor(epoch_millis(F.col("min_record")) / 1000)
    end = F.when(
        F.col("aggregation") == "spatial", begin + F.lit(report_interval - 1)
    ).otherwise(F.floor(epoch_millis(F.col("max_record")) / 1000))
    in_space = F.col("aggregation").contains("spatial")
    cell = (
        F.when(F.col("level") == "BY_LOCATION", F.col("__location"))
        .when(F.col("level") == "BY_TOPOLOGY", F.col("__topology"))
        .otherwise(F.lit(""))
    )

    def element(name: str) -> Column:
        return F.when(in_space, F.lit("")).otherwise(F.col(name))

    known = {
        "metricId": F.col("kpi_id"),
        "code": F.col("kpi_id"),
        "name": F.col("kpi_name"),
        "dn": F.when(
            in_space, spatial_dn(F.col("kpi_id"), F.col("kpi_name"), F.col("level"), F.col("slice"))
        ).otherwise(clean_dn(F.col("dn"))),
        "additionalDn": F.when(in_space, F.col("level")).otherwise(F.col("additionalDn")),
        "cellName": cell,
        "elementType": element("elementType"),
        "beginTime": begin * 1000,
        "endTime": end * 1000,
        "timestamp": begin * 1000,
        "reportInterval": F.lit(report_interval),
        "granularityInterval": F.lit(tag),
        "vendorId": element("vendorId"),
        "equipmentId": element("equipmentId"),
        "locationId": element("locationId"),
        "sourceSystem": F.lit(""),
        "managerIp": F.lit(""),
        "managerFilename": F.lit(""),
        "value": F.col("metric0"),
        "numerator": F.lit(""),
        "denominator": F.lit(""),
        "enrichment": F.create_map().cast("map<string,string>"),
        "managedObjectId": F.col("managedObjectId"),
        "managedObject": F.col("managedObject"),
        "networkGroups": F.coalesce("networkGroups", F.array().cast("array<string>")),
        "processTime": epoch_millis(ts_lit(process_ts)),
        "isRate": F.col("isRate"),
        "aggregation": F.col("aggregation"),
        "load_status": F.col("load_status"),
        "thresholdId": F.col("node_id"),
        "aggregationLevel": F.col("level"),
    } | {c: F.col(c) for c in described}
    extra = [c for c in ("run_start",) if c in joined.columns]
    return joined.select(
        *extra,
        *[known.get(f, F.lit(None).cast("string")).alias(f) for f in RECORD_FIELDS],
    )


def record_messages(records: DataFrame) -> DataFrame:
    """Keyed messages: ``<dn>+<thresholdId>`` and the record as JSON."""
    return records.select(
        F.concat_ws("+", F.coalesce("dn", F.lit("")), "thresholdId").alias("key"),
        F.to_json(F.struct(*RECORD_FIELDS), {"ignoreNullFields": "false"}).alias("value"),
    )


def history_bundle(records: DataFrame) -> DataFrame:
    """Newest record per threshold, KPI, element and run, with the earlier ones by begin time.

    A bundle holds at most one record per look-back of its threshold, so its size is set by
    the config and not by the data.
    """
    keys = ["thresholdId", "metricId", "dn", "run_start"]
    record = F.struct(*RECORD_FIELDS)
    grouped = records.groupBy(*keys).agg(
        F.max_by(record, "beginTime").alias("current"),
        F.collect_list(F.struct(F.col("beginTime").alias("t"), record.alias("r"))).alias("__all"),
    )
    # A feed that repeats records names a begin time twice; one record of each time stays.
    earlier = F.filter("__all", lambda e: e["t"] < F.col("current")["beginTime"])
    timed = grouped.withColumn("__all", earlier).withColumn(
        "__times", F.array_sort(F.array_distinct(F.col("__all.t")))
    )
    first = F.transform("__times", lambda t: F.get(F.filter("__all", lambda e: e["t"] == t), 0)["r"])
    return timed.select(*keys, "current", F.map_from_arrays("__times", first).alias("values"))


def bundle_messages(bundles: DataFrame) -> DataFrame:
    """Keyed messages of history bundles: ``<dn>+<thresholdId>`` and ``{current, values, thresholdId}``.

    ``values`` holds the earlier records by their begin time; a bundle without any has an empty one.
    """
    body = F.struct("current", "values", "thresholdId")
    return bundles.select(
        F.concat_ws("+", F.coalesce(F.col("current")["dn"], F.lit("")), "thresholdId").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )


def expand_supergroups(cfg: DataFrame, children: DataFrame) -> DataFrame:
    """Fill ``id_ngInclusion_SG`` with the alarm-enabled children of the included super-groups.

    ``children`` has one row per child group: ``id``, ``parentId``, ``targetGroups``.
    Thresholds with any plain group association get an empty list.
    """
    all_super = (F.size("typeAssociation") > 0) & F.forall(
        "typeAssociation", lambda t: F.coalesce(t == "SUPERGROUP", F.lit(False))
    )
    alarmed = children.where(F.array_contains("targetGroups", "ALARMS")).select(
        F.col("id").alias("__child"), F.col("parentId").alias("__parent")
    )
    kids = alarmed.groupBy("__parent").agg(F.collect_set("__child").alias("__kids"))
    included = (
        cfg.where(all_super)
        .select(*THRESHOLD, F.explode("id_ngInclusion").alias("__parent"))
        .groupBy(*THRESHOLD)
        .agg(F.sort_array(F.collect_set("__parent")).alias("__parents"))
    )
    # Children are listed once for every set of super-groups; thresholds of equal sets share the list.
    found = (
        included.select("__parents")
        .distinct()
        .select("__parents", F.explode("__parents").alias("__parent"))
        .join(kids, "__parent")
        .groupBy("__parents")
        .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("__kids")))).alias("__children"))
    )
    # Lists come in last, so no later step has to move them.
    return (
        cfg.join(included, list(THRESHOLD), "left")
        .join(found, "__parents", "left")
        .withColumn(
            "id_ngInclusion_SG", F.coalesce("__children", F.array().cast("array<string>"))
        )
        .drop("__parents", "__children")
    )
