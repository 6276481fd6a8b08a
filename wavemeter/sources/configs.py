"""Nested config documents as flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemeter.functions.timeutil import ts_lit
from wavemeter.model import BUSY_HOUR_DOCUMENT, GROUP_CHILDREN_DOCUMENT, THRESHOLD_DOCUMENT
from wavemeter.operators.status import first_per_key


def hour_text(option: Column) -> Column:
    """``_HH_MM`` as ``HH:MM``; other words stay as they are."""
    return F.when(
        option.startswith("_"), F.replace(F.substr(option, F.lit(2)), F.lit("_"), F.lit(":"))
    ).otherwise(option)


def _collect(association: str, part: str, field: str) -> Column:
    """One field of every reference of every association, in order."""
    lists = F.transform(
        F.coalesce(F.col(association), F.array()),
        lambda a: F.coalesce(
            F.transform(a[part], lambda r: r[field]), F.array().cast("array<string>")
        ),
    )
    return F.flatten(lists)


def flatten_thresholds(landed: DataFrame, text: str = "value") -> DataFrame:
    """One row per (active threshold, KPI term) of landed threshold documents.

    Unreadable documents, inactive thresholds, thresholds without any aggregation and terms
    without a KPI give no row. ``doc_order`` columns of the input stay, with the position of
    the edge and term, so that later steps can keep the input order.
    """
    carried = [c for c in landed.columns if c != text]
    parsed = landed.withColumn("doc", F.from_json(text, THRESHOLD_DOCUMENT)).drop(text)
    nodes = parsed.select(*carried, F.posexplode("doc.thresholds.edges").alias("edge_pos", "edge"))
    node = nodes.select(*carried, "edge_pos", "edge.node.*")
    none = F.lit("NONE")
    wanted = node.where(
        F.col("status")
        & ~(
            F.coalesce((F.col("dataAggregationTime") == none), F.lit(False))
            & F.coalesce((F.col("spatialAggregation") == none), F.lit(False))
        )
    )
    terms = wanted.select("*", F.posexplode_outer("expression.terms").alias("term_pos", "term"))
    kpi = terms.where(F.col("term.kpi.id").isNotNull())
    empty = F.array().cast("array<string>")
    return kpi.select(
        *carried,
        "edge_pos",
        "term_pos",
        F.col("id").alias("node_id"),
        F.col("name").alias("node_name"),
        F.upper("dataAggregationTime").alias("dataAggregationTime"),
        "dataAggregationTimeGranularity",
        "dataAggregationFunction",
        "dataAggregationPercentileValue",
        "spatialAggregation",
        "spatialAggregationFunction",
        "spatialAggregationPercentileValue",
        F.coalesce("spatialLocationTypeAggregation.name", F.lit("")).alias(
            "spatialLocationTypeAggregation"
        ),
        F.coalesce("spatialLocationTypeAggregation.id", F.lit("")).alias(
            "id_spatialLocationTypeAggregation"
        ),
        F.coalesce("spatialManagedObjectAggregation.name", F.lit("")).alias(
            "spatialManagedObjectAggregation"
        ),
        F.coalesce("spatialManagedObjectAggregation.id", F.lit("")).alias(
            "id_spatialManagedObjectAggregation"
        ),
        F.col("managedObject.id").alias("managedObject_id"),
        F.col("managedObject.name").alias("managedObject_name"),
        F.col("managedObject.model.tableName").alias("dataTableName"),
        F.col("expression.id").alias("expression_id"),
        _collect("equipmentAssociation", "ngInclusion", "id").alias("id_ngInclusion"),
        _collect("equipmentAssociation", "ngInclusion", "name").alias("ngInclusion"),
        _collect("equipmentAssociation", "ngInclusion", "typeAssociation").alias("typeAssociation"),
        empty.alias("id_ngInclusion_SG"),
        _collect("equipmentAssociation", "ngExclusion", "id").alias("id_ngExclusion"),
        _collect("equipmentAssociation", "ngExclusion", "name").alias("ngExclusion"),
        _collect("equipmentAssociation", "equipmentInclusion", "id").alias("id_equipmentInclusion"),
        _collect("equipmentAssociation", "equipmentInclusion", "dn").alias("equipmentInclusion"),
        _collect("equipmentAssociation", "equipmentExclusion", "id").alias("id_equipmentExclusion"),
        _collect("equipmentAssociation", "equipmentExclusion", "dn").alias("equipmentExclusion"),
        F.col("term.kpi.id").alias("kpi_id"),
        F.col("term.kpi.name").alias("kpi_name"),
        F.col("term.kpi.defaultTimeGranularity").alias("kpi_defaultTimeGranularity"),
        F.col("term.kpi.isRate").alias("kpi_isRate"),
        F.col("term.kpi.unit").alias("kpi_unit"),
        *[
            F.col(f"term.kpi.{g}").alias(f"kpi_{g}")
            for g in ("hourly", "daily", "weekly", "monthly", "yearly")
        ],
        *[
            F.col(f"term.kpi.{g}Percentile").alias(f"{g}Percentile")
            for g in ("hourly", "daily", "weekly", "monthly", "yearly")
        ],
        "algorithm",
        "algorithmComparisonValue",
        "algorithmComparisonType",
        "intervalDays",
        "times",
        "effectiveDays",
        F.coalesce(F.transform("days", lambda d: d["optionsDays"]), empty).alias("optionsDays"),
        F.coalesce(
            F.transform(
                "effectiveHours",
                lambda h: F.element_at(F.split(hour_text(h["optionsEffectiveHours"]), ":"), 1),
            ),
            empty,
        ).alias("effectiveHours"),
        "timeZone",
    )


def loadable_thresholds(flat: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Config rows ready to replace the config table.

    Missing aggregations read ``NONE``, missing percentiles 0, rows with neither aggregation
    drop out, and the first row of every threshold and KPI name wins.
    """
    filled = flat.withColumns(
        {
            "dataAggregationTime": F.coalesce("dataAggregationTime", F.lit("NONE")),
            "spatialAggregation": F.coalesce("spatialAggregation", F.lit("NONE")),
            "dataAggregationPercentileValue": F.coalesce(
                "dataAggregationPercentileValue", F.lit(0.0)
            ),
            "spatialAggregationPercentileValue": F.coalesce(
                "spatialAggregationPercentileValue", F.lit(0.0)
            ),
        }
    )
    usable = filled.where(
        (F.col("dataAggregationTime") != "NONE") | (F.col("spatialAggregation") != "NONE")
    )
    return first_per_key(usable, ("node_id", "kpi_name"), order)


def stamped(flat: DataFrame, run_ts) -> DataFrame:
    return flat.withColumn("execution_date", ts_lit(run_ts))


def group_children(landed: DataFrame, text: str = "value") -> DataFrame:
    """Child groups with their parent and target groups."""
    parsed = landed.select(F.from_json(text, GROUP_CHILDREN_DOCUMENT).alias("doc"))
    return parsed.select(F.explode("doc.networkGroups.edges.node").alias("n")).select("n.*")


def flatten_busy_hours(landed: DataFrame, text: str = "value") -> DataFrame:
    """One row per (enabled busy-hour config, period setting)."""
    carried = [c for c in landed.columns if c != text]
    parsed = landed.withColumn("doc", F.from_json(text, BUSY_HOUR_DOCUMENT)).drop(text)
    node = parsed.select(*carried, F.explode("doc.busyHours.edges.node").alias("n")).where(
        F.col("n").isNotNull()
    )
    enabled = node.select(*carried, "n.*").where(F.col("status") == "ENABLE")
    settings = enabled.select("*", F.explode("timeSettings").alias("setting"))

    def level(flag: str, number: int) -> Column:
        return F.when(F.col(f"setting.{flag}"), F.lit(number))

    return settings.select(
        *carried,
        F.col("id").alias("node_id"),
        F.col("name").alias("node_name"),
        F.col("description").alias("node_description"),
        "aggregationFunction",
        F.coalesce("percentileValue", F.lit(0.0)).alias("percentileValue"),
        F.col("kpi.id").alias("kpi_id"),
        F.col("kpi.name").alias("kpi_name"),
        F.col("kpi.status").alias("kpi_status"),
        F.col("kpi.defaultTimeGranularity").alias("defaultTimeGranularity"),
        F.col("managedObject.id").alias("managedObject_id"),
        F.col("managedObject.name").alias("managedObject_name"),
        F.coalesce("managedObject.model.tableName", F.lit("")).alias("dataTableName"),
        F.col("setting.period").alias("period"),
        F.array_compact(
            F.array(level("firstBH", 1), level("secondBH", 2), level("thirdBH", 3))
        ).alias("level"),
        "effectiveDay",
        F.transform("days", lambda d: d["day1"]).alias("day1"),
        F.transform("days", lambda d: d["day2"]).alias("day2"),
        F.transform("days", lambda d: d["day3"]).alias("day3"),
        F.transform("effectiveHour", lambda h: hour_text(h["optionsEffectiveHours"])).alias(
            "effective_hours"
        ),
        "date",
    )
