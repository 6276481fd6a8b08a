"""Lookups, inventory matching, volume counts and wide aggregates.

Lookup joins carry no broadcast hint: Spark broadcasts a lookup when its size is below
``spark.sql.autoBroadcastJoinThreshold``, by statistics or measured at run time, and
shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavemeter.functions.scalars import split_addresses
from wavemeter.functions.timeutil import floor_minutes, ts_lit
from wavemeter.model import TIME
from wavemeter.operators.joins import join_null_safe
from wavemeter.operators.predicates import fill_missing, relabel


def lookup(df: DataFrame, table: DataFrame, attribute: str, id_: Column, out: str) -> DataFrame:
    """``out`` = value of ``<id>.<attribute>`` in a key/value table; null when absent."""
    entries = table.where(F.col("key").endswith(f".{attribute}")).select(
        F.col("key").alias("__key"), F.col("value").alias(out)
    )
    key = F.concat(id_, F.lit(f".{attribute}"))
    return df.withColumn("__want", key).join(
        entries, F.col("__want") == F.col("__key"), "left"
    ).drop("__want", "__key")


def own_or_enriched_id(object_id: str, own: str = "equipmentId") -> Column:
    """Own id for facts of ``object_id``; other facts name theirs in the enrichment."""
    return F.when(F.col("managedObjectId") == object_id, F.col(own)).otherwise(
        F.get_json_object("enrichment", f"$.topology.{object_id}")
    )


def volume_by_dimension(
    df: DataFrame, tables: Mapping[str, DataFrame], object_id: str,
    equipment_attributes: Mapping[str, str], source: str,
) -> DataFrame:
    """Fact count per hour and enriched dimension.

    Counts by id first and looks names up on the counted rows, then adds up ids that share
    their names. ``equipment_attributes`` maps output columns to attribute names.
    """
    ids = (
        df.withColumn(TIME, floor_minutes(TIME, 60))
        .withColumn("__equipment", own_or_enriched_id(object_id))
        .groupBy(
            TIME, "equipmentTypeId", "managedObjectId", "vendorId", "additionalDn",
            "reportInterval", "metricId", "__equipment",
        )
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    named = ids
    for out, id_, name in (
        ("Eq_Type", "equipmentTypeId", "equipment_type"),
        ("MO", "managedObjectId", "managed_object"),
        ("vendor", "vendorId", "vendor"),
        ("name_lookup", "metricId", "metric"),
    ):
        named = lookup(named, tables[name], "name", F.col(id_), out)
    for out, attribute in equipment_attributes.items():
        named = lookup(named, tables["equipment"], attribute, F.col("__equipment"), out)
    return (
        named.withColumn("fonte", F.lit(source))
        .groupBy(
            "fonte", TIME, "Eq_Type", "MO", "vendor", "additionalDn", "reportInterval",
            *equipment_attributes, "name_lookup",
        )
        .agg(F.sum("__n").alias("count"))
    )


# Keys of the wide 15-minute aggregate and how many values a row of it lists.
WIDE_KEYS = (
    "metricId", "formulaId", "dn", "additionalDn", "elementType", "sourceSystem", "managerIp",
    "isRate", "vendorId", "sourceVendor", "functionId", "equipmentId", "locationId",
    "equipmentTypeId", "managedObjectId", "networkGroups", "pollingRuleId",
)
VALUES_PER_ROW = 100_000
LABEL_SHIFT_HOURS = 3


def wide_agg(df: DataFrame, per_row: int = VALUES_PER_ROW) -> DataFrame:
    """15-minute sums, extremes and counts per 17 keys, with every value listed.

    A group of more than about ``per_row`` values has several rows, numbered by ``part`` of
    ``parts``: each repeats the totals and lists its own values, ascending, so no array grows
    with the group and none is lost. The part of a value follows from the value and its place
    among equals, and the number of parts from the counted size; one plan serves every size.
    Equal values travel as one counted row.
    """
    keys = [TIME, *WIDE_KEYS]
    rows = df.select(floor_minutes(TIME, 15).alias(TIME), *WIDE_KEYS, "value")
    weighted = rows.groupBy(*keys, "value").agg(
        F.sum("value").alias("__sum"), F.count("value").alias("__w")
    )
    totals = weighted.groupBy(*keys).agg(
        F.sum("__sum").alias("value_sum"),
        F.max("value").alias("value_max"),
        F.min("value").alias("value_min"),
        F.sum("__w").alias("value_count"),
        F.greatest(F.lit(1), F.ceil(F.sum("__w") / F.lit(per_row))).cast("int").alias("parts"),
    )
    # A value held by many rows is itself shared out, so that no part repeats it without bound.
    share = F.ceil(F.col("__w") / F.col("parts")).cast("long")
    listed = (
        join_null_safe(weighted, totals, keys)
        .withColumn("__first", F.pmod(F.xxhash64("value"), F.col("parts")).cast("int"))
        .withColumn("__k", F.explode(F.sequence(F.lit(0), F.least(F.col("parts").cast("long"), F.greatest(F.col("__w"), F.lit(1))) - 1)))
        .withColumn("__n", F.greatest(F.lit(0), F.least(share, F.col("__w") - F.col("__k") * share)))
        .withColumn("part", F.pmod(F.col("__first") + F.col("__k"), F.col("parts")).cast("int"))
    )
    repeated = F.flatten(
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("__n") > 0, F.struct("value", "__n")))),
            lambda x: F.array_repeat(x["value"], x["__n"].cast("int")),
        )
    )
    shown = ["value_sum", "value_max", "value_min", "value_count", "parts"]
    return _labelled(
        listed.groupBy(*keys, "part").agg(
            *(F.first(c).alias(c) for c in shown), repeated.alias("value_array")
        )
    )


def _labelled(df: DataFrame) -> DataFrame:
    shifted = F.col(TIME) - F.make_dt_interval(F.lit(0), F.lit(LABEL_SHIFT_HOURS))
    return df.withColumn(TIME, shifted).withColumn("granularityInterval", F.lit(900))


def seen_recently(df: DataFrame, now: datetime, minutes: int = 15) -> DataFrame:
    """Distinct elements with a fact at or after ``now - minutes``."""
    since = ts_lit(now - timedelta(minutes=minutes))
    return df.where(F.col(TIME) >= since).select("dn").distinct()


def active_rows(df: DataFrame, active: DataFrame) -> DataFrame:
    return df.join(active, "dn", "left_semi")


def address_rows(
    inventory: DataFrame, address: str, marker: str, out: str = "IP", sep: str = ";"
) -> DataFrame:
    """One row per address of an inventory row; rows with the marker text drop out."""
    listed = inventory.where(F.col(address) != marker)
    return listed.withColumn(out, F.explode(split_addresses(F.col(address), sep))).drop(
        *([address] if address != out else [])
    )


def inventory_match(
    inventory: DataFrame, discovered: DataFrame, inventory_names: Mapping[str, str],
    discovered_names: Mapping[str, str], stamp: datetime, missing: str, key: str = "IP",
) -> DataFrame:
    """Inventory addresses with what discovery knows about them; gaps filled with a marker."""
    left = inventory.withColumnsRenamed(dict(inventory_names))
    right = discovered.withColumnsRenamed(dict(discovered_names))
    joined = relabel(left.join(right, key, "left"), {}, stamp)
    return fill_missing(joined, missing, [c for c in joined.columns if c != "processing_date"])


def dimension_table(rows: DataFrame, id_: str, attributes: Sequence[str]) -> DataFrame:
    """Key/value lookup ``<id>.<attribute>`` from a table with one column per attribute."""
    pairs = F.explode(
        F.array(
            *[
                F.struct(
                    F.concat(F.col(id_), F.lit(f".{a}")).alias("key"),
                    F.col(a).cast("string").alias("value"),
                )
                for a in attributes
            ]
        )
    )
    return rows.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull())
