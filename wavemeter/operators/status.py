"""Current state of collectors and elements, and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavemeter.functions.scalars import liveness, offline_hours, or_marker
from wavemeter.functions.timeutil import ts_lit
from wavemeter.model import TIME

# Days read on the first and on later runs.
FULL_LOAD_DAYS = 7
DELTA_LOAD_DAYS = 2

# Fixed value: text put in place of a missing message field.
NOT_INFORMED = "não_informado"

ELEMENT_KEY = ("dn", "additionalDn")
ELEMENT_FIELDS = ("sourceSystem", "vendorName", "managerIp", "elementType")


def last_seen(
    facts: DataFrame, now: datetime, full_load: bool, sources: Sequence[str] | None = None
) -> DataFrame:
    """Latest fact time per device over the load window, optionally of some sources only."""
    days = FULL_LOAD_DAYS if full_load else DELTA_LOAD_DAYS
    rows = facts.where(F.col(TIME) > ts_lit(now - timedelta(days=days)))
    if sources:
        rows = rows.where(F.col("sourceSystem").isin(*sources))
    return rows.groupBy(F.col("additionalDn").alias("device")).agg(F.max(TIME).alias("lastSeen"))


def collector_status(seen: DataFrame, previous: DataFrame, now: datetime) -> DataFrame:
    """Merge of the previous state with the devices seen now.

    Seen devices are ONLINE within an hour of their last fact; devices only known from
    before are OFFLINE, with their hours brought up to ``now``.
    """
    new = seen.select("device", F.col("lastSeen").alias("__new"))
    old = previous.select("device", F.col("lastSeen").alias("__old"))
    hours = offline_hours(F.col("lastSeen"), ts_lit(now))
    return (
        new.join(old, "device", "full_outer")
        .withColumn("lastSeen", F.coalesce("__new", "__old"))
        .select(
            "device",
            "lastSeen",
            hours.alias("offlineHours"),
            F.when(F.col("__new").isNull(), F.lit("OFFLINE")).otherwise(liveness(hours)).alias(
                "status"
            ),
            ts_lit(now).alias("dt_load"),
        )
    )


def absent_devices(seen: DataFrame, previous: DataFrame) -> DataFrame:
    return previous.select("device").join(seen.select("device"), "device", "left_anti")


def normalised_messages(messages: DataFrame) -> DataFrame:
    """Messages with marker text in place of missing fields."""
    names = (*ELEMENT_KEY, *ELEMENT_FIELDS)
    return messages.withColumns({n: or_marker(F.col(n), NOT_INFORMED) for n in names})


def element_status(messages: DataFrame, order: Sequence[str] = (TIME,)) -> DataFrame:
    """Last message per element; ``order`` breaks ties between equal times."""
    rows = normalised_messages(messages)
    record = F.struct(*ELEMENT_FIELDS, F.col(TIME).alias("created_at"))
    latest = rows.groupBy(*ELEMENT_KEY).agg(F.max_by(record, F.struct(*order)).alias("r"))
    return latest.select(*ELEMENT_KEY, "r.*")


def expire(
    state: DataFrame, now: datetime, lifetime: timedelta = timedelta(days=1),
    seen: str = "created_at",
) -> DataFrame:
    """State with ``ativo``: seen within the lifetime before ``now``."""
    return state.withColumn("ativo", F.col(seen) >= ts_lit(now - lifetime))


def live_elements(
    state: DataFrame, now: datetime, lifetime: timedelta = timedelta(days=1)
) -> DataFrame:
    """Only elements whose entry has not outlived its lifetime."""
    return state.where(F.col("created_at") >= ts_lit(now - lifetime))


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Column | None = None
) -> DataFrame:
    """Target with rows of ``updates`` inserted or replaced whole, by key.

    With ``order`` the last of several updates of a key wins; without it keys of the
    updates must be unique.
    """
    keys = list(keys)
    if order is not None:
        values = [c for c in updates.columns if c not in keys]
        updates = (
            updates.groupBy(*keys)
            .agg(F.max_by(F.struct(*values), order).alias("__v"))
            .select(*keys, "__v.*")
        )
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of every key by ``order``; combines map-side."""
    keys = list(keys)
    values = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*values), F.struct(*order)).alias("__v"))
        .select(*keys, "__v.*")
        .select(*df.columns)
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of every key by ``order``; combines map-side."""
    keys = list(keys)
    values = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), F.struct(*order)).alias("__v"))
        .select(*keys, "__v.*")
        .select(*df.columns)
    )
