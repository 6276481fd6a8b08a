"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a broadcast side may take, by the length of its rows as text.
BROADCAST_BYTES = 32 << 20
# Counted for a row besides its text.
ROW_BYTES = 64


def row_bytes(*columns: str) -> Column:
    """About how much a row of these columns takes."""
    return F.octet_length(F.to_json(F.struct(*columns))) + F.lit(ROW_BYTES)


def frame_bytes(df: DataFrame, enough: int = BROADCAST_BYTES) -> int:
    """About how much a frame takes. Counting stops at rows that must take more than ``enough``."""
    rows = df.limit(enough // ROW_BYTES + 1).select(row_bytes(*df.columns).cast("long").alias("b"))
    return rows.agg(F.sum("b")).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the frame really takes at most ``limit`` bytes.

    Larger frames keep no hint and join by shuffle.
    """
    return F.broadcast(df) if frame_bytes(df, limit) <= limit else df


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join that also matches null keys; the keys appear once, from the left side."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys]
    )
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])
