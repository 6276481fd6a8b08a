"""Keyed messages for a topic, and publishing them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_json(df: DataFrame, key: str | Column | None = None) -> DataFrame:
    """Rows as JSON with a constant text key, a key per row, or none."""
    if key is None:
        named = F.lit(None).cast("string")
    else:
        named = F.lit(key) if isinstance(key, str) else key.cast("string")
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(named.alias("key"), body.alias("value"))


def keyed_text(df: DataFrame, key: str, value: str) -> DataFrame:
    """Lookup messages: plain text value per key, for a compacted topic."""
    return df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))


def publish(messages: DataFrame, format_: str, options: Mapping[str, str]) -> None:
    """Write messages to a topic (``kafka``) or any other batch sink."""
    messages.write.format(format_).mode("append").options(**options).save()
