"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that hold on a cluster and on one machine alike; sizes and core counts
# are left to the submitter.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Sketch and array aggregates leave the hash map after this many groups per task; 128
    # (the default) would send every roll-up to the sort-based path. A sketch of the largest
    # level takes a few kB, so the map stays within some tens of MB.
    "spark.sql.execution.objectHashAggregate.sortBased.fallbackThreshold": "8192",
}


def build_session(app: str = "wavemeter", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_defaults(spark: SparkSession) -> SparkSession:
    """Times are read as UTC whatever session the caller built; its other settings stay."""
    if spark.conf.get("spark.sql.session.timeZone") != DEFAULTS["spark.sql.session.timeZone"]:
        spark.conf.set("spark.sql.session.timeZone", DEFAULTS["spark.sql.session.timeZone"])
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared checkpoint root of the cluster.

    The root comes from ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder, because there every task sees the same disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="wavemeter-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
