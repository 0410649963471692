"""Session construction with the settings the operators are tuned for.

Only settings that are not already present are applied, so a cluster's own
configuration (partition counts, checkpoint and warehouse folders) always wins.
"""

from __future__ import annotations

import os

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings the plans rely on: adaptive re-planning (partition coalescing and
# skew-join splitting) and Arrow transfer for the few pandas-backed steps.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # checkpoints written for lineage cuts are removed once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def _given() -> set[str]:
    """Settings that a running session or a submitting launcher has set already."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return set(dict(active.sparkContext.getConf().getAll())) | set(active.conf.getAll)
    if SparkContext._gateway is not None or "PYSPARK_GATEWAY_PORT" in os.environ:
        return set(dict(SparkConf().getAll()))
    return set()


def build_session(master: str | None = None, app: str = "ledgerlight",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    conf.setdefault("spark.driver.memory", os.environ.get("LEDGERLIGHT_DRIVER_MEMORY", "8g"))
    given = _given()
    conf = {k: v for k, v in conf.items() if k not in given}
    if shuffle_partitions is not None:     # what the caller names counts
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
