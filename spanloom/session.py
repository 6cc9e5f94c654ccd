"""Session settings that the operators count on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Attribute lists may repeat a key: the last one wins. Times are UTC. Lists gathered from rows that a join has sorted are taken as they
    come, instead of being sorted by group twice more."""
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.replaceHashWithSortAgg", "true")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder that the driver and all executors share, under ``spark.checkpoint.dir``; a temporary one for a plain local session only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spanloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/telemetry-{uuid.uuid4().hex}"
