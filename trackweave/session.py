"""A session with the settings the operators count on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution and Arrow; everything else stays as the cluster has it."""
    builder = SparkSession.builder.appName("trackweave")
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.  Where it is unset and all runs in one process, as
    in tests, a new local one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found
