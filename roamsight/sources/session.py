"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stages with many columns compile to methods the JVM never optimises; beyond this size of bytecode
    # Spark splits them up instead. Two to three times faster on the session base.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# These only take effect when the session starts.
START_SETTINGS = {
    # one segmentation compiles more classes than the default cache of 100 holds, and would compile them every time
    "spark.sql.codegen.cache.maxEntries": "2000",
    # do not look up the Python call site of every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that can change at run time."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add all settings to a session about to be built."""
    for name, value in {**SETTINGS, **START_SETTINGS}.items():
        builder = builder.config(name, value)
    return builder
