"""SparkSession defaults for the audit jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# ANSI casts raise on dirty text, UTC fixes timestamp-to-date casts, and AQE
# re-plans joins, splits skewed partitions and sizes shuffles at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is worth another shuffle after the join that splits it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Upper size of a table that is sent to every executor, and how much larger
    # than its compressed files a table is taken to be when that is checked.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.sources.fileCompressionFactor": "4.0",
}


def build_session(app_name: str = "scholaudit", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; keyword settings win (``a__b`` means ``a.b``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the defaults on a session that already runs."""
    for name, value in DEFAULTS.items():
        spark.conf.set(name, value)
    return spark
