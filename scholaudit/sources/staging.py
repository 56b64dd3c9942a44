"""Intermediate results kept in the cluster's shared folder.

A written table cuts the lineage, survives lost executors, and gives the
planner its true size for the joins that read it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Takes a grouped side of a join and its name, gives the table to join with.
Keep = Callable[[DataFrame, str], DataFrame]

SETTING = "spark.checkpoint.dir"


class NoSharedFolder(RuntimeError):
    """Executors would each write to a disk of their own, and reading back would miss rows."""


def staging_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a session on one machine may do without and uses its warehouse."""
    named = spark.conf.get(SETTING, None)
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise NoSharedFolder(f"{SETTING} must name a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir")


def lazily(df: DataFrame, name: str) -> DataFrame:
    """Leave the rows to the plan that uses them."""
    return df


def stager(prefix: str) -> Keep:
    """Stage under a prefix.

    Skewed joins are split only where both sides come straight from a
    shuffle, which a grouped side does not; a staged one does.
    """
    return lambda df, name: stage(df, f"{prefix}/{name}")


@contextmanager
def staging(spark: SparkSession, name: str) -> Iterator[Keep]:
    """Stage during one run, and remove what it staged at its end, also after an error."""
    prefix = f"{name}-{uuid.uuid4().hex}"
    folder = f"{_application_folder(spark)}/{prefix}"
    try:
        yield stager(prefix)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _application_folder(spark: SparkSession) -> str:
    return f"{staging_root(spark).rstrip('/')}/_staged/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the rows under this application's folder and read them back.

    Every call has a folder of its own, so that plans built earlier stay valid.
    """
    spark = df.sparkSession
    folder = f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
