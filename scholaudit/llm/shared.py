"""Helpers of the operators: the shared folder, column names, white space.

Intermediate tables go below ``spark.checkpoint.dir``, which all executors
see. A written table cuts the lineage, survives lost executors and tells the
planner its size.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"

# The characters [\x20\x09-\x0D], which part words.
SPACES = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session; a local session without one gets a new one."""
    folder = spark.conf.get(SETTING, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-"):
            raise ValueError(f"{SETTING} must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the application, once."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parent.parent
        name = f"{tempfile.mkdtemp()}/{package.name}"
        spark.sparkContext.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _shipped.add(application)


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write the rows to a new shared folder and read them back."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the rows don't have in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(df: DataFrame, name: str) -> Column:
    """A column by its literal name, dots included."""
    return df["`" + name.replace("`", "``") + "`"]


def whole_text(df: DataFrame, name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(column(df, name).cast("string"), F.lit(""))


def without_spaces(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in small parts, so that a task's copies of texts stay small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of the registered queries, whose tasks will need this package."""
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")
