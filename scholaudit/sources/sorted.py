"""Sorted exports: files whose rows are in order, one file after the other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A sort column and whether it descends. Nulls come first going up and last going down.
Order = Sequence[tuple[str, bool]]


def sort_columns(order: Order) -> list[Column]:
    return [F.col(name).desc() if down else F.col(name).asc() for name, down in order]


def write_sorted(df: DataFrame, folder: str, order: Order, kind: str = "parquet") -> None:
    """Range-partition the rows by the order, sort each range, and write a file per range.

    The names of the files follow the ranges, so reading them by name gives
    the rows in order. Each file comes from one task, and no task holds more
    than its range; a single hot value makes a long range, which sorts on disk.
    """
    df.orderBy(*sort_columns(order)).write.format(kind).save(folder)


def rows_out_of_order(spark: SparkSession, folder: str, order: Order) -> int:
    """Rows of a Parquet export that come before their predecessor in their file, or before the end of the file before.

    Neighbours are compared within files, and the ends of files among files.
    """
    files = spark.read.parquet(folder).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"), *[name for name, _ in order]
    )
    in_file = Window.partitionBy("file").orderBy("at")
    names = [name for name, _ in order]
    before = files.withColumns({f"_{name}": F.lag(name).over(in_file) for name in names} | {"_at": F.lag("at").over(in_file)})
    inside = before.where(F.col("_at").isNotNull()).where(_earlier(order, "", "_")).count()
    ends = files.groupBy("file").agg(
        *[F.min_by(name, "at").alias(f"first_{name}") for name in names],
        *[F.max_by(name, "at").alias(f"last_{name}") for name in names],
    )  # a row per file
    by_name = Window.orderBy("file")
    pairs = ends.withColumns({f"_{name}": F.lag(f"last_{name}").over(by_name) for name in names} | {"_file": F.lag("file").over(by_name)})
    between = pairs.where(F.col("_file").isNotNull()).where(_earlier(order, "first_", "_")).count()
    return inside + between


def _earlier(order: Order, own: str, other: str) -> Column:
    """Whether a row belongs before another one."""
    result, equal = F.lit(False), F.lit(True)
    for name, down in order:
        mine, theirs = F.col(f"{own}{name}"), F.col(f"{other}{name}")
        if down:
            less = F.coalesce(mine > theirs, mine.isNotNull() & theirs.isNull())
        else:
            less = F.coalesce(mine < theirs, mine.isNull() & theirs.isNotNull())
        result = result | (equal & less)
        equal = equal & mine.eqNullSafe(theirs)
    return result
