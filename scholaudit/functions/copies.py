"""Counting repeated rows before a shuffle and writing them out again after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Copies written out from one row of a task.
CHUNK = 100


def count_copies(df: DataFrame, *columns: str, n: str = "n") -> DataFrame:
    """Distinct rows over the columns with their number.

    The map side combines copies, so a key that holds a large share of the
    rows reaches its shuffle partition as a few counted rows.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(n))


def expand_copies(df: DataFrame, n: Column, spread: Sequence[str] | None = None) -> DataFrame:
    """Emit every row ``n`` times (NULL counts as once).

    Rows are first cut into chunks of few copies. With ``spread`` the chunks
    are then rebalanced over the tasks (within the given columns, if any), so
    that the copies of one row need not come from one task.
    """
    chunks = df.withColumn("_times", F.coalesce(n, F.lit(1)).cast("bigint")).withColumn(
        "_chunk", F.expr(f"explode(sequence(0L, (_times - 1) div {CHUNK}))")
    )
    if spread is not None:
        chunks = chunks.hint("rebalance", *[F.col(name) for name in spread])
    inside = f"explode(sequence(1L, least({CHUNK}L, _times - _chunk * {CHUNK})))"
    return chunks.withColumn("_copy", F.expr(inside)).drop("_times", "_chunk", "_copy")
