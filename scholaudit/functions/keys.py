"""Join keys: identifiers are matched without regard to case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doi_key(df: DataFrame) -> Column:
    """A table's DOI key: its stored ``doi_key`` where it has one, else the lowered DOI."""
    return (F.col("doi_key") if "doi_key" in df.columns else F.lower("doi")).alias("doi_key")


def left_join_any_case(left: DataFrame, right: DataFrame, left_column: str, right_column: str) -> DataFrame:
    """Every left row with the right rows whose text is equal but for case; the columns' names must differ.

    NULL matches nothing, and rows without a key on the right never shuffle.
    """
    known = right.where(F.col(right_column).isNotNull())
    return left.join(known, F.lower(left[left_column]) == F.lower(known[right_column]), "left")
