"""Pieces of SQL expression text.

Longer expressions (CASE chains, functions over arrays) are written as SQL
text: the plan is the same, and building it takes one call to the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def literal(value: str | int | bool | None) -> str:
    """A constant as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return f"{value}L"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def case(branches: Iterable[tuple[str, str | int | bool | None]], default: str | int | bool | None) -> str:
    """First branch whose condition is TRUE, else the default. NULL is not TRUE."""
    whens = " ".join(f"WHEN {condition} THEN {literal(result)}" for condition, result in branches)
    return f"CASE {whens} ELSE {literal(default)} END"


def lookup(
    column: str, pairs: Iterable[tuple[str, str | int | None]], default: str | int | None
) -> str:
    """The result paired with the column's value, else the default."""
    return case([(f"{column} = {literal(match)}", result) for match, result in pairs], default)


def either(condition: str, yes: str, no: str) -> str:
    """``yes`` when the condition is TRUE; FALSE and NULL give ``no``."""
    return f"if({condition}, {literal(yes)}, {literal(no)})"


def inline_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    """Constants of a configuration as a table whose size the planner knows."""
    values = ", ".join("(" + ", ".join(literal(value) for value in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")
