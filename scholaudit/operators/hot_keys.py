"""Joins on a key that a large share of the rows may hold, or none.

A sketch in a narrow pass over a side's keys finds those that hold a large
share of its rows. ``deal`` gives the rows with such a key, and the rows
without one, a salt by the task that reads them; ``meet`` repeats the other
side's rows of these keys for every salt, and the join takes the salt along
with the key. Several tables can be joined to a dealt one in a row, which stays
where the first join put it.

Where the other side is counted (``count_copies``) and its key holds a large
share, its counts are divided into parts and the dealt rows repeated for these,
so that the copies of one joined row leave several tasks. All other rows are
joined as they would be.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16
MOST_HOT = 100  # keys of a table, at most
TRACKED = 10_000  # keys that the sketch follows
HOT_PART = 50  # a hot key holds at least one row in so many
FEWEST = 20  # rows of a hot key, at least

# A row's place among the tasks of its key, and the part of the counts it meets.
SALT, PART = "_salt", "_part"
_EVERY = f"sequence(0, {SALTS - 1})"


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """At most ``MOST_HOT`` keys that hold a large share of the rows, by a sketch combined before it is shuffled."""
    sketch = rows.selectExpr(key).agg(
        F.expr(f"approx_top_k({key}, {MOST_HOT}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("rows")
    )
    return sketch.selectExpr("rows", "inline(top)").where(
        f"item IS NOT NULL AND count >= {FEWEST} AND count * {HOT_PART} >= rows"
    ).selectExpr(f"item AS {key}")


def hot_table(key: str, dealt: Sequence[DataFrame], divided: Sequence[DataFrame] = ()) -> DataFrame:
    """(key, _hot, _split): keys that are hot in a table to deal, and in one whose counts are to divide."""
    if not divided and len(dealt) == 1:
        return hot_keys(dealt[0], key).selectExpr(key, "TRUE AS _hot", "FALSE AS _split")
    found = [hot_keys(rows, key).selectExpr(key, "TRUE AS _hot", "FALSE AS _split") for rows in dealt]
    found += [hot_keys(rows, key).selectExpr(key, "FALSE AS _hot", "TRUE AS _split") for rows in divided]
    return reduce(DataFrame.unionByName, found).groupBy(key).agg(
        F.max("_hot").alias("_hot"), F.max("_split").alias("_split")
    )


def _flagged(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    # A few hundred rows at most, whatever the size of the tables.
    return df.join(F.broadcast(hot), key, "left")


def _own(df: DataFrame) -> list[str]:
    return [f"`{name}`" for name in df.columns]


def deal(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """The rows with a salt, repeated for the parts of divided counts.

    Copies of a row are dealt by the task that reads them, and the same rows
    come from it if it is run again.
    """
    return _flagged(rows, hot, key).selectExpr(
        *_own(rows),
        f"if(coalesce(_hot, {key} IS NULL), pmod(spark_partition_id(), {SALTS}), 0) AS {SALT}",
        f"explode(if(coalesce(_split, FALSE), {_EVERY}, array(0))) AS {PART}",
    )


def meet(rows: DataFrame, hot: DataFrame, key: str, n: str | None = None) -> DataFrame:
    """Rows to join to dealt ones by key and salt; with their number of copies ``n`` by part as well."""
    salted = _flagged(rows, hot, key).selectExpr(
        *_own(rows),
        "coalesce(_split, FALSE) AS _divide",
        f"explode(if(coalesce(_hot, FALSE), {_EVERY}, array(0))) AS {SALT}",
    )
    if n is None:
        return salted.drop("_divide")
    parts = f"if(_divide, sequence(0, int(least({SALTS}, {n})) - 1), array(0))"
    divided = f"if(_divide, {n} div {SALTS} + if({PART} < {n} % {SALTS}, 1, 0), {n}) AS {n}"
    return salted.selectExpr("*", f"explode({parts}) AS {PART}").selectExpr(
        *[divided if name == f"`{n}`" else name for name in _own(rows)], SALT, PART, "TRUE AS _met"
    )


def join_dealt(dealt: DataFrame, met: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join what ``deal`` and ``meet`` gave; after divided counts the parts are gone."""
    if PART not in met.columns:
        return dealt.join(met, [*on, SALT], how)
    # Counts are divided from part 0 on, so a row without a match in a later part has its matches before.
    return dealt.join(met, [*on, SALT, PART], how).where(f"{PART} = 0 OR _met").drop(PART, "_met")
