"""Mixing sources to target weights by a temperature.

A source's share of all tokens is raised to an exponent between 0 (equal
weights) and 1 (shares as they are) and normalised. The exponent is found by
bisection, so that the weights have a given entropy, or so that no source is
repeated more than a given number of times.

The weights are then realised over a budget of tokens: source s gets
weight * budget tokens, as whole passes over its documents and the start of
one more. Each pass is a permutation of its own, by hash. The stream is cut
into blocks of equal token budget, every block holds its share of every
source, and inside a block documents are permuted again.

Without a stated budget it is the smallest that uses every document at least
once, so that nothing is lost and smaller sources are repeated.

Everything is native. Token counts are combined before they shuffle. Running
sums use two levels, inside small buckets of a source's permutation and over
the buckets' sums, so that a source with a third of all rows is spread over
many tasks. A document counts its words and one more for its end.

Defined cases: null source is a source of its own, null text is the empty text
and counts one token, repeated rows are documents of their own. A document
longer than a block belongs to the block in which it starts. Empty tables give
empty results. Further columns, whatever their names, are carried along by
``mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholaudit.llm.shared import column, fresh, stage, whole_text

LEVELS = 5  # steps of the bisection that one pass over the sources serves
STEPS = 40
BUCKET_ROWS = 2_000
UNKNOWN = "\x00"  # stands for the null source while grouping


def n_tokens(text: Column) -> Column:
    """Words of the text, and one for its end."""
    return (F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def source_tokens(docs: DataFrame) -> DataFrame:
    """``(source, tokens, docs, share)`` of rows with source and tokens."""
    sums = docs.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    total = stage(sums, "source_tokens")
    everything = total.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    return total.withColumn("share", F.col("tokens") / F.lit(float(max(everything, 1))))


def _measures(sources: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """Entropy, and largest passes over smallest passes, of the weights at each exponent."""
    power = F.pow("share", F.col("exponent"))
    rows = (
        sources.select("share", F.explode(F.array(*map(F.lit, exponents))).alias("exponent"))
        .groupBy("exponent")
        .agg(
            F.sum(power).alias("z"),
            F.sum(power * F.log("share")).alias("s"),
            F.max(power / F.col("share")).alias("most"),
            F.min(power / F.col("share")).alias("least"),
        )
        .collect()  # one row for each of a few exponents
    )
    return {
        row["exponent"]: (math.log(row["z"]) - row["exponent"] * row["s"] / row["z"], row["most"] / row["least"])
        for row in rows
    }


def bisect_exponent(
    sources: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None
) -> float:
    """The exponent in [0, 1] that meets the target.

    Entropy falls and repetition falls as the exponent grows. The entropy
    target gives the exponent at which it is met; the repetition limit (passes
    over the most repeated source for one over the least) gives the smallest
    exponent that keeps it. Targets out of reach give the nearer end.
    """
    if (target_entropy is None) == (max_repetition is None):
        raise ValueError("state either target_entropy or max_repetition")

    def too_flat(measure: tuple[float, float]) -> bool:
        return measure[0] > target_entropy if target_entropy is not None else measure[1] > max_repetition

    ends = _measures(sources, [0.0, 1.0])
    if not ends or not too_flat(ends[0.0]):
        return 0.0
    if too_flat(ends[1.0]):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(STEPS // LEVELS):
        parts = 2**LEVELS
        tried = [low + (high - low) * part / parts for part in range(1, parts)]
        measured = _measures(sources, tried)
        for _ in range(LEVELS):
            middle = low + (high - low) / 2
            nearest = min(tried, key=lambda value: abs(value - middle))
            low, high = (nearest, high) if too_flat(measured[nearest]) else (low, nearest)
    return high


def source_plan(sources: DataFrame, exponent: float, budget: float | None = None) -> DataFrame:
    """``(source, tokens, docs, weight, quota, passes)``; quota in tokens."""
    sums = sources.agg(
        F.sum(F.pow("share", F.lit(exponent))).alias("z"),
        F.max(F.col("tokens") / F.pow("share", F.lit(exponent))).alias("least_budget"),
    ).first()
    z = sums["z"] or 1.0
    if budget is None:
        budget = (sums["least_budget"] or 0.0) * z
    weight = F.pow("share", F.lit(exponent)) / F.lit(z)
    quota = F.floor(F.round(weight * F.lit(float(budget)), 3) + F.lit(0.5)).cast("long")
    return sources.select(
        "source", "tokens", "docs", weight.alias("weight"), F.greatest(quota, F.lit(1).cast("long")).alias("quota")
    ).withColumn("passes", F.ceil(F.col("quota") / F.col("tokens")).cast("int"))


def _key(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[part.cast("string") for part in parts]))


def _unit(key: Column) -> Column:
    """A number in [0, 1) from a key's first eight digits."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def schedule(docs: DataFrame, plan: DataFrame, block_tokens: int, seed: int = 0, keep: tuple[str, ...] = ()):
    """A row per use of a document: doc_id, source, tokens, pass, block, place.

    ``docs`` has doc_id, source, tokens and the columns of ``keep``. Sorting by
    block and place gives the stream.
    """
    budget = plan.agg(F.sum("quota").alias("b")).first()["b"] or 1
    blocks = max(1, math.ceil(budget / block_tokens))
    plan = stage(plan, "source_plan")
    uses = (
        docs.join(plan.withColumnsRenamed({"tokens": "source_tokens", "docs": "source_docs"}), "source")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
        .withColumn("key", _key(seed, F.col("pass"), F.coalesce(F.col("doc_id").cast("string"), F.lit(UNKNOWN))))
        .withColumn("bucket", F.floor(_unit(F.col("key")) * F.ceil(F.col("source_docs") / F.lit(BUCKET_ROWS))))
    )
    sums = uses.groupBy("source", "pass", "bucket").agg(F.sum("tokens").alias("bucket_tokens"))
    before = Window.partitionBy("source", "pass").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        sums.withColumn("bucket_start", F.coalesce(F.sum("bucket_tokens").over(before), F.lit(0).cast("long"))),
        "bucket_starts",
    ).drop("bucket_tokens")
    inside = (
        Window.partitionBy("source", "pass", "bucket")
        .orderBy("key", "tokens", *keep)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # The start in the source's stream: whole passes, whole buckets, then the rows before.
    begin = F.col("pass") * F.col("source_tokens") + F.col("bucket_start")
    begin = begin + F.coalesce(F.sum("tokens").over(inside), F.lit(0).cast("long"))
    placed = (
        uses.join(offsets, ["source", "pass", "bucket"])
        .withColumn("begin", begin)
        .where("begin < quota")
        .withColumn("block", F.floor(F.col("begin") / F.col("quota") * F.lit(float(blocks))).cast("long"))
        .withColumn("place", _key(seed, F.lit("block"), F.col("key")))
    )
    return placed.select("doc_id", "source", "weight", "tokens", "pass", "block", "place", *keep)


def mix(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repetition: float | None = None,
    budget: float | None = None,
    block_tokens: int = 1_000_000,
    seed: int = 0,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """The rows of the mixture with the columns of ``docs``: blocks are whole and in order in each partition."""
    row = fresh(docs, "row")
    own = F.struct(*[column(docs, name).alias(f"c{place}") for place, name in enumerate(docs.columns)])
    rows = mixing_rows(docs, id_column, source_column, text_column, own.alias(row))
    plan = _plan(rows, target_entropy, max_repetition, budget)
    stream = schedule(rows, plan, block_tokens, seed, (row,)).repartition("block").sortWithinPartitions("block", "place")
    return stream.select(*[F.col(f"{row}.c{place}").alias(name) for place, name in enumerate(docs.columns)])


def mixing_rows(docs: DataFrame, id_column: str, source_column: str, text_column: str, *more: Column) -> DataFrame:
    return docs.select(
        column(docs, id_column).alias("doc_id"),
        F.coalesce(column(docs, source_column).cast("string"), F.lit(UNKNOWN)).alias("source"),
        n_tokens(whole_text(docs, text_column)).alias("tokens"),
        *more,
    )


def _plan(rows, target_entropy, max_repetition, budget) -> DataFrame:
    sources = source_tokens(rows.select("source", "tokens"))
    return source_plan(sources, bisect_exponent(sources, target_entropy, max_repetition), budget)


def mixing_schedule(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repetition: float | None = None,
    budget: float | None = None,
    block_tokens: int = 1_000_000,
    seed: int = 0,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """A row per use: doc_id, source, weight, n_tokens, epoch, block, position (from 1 in the block)."""
    rows = stage(mixing_rows(docs, id_column, source_column, text_column), "mixing_rows")
    stream = schedule(rows, _plan(rows, target_entropy, max_repetition, budget), block_tokens, seed)
    # A block is bounded: each document has a token at least.
    order = Window.partitionBy("block").orderBy("place", "source", "doc_id", "pass", "tokens")
    known = F.when(F.col("source") != UNKNOWN, F.col("source"))
    return stream.select(
        "doc_id",
        known.alias("source"),
        F.round("weight", 9).alias("weight"),
        F.col("tokens").alias("n_tokens"),
        F.col("pass").alias("epoch"),
        "block",
        F.row_number().over(order).alias("position"),
    )
