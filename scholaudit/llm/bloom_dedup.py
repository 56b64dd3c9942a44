"""Exact de-duplication with two passes of a Bloom filter.

Texts are equal when they are identical without the characters
``[\\x20\\x09-\\x0D]``; the row with the most code points in the original text
stays, then the one with the smallest id (null last).

Pass one sets the bits of every text hash and keeps those that two or more
rows set, as bitmaps of 32,768 bits; all bits of one hash lie in one bitmap.
Pass two tests every row against the kept bits. A row with a bit that nobody
else set has no copy and passes straight through; only the others shuffle, and
they are compared by the whole SHA-256, so a false hit costs time but changes
nothing. The filter is broadcast: its size is fixed before it is built and
never above ``max_blocks`` * 4 KB. Beyond the rows this serves, more unique
rows are shuffled and the result is the same.

Everything is native: counts are combined before each shuffle, a group of
copies is reduced inside the tasks before its rows meet, and the join that
gives copies their group's row reads a written side, so that Spark can split
a group that holds a third of all rows.

Defined cases: null text is the empty text, and empty texts equal one another
and texts of white space only. Rows that repeat an id and a text are copies
too: all count, and one of them stays. Null ids sort last. Empty tables give
empty results. Further columns, whatever their names, are carried along by
``exact_dedup`` and ignored by ``duplicate_groups``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholaudit.llm.shared import column, fresh, stage, whole_text, without_spaces

BLOCK_BITS = 32_768  # of one bitmap of Spark's bitmap functions
HASHES = 4


def fingerprint(text: Column) -> Column:
    return F.sha2(without_spaces(text), 256)


def _block(sha: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(sha), F.lit(blocks))


def _bits(sha: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(sha, F.lit(seed)), F.lit(BLOCK_BITS)) for seed in range(1, HASHES + 1)]


def filter_blocks(rows: int, bits_per_row: int, max_blocks: int) -> int:
    return min(max_blocks, max(1, math.ceil(rows * bits_per_row / BLOCK_BITS)))


def repeated_bits(fingerprints: DataFrame, blocks: int) -> DataFrame:
    """Pass one: ``(block, bitmap)`` of the bits that two or more rows set."""
    sha = F.col("text_sha256")
    hits = fingerprints.select(
        _block(sha, blocks).alias("block"), F.explode(F.array_distinct(F.array(*_bits(sha)))).alias("bit")
    )
    often = hits.groupBy("block", "bit").agg(F.count(F.lit(1)).alias("hits")).where("hits >= 2")
    return often.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def _is_set(bitmap: Column, bit: Column) -> Column:
    place = F.floor(bit / F.lit(8)).cast("int") + F.lit(1)
    byte = F.conv(F.hex(F.substring(bitmap, place, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1


def mark_candidates(rows: DataFrame, sha: str, bits: DataFrame, blocks: int, mark: str) -> DataFrame:
    """Pass two: the rows with ``mark``, true where every bit was set by others too."""
    known = bits.withColumnsRenamed({"block": f"{mark}_block", "bitmap": f"{mark}_bitmap"})
    found = rows.join(F.broadcast(known), _block(rows[sha], blocks) == known[f"{mark}_block"], "left")
    hit = F.lit(True)
    for bit in _bits(F.col(sha)):
        hit = hit & _is_set(F.col(f"{mark}_bitmap"), bit)
    return found.withColumn(mark, F.coalesce(hit, F.lit(False))).drop(f"{mark}_block", f"{mark}_bitmap")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    text = whole_text(docs, text_column)
    return docs.select(
        column(docs, id_column).alias("doc_id"),
        fingerprint(text).alias("text_sha256"),
        F.length(text).cast("long").alias("n_points"),
    )


def duplicate_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    bits_per_row: int = 16,
    max_blocks: int = 16_384,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    marks = stage(fingerprints(docs, id_column, text_column), "fingerprints")
    blocks = filter_blocks(marks.count(), bits_per_row, max_blocks)
    bits = stage(repeated_bits(marks, blocks), "repeated_bits")
    marked = mark_candidates(marks, "text_sha256", bits, blocks, "maybe")

    single = marked.where(~F.col("maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    copies = (
        marked.where("maybe")
        .groupBy("text_sha256", "n_points", "doc_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    rank = F.struct(
        (-F.col("n_points")).alias("minus_points"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id")
    )
    groups = stage(
        copies.groupBy("text_sha256").agg(F.sum("copies").alias("group_size"), F.min(rank).alias("first")), "groups"
    )
    best = (F.col("n_points") == -F.col("first.minus_points")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    several = (
        copies.join(groups, "text_sha256")
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
        .select(
            "doc_id",
            F.col("first.doc_id").alias("keep_id"),
            "group_size",
            (best & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )
    return single.unionByName(several)


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    bits_per_row: int = 16,
    max_blocks: int = 16_384,
) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    marks = stage(fingerprints(docs, id_column, text_column), "fingerprints")
    blocks = filter_blocks(marks.count(), bits_per_row, max_blocks)
    bits = stage(repeated_bits(marks, blocks), "repeated_bits")
    sha, maybe = fresh(docs, "sha_of_text"), fresh(docs, "maybe_repeated")
    marked = mark_candidates(docs.withColumn(sha, fingerprint(whole_text(docs, text_column))), sha, bits, blocks, maybe)
    own = [column(marked, name) for name in docs.columns]
    passed = marked.where(~F.col(maybe)).select(*own)
    doc_id = column(marked, id_column)
    order = F.struct(
        -F.length(whole_text(marked, text_column)), doc_id.isNull(), doc_id, F.xxhash64(*own)
    )
    row = F.struct(*[column(marked, name).alias(f"c{place}") for place, name in enumerate(docs.columns)])
    best = (
        marked.where(F.col(maybe))
        .groupBy(sha)
        .agg(F.min_by(row, order).alias("best"))
        .select(*[F.col(f"best.c{place}").alias(name) for place, name in enumerate(docs.columns)])
    )
    return passed.unionByName(best)
