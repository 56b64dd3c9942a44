"""Hard negatives by a vertical scan of the vectors with branch-and-bound.

Each component becomes ``floor(256 * x)``; a row's score is its integer inner
product with the anchor. An anchor's positives are its first rows of the same
label; its negatives for a positive are the first rows of other labels whose
score is between 30 and 90 hundredths of the positive's.

Rows are held in slabs, dimension by dimension. For an anchor, dimensions are
read in the order of the anchor's magnitudes, some at a time. After each step
a row's score lies between its partial sum plus the least and plus the most
that the dimensions still unread can add, given the slab's smallest and
largest value of each. The bitmap of candidates keeps the rows that may still
be among the first; for negatives, among the first of any of the anchor's
windows. When all dimensions are read the windows are exact. The bar rises
with each slab of a task, and Spark ranks what the tasks hand on.

Anchors are taken in blocks of about ``anchor_block``, each of them sent to all
tasks; rows, positives and results stay in Spark.

Defined cases: rows with a null label or vector, or a null or non-finite
component, take no part. Shorter vectors are zero beyond their end. A null
vec_id is no anchor, keeps its label and ranks behind equal scores. Rows with
the same vec_id are rows each, and anchors each; only the anchor's own row is
left out of its positives. Equal scores rank by vec_id. Anchors without
positives, and positives without negatives, have no rows. Scores must fit into
64 bits. Empty tables give an empty result. Further columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholaudit.llm.shared import column, ship_package, stage

SLAB = 16_384
ANCHOR_BLOCK = 4_096
STEP = 8  # dimensions read before candidates are looked at again
POSITIVES, NEGATIVES = 5, 10
LEAST, MOST = 30, 90  # hundredths of the positive's score


class Slab:
    """Some rows by dimension, with each dimension's smallest and largest value."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray, missing: np.ndarray, rows: np.ndarray):
        self.columns = np.ascontiguousarray(vectors.T)
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)
        self.labels, self.ids, self.missing, self.rows = labels, ids, missing, rows


def scan(slab: Slab, anchor: np.ndarray, candidates: np.ndarray, low: np.ndarray, high: np.ndarray | None):
    """Candidates whose score is in some window ``low`` to ``high`` (None: no upper end), and their scores."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    products = slab.least[order] * anchor[order], slab.most[order] * anchor[order]
    # What the dimensions from some place on can add.
    add_least = np.r_[np.cumsum(np.minimum(*products)[::-1])[::-1], 0]
    add_most = np.r_[np.cumsum(np.maximum(*products)[::-1])[::-1], 0]
    sums = np.zeros(len(candidates), slab.columns.dtype)
    whole = len(candidates) == slab.columns.shape[1]
    for start in range(0, len(order), STEP):
        dims = order[start : start + STEP]
        part = slab.columns[dims] if whole else slab.columns[dims[:, None], candidates]
        sums = sums + anchor[dims] @ part
        done = min(start + STEP, len(order))
        lowest, highest = sums + add_least[done], sums + add_most[done]
        alive = np.zeros(len(candidates), bool)
        for place in range(len(low)):
            inside = highest >= low[place]
            if high is not None:
                inside &= lowest <= high[place]
            alive |= inside
        if not alive.all():
            candidates, sums, whole = candidates[alive], sums[alive], False
            if not len(candidates):
                break
    return candidates, sums


class Found:
    """The first rows of a window of scores so far: score, whether the id is null, id, row."""

    def __init__(self, k: int, low: int | None, high: int | None):
        self.k, self.low, self.high = k, low, high
        self.rows = np.empty((0, 4), np.int64)

    def add(self, scores: np.ndarray, slab: Slab, places: np.ndarray) -> None:
        good = np.ones(len(scores), bool)
        if self.low is not None:
            good &= scores >= self.low
        if self.high is not None:
            good &= scores <= self.high
        if good.any():
            at = places[good]
            new = np.column_stack((scores[good].astype(np.int64), slab.missing[at], slab.ids[at], slab.rows[at]))
            rows = np.concatenate((self.rows, new))
            self.rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], -rows[:, 0]))[: self.k]]
            if len(self.rows) == self.k:
                self.low = int(self.rows[-1, 0])


LOWEST = -(2**62)


def _mined(anchors, width: int, same_label: bool, k: int, size: int):
    """Rows to the first ones of each anchor's windows in the task.

    An anchor is (row, label, vector, windows), a window (name, low, high).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = anchors.value
        windows = [[Found(k, low, high) for _, low, high in own] for _, _, _, own in given]

        def flush(waiting: list[pa.RecordBatch]) -> None:
            slab = _slab(pa.Table.from_batches(waiting), width)
            of_label = {label: np.flatnonzero(slab.labels == label) for label in np.unique(slab.labels).tolist()}
            none = np.empty(0, np.int64)
            others: dict[int, np.ndarray] = {}
            for (row, label, vector, _), own in zip(given, windows, strict=True):
                if same_label:
                    candidates = of_label.get(label, none)
                else:
                    if label not in others:
                        others[label] = np.flatnonzero(slab.labels != label)
                    candidates = others[label]
                if not len(candidates):
                    continue
                low = np.array([LOWEST if one.low is None else one.low for one in own])
                high = None if same_label else np.array([one.high for one in own])
                left, scores = scan(slab, vector.astype(slab.columns.dtype), candidates, low, high)
                if same_label:
                    other = slab.rows[left] != row
                    left, scores = left[other], scores[other]
                for one in own:
                    one.add(scores, slab, left)

        waiting, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                if waiting and rows + part.num_rows > size:
                    flush(waiting)
                    waiting, rows = [], 0
                waiting.append(part)
                rows += part.num_rows
        if waiting:
            flush(waiting)
        out = [
            (row, name, *found)
            for (row, _, _, named), own in zip(given, windows, strict=True)
            for (name, _, _), one in zip(named, own, strict=True)
            for found in one.rows.tolist()
        ]
        table = np.array(out, np.int64).reshape(-1, 6)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(table[:, 0]),
                pa.array(table[:, 1]),
                pa.array(table[:, 5]),
                pa.array(table[:, 4], mask=table[:, 3] > 0),
                pa.array(table[:, 2]),
            ],
            names=["anchor", "name", "row", "vec_id", "score"],
        )

    return run


def _slab(table: pa.Table, width: int) -> Slab:
    lists = table.column("vector").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    vectors = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    vectors[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    largest = int(np.abs(flat).max()) if len(flat) else 0
    # Doubles multiply faster and are exact while every sum stays below 2^52.
    kind = np.float64 if width * max(largest, 1) ** 2 < 2**40 else np.int64
    ids = table.column("vec_id")
    return Slab(
        vectors.astype(kind),
        table.column("label").to_numpy(),
        ids.fill_null(0).to_numpy(),
        ids.is_null().to_numpy(),
        table.column("row").to_numpy(),
    )


def usable_rows(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``(vec_id, label, vector, row)`` of the rows that take part, with the shifted labels."""
    rows = vectors.select(
        column(vectors, id_column).cast("long").alias("vec_id"),
        column(vectors, label_column).cast("long").alias("label"),
        column(vectors, vector_column).cast("array<double>").alias("parts"),
    )
    bad = "exists(parts, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    return rows.where(f"label is not null and parts is not null and not {bad}").selectExpr(
        "vec_id",
        "if(vec_id % 7 = 0, (label + 1) % 10, label) as label",
        "transform(parts, x -> cast(floor(256 * x) as bigint)) as vector",
        "monotonically_increasing_id() as row",
    )


def hard_negatives(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    slab: int = SLAB,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = stage(usable_rows(vectors, id_column, vector_column, label_column), "vectors")
    anchors = rows.where(F.col("vec_id") % every == 0)
    sizes = rows.agg(F.max(F.size("vector")).alias("width")).first()
    width = max(1, sizes["width"] or 0)
    blocks = max(1, math.ceil(anchors.count() / anchor_block))
    numbered = anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))

    def padded(vector: list[int]) -> np.ndarray:
        return np.array([*vector, *[0] * (width - len(vector))], np.int64)

    def mine(given: list, same_label: bool, k: int) -> DataFrame:
        sent = spark.sparkContext.broadcast(given)
        found = rows.mapInArrow(
            _mined(sent, width, same_label, k, slab), "anchor long, name long, row long, vec_id long, score long"
        )
        order = Window.partitionBy("anchor", "name").orderBy(
            F.desc("score"), F.col("vec_id").asc_nulls_last(), "row"
        )
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    results = []
    for block in range(blocks):
        own = numbered.where(F.col("block") == block).orderBy("row").collect()  # one block of anchors
        given = [(row["row"], row["label"], padded(row["vector"]), [(0, None, None)]) for row in own]
        firsts = stage(mine(given, True, positives), "positives")
        windows: dict[int, list] = {}
        for row in firsts.orderBy("anchor", "rank").collect():  # a few for each anchor of the block
            # Ends of the window in whole numbers: 30 p <= 100 s <= 90 p.
            low, high = -(-LEAST * row["score"] // 100), MOST * row["score"] // 100
            if low <= high:
                windows.setdefault(row["anchor"], []).append((row["rank"], low, high))
        asked = [(row, label, vector, windows[row]) for row, label, vector, _ in given if row in windows]
        found = mine(asked, False, negatives).select(
            "anchor", F.col("name").alias("place"), "rank", F.col("vec_id").alias("negative_id"),
            F.col("score").alias("negative_score"),
        )
        own_ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        known = firsts.select(
            "anchor", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
        joined = stage(found, "negatives").join(known, ["anchor", "place"]).join(own_ids, "anchor")
        results.append(
            joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        )
    result = results[0]
    for more in results[1:]:
        result = result.unionByName(more)
    return result
