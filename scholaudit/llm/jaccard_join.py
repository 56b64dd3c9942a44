"""Similarity join of documents by the Jaccard index of their word shingles, in regions around pivots.

The Jaccard distance d = 1 - |x & y| / |x | y| is a metric. Documents link
when their distance is at most r = 1 - threshold. The join is exact and works
on regions that shrink in two levels; texts with equal sets are one point.

First level: the pivots are single shingles. All documents that hold pivot s
are equally near to {s}, so the order of the pivots decides: a document's
region is that of its first shingle, and its window are the next ones. Two
linked documents differ in so few shingles that one of the first
n - ceil(threshold * n) + 1 shingles of either is in the other one too, so
these windows miss no link. Whole documents can't be the pivots here: unlike
texts are all about 1 apart, the windows of the triangle inequality then hold
everybody, and every region would be the corpus. Pivots are ordered by how
often they occur, as counted over all data in a sketch of fixed size, then by
hash; a common passage comes last and makes no region. Within a region the
triangle inequality of the size of the symmetric difference is used: with c_j
the shingles of x in hash class j, |x - y| + |y - x| >= sum |c_j(x) - c_j(y)|,
which tells almost all unlike pairs apart without their sets. It is used
twice, with 16 classes that travel with every point, and for the points that
have a partner left with n / 8 classes. What may still link is tied together
by a spanning forest, never by all pairs, and the components of these ties are
the regions of the second level.

Second level: whole documents are pivots. Each point is measured to some
pivots and goes to the cell of the nearest one and to every cell that is at
most 2r farther, which by the triangle inequality is enough for all links.
Points within r of a pivot are linked to it. Cells are joined again by the
same method, down to a small size or until the cells stop shrinking, and the
last pairs are compared directly unless they are already in one component.
Regions are packed into tasks by their number of shingles. A region too large
for a task stays spread out instead: blocks of its points, of bounded size,
are sent to all of its points, until all points outside of its largest
component have been sent.

What is returned is one row per document with its component; copies are never
expanded into pairs. Shingles and sets are identified by 64-bit hashes.

Defined cases: null text is the empty text. A document without words has the
empty set and links with nothing. Repeated rows are points of one set and
share its component. A null id is never the smallest of a component unless
there is no other. Empty tables give empty results. Further columns, whatever
their names, are ignored by ``link_components`` and carried along by
``one_per_component``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholaudit.llm.components import components
from scholaudit.llm.shared import column, fresh, ship_package, slices, stage, whole_text
from scholaudit.llm.words import forget_words, mixed, shingles, signed

SKETCH_BITS = 20  # the sketch of shingle counts has 2 ** 20 cells of 4 bytes
SKETCH_BLOCK = 4096
CLASSES = 16  # hash classes whose counts travel with every point
PER_CLASS = 8  # shingles of a set for each class of its fine profile, about
ROWS_PER_BUCKET = 250_000  # of the first level
HOT = 100_000  # a pivot more frequent than this ties its documents without looking at them
REGION_SHINGLES = 8_000_000  # a region with more of them isn't joined in one task
TASK_SHINGLES = 4_000_000  # regions are packed to about so many
PIVOTS, SMALL = 8, 48  # of the second level
BLOCK_SHINGLES = 4_000_000  # of the points of a large region sent at once
SENT_BYTES = 2_000_000  # of the points that a task hands over at once, or one bucket's

POINT = np.dtype([("shingle", "<u8"), ("key", "<i8"), ("n", "<i4"), ("profile", "u1", CLASSES)])


def shingle_set(text: bytes, size: int) -> np.ndarray:
    return np.unique(shingles(text.lower().split(), size))


def set_key(hashes: np.ndarray) -> int:
    """64 bits that identify a set."""
    total = mixed(hashes).sum(dtype=np.uint64)
    return signed(mixed(np.array([total ^ np.uint64(len(hashes))], np.uint64))).item()


def least_overlap(n, percent: int):
    """The shingles that a set of n shares at least with any linked set."""
    return (percent * n + 99) // 100


def profile(hashes: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Counts by hash class, modulo 256; those of half the classes are the sums of the two halves."""
    return np.bincount((hashes & np.uint64(classes - 1)).astype(np.int64), minlength=classes).astype(np.uint8)


def fine_classes(n):
    """A power of two: CLASSES at least, else from n / PER_CLASS up to twice that."""
    return 1 << max(CLASSES.bit_length() - 1, ((n - 1) // PER_CLASS).bit_length())


def may_link(n, profile_of, others_n, others_profile, percent: int) -> np.ndarray:
    """False where sizes or profiles show that the distance is too large.

    Two linked sets differ in at most (100 - percent) / (100 + percent) of the sum of their sizes.
    """
    fit = np.minimum(others_n, n) * 100 >= percent * np.maximum(others_n, n)
    gap = others_profile[fit] - profile_of
    gap = np.minimum(gap, -gap).sum(axis=-1, dtype=np.int64)
    fit[fit] = (100 + percent) * gap <= (100 - percent) * (others_n[fit] + n)
    return fit


def linked(first: np.ndarray, second: np.ndarray, percent: int) -> bool:
    common = _common(first, second)
    return 100 * common >= percent * (len(first) + len(second) - common)


def _common(first: np.ndarray, second: np.ndarray) -> int:
    both = np.concatenate((first, second))
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


class Forest:
    """Disjoint sets of points 0..n-1."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, point: int) -> int:
        parent = self.parent
        while parent[point] != point:
            parent[point] = parent[parent[point]]
            point = parent[point]
        return point

    def join(self, first: int, second: int) -> None:
        first, second = self.root(first), self.root(second)
        if first != second:
            self.parent[max(first, second)] = min(first, second)

    def roots(self, points) -> np.ndarray:
        return np.array([self.root(point) for point in points], np.int64)


# ---- first level


def _measure(size: int):
    """Rows of documents with their set's key, and at the end the task's part of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        waiting, rows = [], 0

        def count() -> None:
            nonlocal rows
            cells = np.concatenate(waiting)
            waiting.clear()
            cells >>= np.uint64(64 - SKETCH_BITS)
            np.add(sketch, np.bincount(cells.view(np.int64), minlength=len(sketch)), out=sketch)
            rows = 0

        for batch in slices(batches):
            keys, counts, fine = [], [], []
            for text in batch.column(2):
                hashes = shingle_set(text.as_buffer().to_pybytes(), size)
                keys.append(set_key(hashes))
                counts.append(len(hashes))
                fine.append(profile(hashes, fine_classes(len(hashes))).tobytes())
                waiting.append(hashes)
                rows += len(hashes)
                if rows > 2_000_000:
                    count()
            none = pa.nulls(len(keys), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(fine, pa.binary()), none, pa.nulls(len(keys), pa.binary())],
                names=["doc_id", "text_hash", "key", "n_shingles", "fine", "block", "counts"],
            )
            ids = batch.schema.field(0).type
        if rows:
            count()
        forget_words()
        used = np.flatnonzero(sketch.reshape(-1, SKETCH_BLOCK).any(axis=1))
        if len(used):
            blocks = np.minimum(sketch, 2**32 - 1).astype("<u4").reshape(-1, SKETCH_BLOCK)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(used), ids), *[pa.nulls(len(used), pa.int64())] * 3, pa.nulls(len(used), pa.binary()),
                 pa.array(used, pa.int32()), pa.array([blocks[place].tobytes() for place in used], pa.binary())],
                names=["doc_id", "text_hash", "key", "n_shingles", "fine", "block", "counts"],
            )

    return run


def measured_documents(docs: DataFrame, size: int, id_column: str, text_column: str) -> tuple[DataFrame, np.ndarray]:
    """``(doc_id, text_hash, key, n_shingles, fine profile)`` of every row, and the sketch of all shingles' counts."""
    text = whole_text(docs, text_column)
    rows = docs.select(
        column(docs, id_column).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, key long, n_shingles long, fine binary, block int, counts binary"
    both = stage(rows.mapInArrow(_measure(size), schema), "sets_and_counts")

    def add(parts: pa.Table) -> pa.Table:
        total = np.zeros(SKETCH_BLOCK, np.int64)
        for part in parts.column("counts"):
            total += np.frombuffer(part.as_buffer(), "<u4")
        total = np.minimum(total, 2**32 - 1).astype("<u4").tobytes()
        return pa.table({"block": pa.array([parts.column("block")[0].as_py()], pa.int32()), "counts": [total]})

    sums = both.where("block is not null").select("block", "counts").groupBy("block")
    sketch = np.zeros((1 << SKETCH_BITS) // SKETCH_BLOCK * SKETCH_BLOCK, "<u4").reshape(-1, SKETCH_BLOCK)
    for row in sums.applyInArrow(add, "block int, counts binary").collect():  # 4 MB at most
        sketch[row["block"]] = np.frombuffer(row["counts"], "<u4")
    return both.where("block is null").drop("block", "counts"), sketch.ravel()


def windows(hashes: np.ndarray, sketch: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pivots whose regions a set belongs to, and their counts."""
    counts = sketch[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    length = len(hashes) - least_overlap(len(hashes), percent) + 1
    order = np.lexsort((hashes, counts))[:length]
    return hashes[order], counts[order]


def _runs(rows: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Runs of rows as binary values that share the rows' memory."""
    offsets = (np.r_[starts, len(rows)] * rows.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _regions(size: int, percent: int, buckets: int, hot: int, sketch):
    """Blocks of points by bucket of their pivot; hot pivots get rows of their own (bucket null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, seen, waiting, rows = sketch.value, set(), [], 0

        def dealt() -> Iterator[pa.RecordBatch]:
            points = np.concatenate(waiting)
            waiting.clear()
            bucket = (mixed(points["shingle"]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            points, bucket = points[order], bucket[order]
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            blocks = pa.RecordBatch.from_arrays(
                [pa.array(bucket[starts], pa.int32()), pa.nulls(len(starts), pa.int64()),
                 pa.nulls(len(starts), pa.int64()), _runs(points, starts)],
                names=["bucket", "shingle", "key", "points"],
            )
            yield from slices([blocks], max(1, SENT_BYTES * len(starts) // points.nbytes))

        for batch in slices(batches):
            for text in batch.column(0):
                hashes = shingle_set(text.as_buffer().to_pybytes(), size)
                key = set_key(hashes)
                if not len(hashes) or key in seen:
                    continue
                if len(seen) >= 500_000:
                    seen.clear()
                seen.add(key)
                pivots, counts = windows(hashes, counted, percent)
                often = counts > hot
                if often.any():
                    pivots, frequent = pivots[~often], signed(pivots[often])
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(frequent), pa.int32()), pa.array(frequent),
                         pa.array([key] * len(frequent), pa.int64()), pa.nulls(len(frequent), pa.binary())],
                        names=["bucket", "shingle", "key", "points"],
                    )
                points = np.empty(len(pivots), POINT)
                points["shingle"], points["key"], points["n"] = pivots, key, len(hashes)
                points["profile"] = profile(hashes)
                waiting.append(points)
                rows += len(points)
                if rows > 400_000:
                    yield from dealt()
                    rows = 0
        seen.clear()
        forget_words()
        if rows:
            yield from dealt()

    return run


def _starts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values start and end."""
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)
    return starts, np.r_[starts[1:], len(values)]


def _partnered(percent: int):
    """``(bucket, shingle, key)`` of a bucket's points with a partner that the coarse profiles allow."""

    def run(table: pa.Table) -> pa.Table:
        points = np.concatenate([np.frombuffer(part.as_buffer(), POINT) for part in table.column("points")])
        points = points[np.lexsort((points["key"], points["shingle"]))]
        same = (points["shingle"][1:] == points["shingle"][:-1]) & (points["key"][1:] == points["key"][:-1])
        points = points[np.r_[True, ~same]]
        partnered = np.zeros(len(points), bool)
        starts, ends = _starts(points["shingle"])
        several = ends - starts > 1
        for start, end in zip(starts[several].tolist(), ends[several].tolist(), strict=True):
            n, profiles = points["n"][start:end].astype(np.int64), points["profile"][start:end]
            for place in range(end - start - 1):
                fit = may_link(n[place], profiles[place], n[place + 1 :], profiles[place + 1 :], percent)
                if fit.any():
                    partnered[start + place] = True
                    partnered[start + place + 1 : end] |= fit
        kept = points[partnered]
        bucket = table.column("bucket")[0].as_py()
        return pa.table(
            {"bucket": pa.array([bucket] * len(kept), pa.int32()), "shingle": signed(kept["shingle"].copy()),
             "key": kept["key"].copy()}
        )

    return run


def _ties(percent: int):
    """A spanning forest of the pairs in a bucket's regions that the fine profiles allow."""

    def run(table: pa.Table) -> pa.Table:
        shingle, key = (table.column(name).to_numpy() for name in ("shingle", "key"))
        keys, first, place = np.unique(key, return_index=True, return_inverse=True)
        sizes = table.column("n_shingles").to_numpy()[first].astype(np.int64)
        fine = [np.frombuffer(table.column("fine")[row].as_buffer(), np.uint8) for row in first.tolist()]
        order = np.lexsort((sizes[place], shingle))
        shingle, place = shingle[order], place[order]
        forest = Forest(len(keys))
        for start, end in zip(*(ends.tolist() for ends in _starts(shingle)), strict=True):
            # By size, so that the others have as many classes as the point itself, or twice as many.
            nodes = place[start:end]
            n = sizes[nodes]
            classes = np.array([len(fine[node]) for node in nodes.tolist()])
            stacked: dict[int, tuple[int, int, np.ndarray]] = {}
            for size in np.unique(classes).tolist():
                low, high = np.searchsorted(classes, (size, size + 1))
                stacked[size] = (int(low), int(high), np.array([fine[node] for node in nodes[low:high].tolist()]))
            for here, (node, many) in enumerate(zip(nodes.tolist(), classes.tolist(), strict=True)):
                for size in (many, 2 * many):
                    low, high, profiles = stacked.get(size, (0, 0, None))
                    begin, stop = max(low, here + 1), int(np.searchsorted(n, n[here] * 100 // percent + 1))
                    stop = min(stop, high)
                    if begin >= stop:
                        continue
                    profiles = profiles[begin - low : stop - low]
                    if size != many:
                        profiles = profiles[:, :many] + profiles[:, many:]
                    found = may_link(n[here], fine[node], n[begin:stop], profiles, percent)
                    for other in nodes[begin:stop][found].tolist():
                        forest.join(node, other)
        nodes = np.arange(len(keys))
        roots = forest.roots(nodes)
        tied = nodes != roots
        return pa.table({"key": pa.array(keys[tied]), "root": pa.array(keys[roots[tied]])})

    return run


def tied_points(
    docs: DataFrame, measured: DataFrame, size: int, percent: int, sketch: np.ndarray, text_column: str, hot: int
) -> DataFrame:
    """Edges ``(key, root)`` that connect all points that may link."""
    counted = docs.sparkSession.sparkContext.broadcast(sketch)
    window = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / F.lit(100)) + 1
    rows = measured.where("n_shingles > 0").agg(F.sum(window)).first()[0] or 0
    buckets = max(1, math.ceil(int(rows) / ROWS_PER_BUCKET))
    points = docs.select(whole_text(docs, text_column).alias("text")).mapInArrow(
        _regions(size, percent, buckets, hot, counted), "bucket int, shingle long, key long, points binary"
    )
    some_hot = int(sketch.max(initial=0)) > hot
    if some_hot:
        points = stage(points, "regions")
    partnered = (
        points.where("bucket is not null")
        .groupBy("bucket")
        .applyInArrow(_partnered(percent), "bucket int, shingle long, key long")
    )
    partnered = stage(partnered, "partnered_points")
    fine = measured.where("n_shingles > 0").groupBy("key").agg(F.first("n_shingles").alias("n_shingles"), F.first("fine").alias("fine"))
    ties = (
        partnered.join(fine, "key")
        .select("bucket", "shingle", "key", "n_shingles", "fine")
        .groupBy("bucket")
        .applyInArrow(_ties(percent), "key long, root long")
    )
    if not some_hot:
        return ties
    frequent = points.where("bucket is null").select("shingle", "key").distinct()
    centres = stage(frequent.groupBy("shingle").agg(F.min("key").alias("root")), "hot_pivots")
    return ties.unionByName(frequent.join(centres, "shingle").where("key <> root").select("key", "root"))


# ---- second level


class Region:
    """Points with their sets, joined in this task."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.n = np.array([len(hashes) for hashes in sets], np.int64)
        classes = fine_classes(int(np.median(self.n)))
        self.profiles = np.array([profile(mixed(hashes), classes) for hashes in sets])
        self.forest = Forest(len(sets))

    def distance(self, first: int, second: int) -> float:
        common = _common(self.sets[first], self.sets[second])
        return 1 - common / (self.n[first] + self.n[second] - common)

    def compare(self, points: np.ndarray) -> None:
        """Link directly; pairs in one component need no look."""
        for place, point in enumerate(points.tolist()):
            others = points[place + 1 :]
            fit = may_link(self.n[point], self.profiles[point], self.n[others], self.profiles[others], self.percent)
            for other in others[fit].tolist():
                if self.forest.root(point) != self.forest.root(other) and linked(
                    self.sets[point], self.sets[other], self.percent
                ):
                    self.forest.join(point, other)

    def join(self, points: np.ndarray) -> None:
        if len(points) <= SMALL:
            self.compare(points)
            return
        pivots = points[np.linspace(0, len(points) - 1, PIVOTS).astype(np.int64)]
        distances = np.array([[self.distance(point, pivot) for pivot in pivots] for point in points.tolist()])
        reach = 1 - self.percent / 100 + 1e-9
        for place, point in enumerate(points.tolist()):
            for pivot in np.flatnonzero(distances[place] <= reach).tolist():
                if linked(self.sets[point], self.sets[pivots[pivot]], self.percent):
                    self.forest.join(point, int(pivots[pivot]))
        nearest = distances.min(axis=1, keepdims=True)
        cells = distances - nearest <= 2 * reach
        if cells.sum(axis=0).max() > 0.7 * len(points):
            self.compare(points)
            return
        for cell in cells.T:
            if cell.any():
                self.join(points[cell])


def _join_regions(percent: int):
    def run(table: pa.Table) -> pa.Table:
        regions: dict[int, dict[int, np.ndarray]] = {}
        for region, key, hashes in zip(
            table.column("region").to_pylist(), table.column("key").to_pylist(), table.column("hashes"), strict=True
        ):
            regions.setdefault(region, {}).setdefault(key, np.frombuffer(hashes.as_buffer(), "<u8"))
        keys, roots = [], []
        for points in regions.values():
            names = sorted(points)
            joined = Region([points[name] for name in names], percent)
            joined.join(np.arange(len(names)))
            for place, name in enumerate(names):
                keys.append(name)
                roots.append(names[joined.forest.root(place)])
        return pa.table({"key": pa.array(keys, pa.int64()), "root": pa.array(roots, pa.int64())})

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep, sets = [], []
            for place, (text, key) in enumerate(zip(batch.column("text"), batch.column("key").to_pylist(), strict=True)):
                hashes = shingle_set(text.as_buffer().to_pybytes(), size)
                if set_key(hashes) == key:
                    keep.append(place)
                    sets.append(hashes.astype("<u8").tobytes())
            kept = batch.drop_columns(["text"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sets, pa.binary())], [*kept.schema.names, "hashes"])
        forget_words()

    return run


def _send_block(block: list[tuple[int, int, bytes]], percent: int):
    """Compares all points of large regions with some of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[int, tuple[list, list, np.ndarray, np.ndarray]] = {}
        for region in {row[0] for row in block}:
            keys = [row[1] for row in block if row[0] == region]
            sets = [np.frombuffer(row[2], "<u8") for row in block if row[0] == region]
            sizes = np.array([len(hashes) for hashes in sets], np.int64)
            classes = fine_classes(int(np.median(sizes)))
            sent[region] = (keys, sets, sizes, np.array([profile(mixed(hashes), classes) for hashes in sets]))
        for batch in slices(batches):
            pairs = []
            for region, key, hashes in zip(
                batch.column("region").to_pylist(), batch.column("key").to_pylist(), batch.column("hashes"), strict=True
            ):
                if region in sent:
                    keys, sets, sizes, profiles = sent[region]
                    values = np.frombuffer(hashes.as_buffer(), "<u8")
                    own = profile(mixed(values), profiles.shape[1])
                    for place in np.flatnonzero(may_link(len(values), own, sizes, profiles, percent)).tolist():
                        if keys[place] != key and linked(values, sets[place], percent):
                            pairs.append((key, keys[place]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([pair[0] for pair in pairs], pa.int64()), pa.array([pair[1] for pair in pairs], pa.int64())],
                names=["key", "root"],
            )

    return run


def join_large_regions(spark: SparkSession, points: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """``(key, root)`` for points ``(region, key, n_shingles, hashes)`` that stay where they are.

    Each round sends a block of points to all. A link between two components
    has an end outside of the region's largest one, so it is found at the
    latest when all points outside of the largest components have been sent.
    """
    links = spark.createDataFrame([], "key long, root long")
    sent = spark.createDataFrame([], "key long")
    everyone = points.select("region", "key", "n_shingles")
    while True:
        labels = components(links, "key", "root").withColumnsRenamed({"node": "key"})
        known = stage(
            everyone.join(labels, "key", "left").withColumn("root", F.coalesce("root", "key")), "known_components"
        )
        sizes = known.groupBy("region", "root").agg(F.count(F.lit(1)).alias("points"))
        largest = stage(
            sizes.groupBy("region").agg(F.max_by("root", F.struct("points", "root")).alias("largest")), "largest"
        )
        waiting = known.join(largest, "region").where("root <> largest").join(sent, "key", "left_anti")
        # The next block: as many points, by hash, as fit its size; a long one goes alone.
        chosen, total = [], 0
        for row in waiting.orderBy(F.xxhash64("key")).select("key", "n_shingles").limit(4096).collect():
            if chosen and total + row["n_shingles"] > block_shingles:
                break
            chosen.append(row["key"])
            total += row["n_shingles"]
        if not chosen:
            return known.select("key", "root")
        block = [
            (row["region"], row["key"], bytes(row["hashes"]))
            for row in points.where(F.col("key").isin(chosen)).select("region", "key", "hashes").collect()
        ]
        found = points.select("region", "key", "hashes").mapInArrow(_send_block(block, percent), "key long, root long")
        links = stage(links.unionByName(found), "links")
        sent = stage(sent.unionByName(spark.createDataFrame([(key,) for key in chosen], "key long")), "sent")


def set_components(
    docs: DataFrame,
    measured: DataFrame,
    sketch: np.ndarray,
    size: int,
    percent: int,
    id_column: str,
    text_column: str,
    hot: int,
    region_shingles: int,
    block_shingles: int,
) -> DataFrame:
    """``(key, root)`` of all sets that may link with another one."""
    spark = docs.sparkSession
    ties = tied_points(docs, measured, size, percent, sketch, text_column, hot)
    regions = components(ties, "key", "root").withColumnsRenamed({"node": "key", "root": "region"})

    first = F.min(F.struct("text_hash", F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("first")
    candidates = stage(
        measured.join(regions, "key").groupBy("key", "region", "n_shingles").agg(first), "region_points"
    )
    extents = stage(candidates.groupBy("region").agg(F.sum("n_shingles").alias("extent")), "region_extents")
    totals = extents.agg(F.sum("extent").alias("all"), F.max("extent").alias("most")).first()
    buckets = max(1, math.ceil((totals["all"] or 0) / TASK_SHINGLES))

    texts = docs.select(
        column(docs, id_column).alias("doc_id"), whole_text(docs, text_column).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    members = candidates.join(extents, "region").select(
        "key", "region", "n_shingles", "extent",
        F.col("first.text_hash").alias("first_hash"), F.col("first.doc_id").alias("first_id"),
    )
    wanted = (
        texts.join(members, (F.col("text_hash") == F.col("first_hash")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
        .select("region", "key", "n_shingles", "extent", "text")
        .mapInArrow(_sets(size), "region long, key long, n_shingles long, extent long, hashes binary")
    )
    wanted = stage(wanted, "region_sets")
    joined = (
        wanted.where(F.col("extent") <= region_shingles)
        .withColumn("bucket", F.pmod(F.xxhash64("region"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInArrow(_join_regions(percent), "key long, root long")
    )
    if (totals["most"] or 0) > region_shingles:
        large = stage(
            wanted.where(F.col("extent") > region_shingles).drop("extent").dropDuplicates(["key"]), "large_regions"
        )
        joined = joined.unionByName(join_large_regions(spark, large, percent, block_shingles))
    return stage(joined, "set_components")


def _components_of_rows(docs, size, percent, id_column, text_column, hot, region_shingles, block_shingles):
    measured, sketch = measured_documents(docs, size, id_column, text_column)
    roots = set_components(
        docs, measured, sketch, size, percent, id_column, text_column, hot, region_shingles, block_shingles
    )
    return stage(
        measured.join(roots, "key", "left").select(
            "doc_id", "text_hash", "n_shingles", F.coalesce("root", "key").alias("component")
        ),
        "row_components",
    )


def link_components(
    docs: DataFrame,
    size: int = 3,
    percent: int = 90,
    id_column: str = "doc_id",
    text_column: str = "text",
    hot: int = HOT,
    region_shingles: int = REGION_SHINGLES,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id (the smallest doc_id of its component)."""
    ship_package(docs.sparkSession)
    rows = _components_of_rows(
        docs, size, percent, id_column, text_column, hot, region_shingles, block_shingles
    )
    least = stage(
        rows.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id")), "least_ids"
    )
    some = rows.where("n_shingles > 0").join(least, "component").select("doc_id", "n_shingles", "component_id")
    none = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.unionByName(none)


def one_per_component(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
    hot: int = HOT,
    region_shingles: int = REGION_SHINGLES,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """The row with the smallest id (null last) of each component, with the columns of ``docs``.

    Documents without words all stay, but for repeated rows of one id.
    """
    ship_package(docs.sparkSession)
    rows = _components_of_rows(
        docs, size, percent, id_column, text_column, hot, region_shingles, block_shingles
    )
    row_id = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_hash"))
    some = rows.where("n_shingles > 0").groupBy("component").agg(F.min(row_id).alias("first"))
    none = rows.where("n_shingles = 0").select(row_id.alias("first")).distinct()
    keep_id, keep_hash = fresh(docs, "kept_id"), fresh(docs, "kept_hash")
    stay = stage(
        some.select("first").unionByName(none).select(
            F.col("first.doc_id").alias(keep_id), F.col("first.text_hash").alias(keep_hash)
        ),
        "rows_that_stay",
    )
    own_hash = F.xxhash64(whole_text(docs, text_column))
    kept = docs.join(
        stay, (own_hash == F.col(keep_hash)) & column(docs, id_column).eqNullSafe(F.col(keep_id)), "left_semi"
    )
    repeated = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():
        return kept
    marked = kept.withColumn(keep_hash, F.xxhash64(whole_text(kept, text_column)))
    return marked.dropDuplicates([id_column, keep_hash]).select(*[column(marked, name) for name in docs.columns])
