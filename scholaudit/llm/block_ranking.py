"""Ranked lexical search with geometric blocking of posting lists.

Terms are the maximal runs of ASCII letters and figures and of all characters
beyond ASCII, with only A-Z lower-cased. A term's weight grows with its rarity,
a posting's impact with its uses in the document against the document's length
(``impacts``); a document's score for an item is the sum of weight times impact
over the item's terms, all in 64-bit integers.

Documents become vectors of impacts over the terms that any item has, so one
pass over the texts is enough. They are indexed in shards of at most
``shard`` documents, each within one task. In a shard each term's posting list
is cut into blocks of documents that are alike: every document joins the
most similar of a few representatives of the list, by the inner product of
sketched vectors. A block stores its coordinatewise maximum. An item goes
through its terms' lists, those that can add most first. Documents of earlier
lists are done, so a block is bounded by its maxima over this and the later
terms; it is skipped only if this exact bound is below the item's tenth score
so far, and the search ends once all later lists together are. The lists of a
shard are blocked when an item first needs them.

The tenth score starts as that of a sample of the documents, which no tenth
score over all documents can be below, and rises within a task. Tasks hand on
their best documents per item, and a window in Spark ranks them. Items are
taken in blocks of about ``item_block``, each of them sent to the tasks; the
document vectors, the counts and the results stay in Spark.

Defined cases: null texts and texts without terms hold nothing and are counted
nowhere; such items get no rows. Repeated document rows are documents each,
repeated item rows items each. Equal scores rank by doc_id, a null id last.
Very long texts are one document; empty tables give an empty result. Further
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholaudit.llm.shared import column, ship_package, slices, stage, whole_text

SHARD = 8_192
ITEM_BLOCK = 2_000
SAMPLE = 16_384  # documents, about
BLOCK = 128  # documents in a block, about
SKETCH = 32
CHUNK = 8  # blocks looked at before the tenth score is taken anew

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM_TEXT = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(data: bytes) -> list[bytes]:
    """In UTF-8 all bytes of characters beyond ASCII are 0x80 or more."""
    return TERM.findall(data.lower())


def impacts(uses: np.ndarray, length: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Of postings, from the term's uses and the number of terms in the document."""
    norm = 10 + (90 * length * documents) // max(1, terms)
    return (1_000_000_000 * uses) // (1000 * uses + 8 * norm)


# ---- one shard


class Shard:
    """Vectors of some documents, and the posting lists cut from them.

    ``start`` has one more entry than there are documents; the terms and
    impacts of document d are at ``start[d]`` up to ``start[d + 1]``.
    """

    def __init__(self, start: np.ndarray, terms: np.ndarray, impact: np.ndarray, weights: np.ndarray):
        self.start, self.terms, self.impact = start, terms, impact
        self.count = len(start) - 1
        self.size = np.diff(start)
        self.owner = np.repeat(np.arange(self.count), self.size)
        order = np.argsort(terms, kind="stable")
        self.known, first = np.unique(terms[order], return_index=True)
        self.postings = np.split(self.owner[order], first[1:]) if len(first) else []
        highest = np.maximum.reduceat(impact[order], first) if len(first) else np.empty(0, np.int64)
        self.place = dict(zip(self.known.tolist(), range(len(self.known)), strict=True))
        self.local = np.searchsorted(self.known, terms)
        self.highest = highest * weights[self.known]
        self.blocks: dict[int, tuple] = {}
        self.sketches = self._sketched(weights)

    def _sketched(self, weights: np.ndarray) -> np.ndarray:
        """Vectors folded into a few dimensions with signs, which keeps inner products roughly."""
        mark = _spread(self.terms)
        place, sign = (mark % SKETCH).astype(np.int64), np.where(mark & 64, 1.0, -1.0)
        value = weights[self.terms] * self.impact * sign
        flat = np.bincount(self.owner * SKETCH + place, value, self.count * SKETCH)
        result = flat.reshape(self.count, SKETCH).astype(np.float32)
        return result / np.maximum(np.linalg.norm(result, axis=1, keepdims=True), 1e-9)

    def blocked(self, place: int) -> tuple[list[np.ndarray], np.ndarray]:
        """A list's blocks of documents, and their maxima (block, term of the shard)."""
        if place not in self.blocks:
            docs = self.postings[place]
            leaders = docs[::BLOCK]
            nearest = np.argmax(self.sketches[docs] @ self.sketches[leaders].T, axis=1)
            used, group = np.unique(nearest, return_inverse=True)
            maxima = np.zeros((len(used), len(self.known)), np.int64)
            rows = _ranges(self.start[docs], self.size[docs])
            at = np.repeat(group, self.size[docs]) * len(self.known) + self.local[rows]
            np.maximum.at(maxima.reshape(-1), at, self.impact[rows])
            order = np.argsort(group, kind="stable")
            self.blocks[place] = (np.split(docs[order], np.cumsum(np.bincount(group))[:-1]), maxima)
        return self.blocks[place]

    def scores(self, docs: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Of documents, for an item given as weights over the shard's terms."""
        rows = _ranges(self.start[docs], self.size[docs])
        ends = np.cumsum(self.size[docs])
        sums = np.r_[0, np.cumsum(item[self.local[rows]] * self.impact[rows])]
        return sums[ends] - sums[ends - self.size[docs]]


def _spread(terms: np.ndarray) -> np.ndarray:
    return (terms.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of some runs, one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - size), size)


class Best:
    """An item's best documents so far: score, whether the id is null, id."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.rows = np.empty((0, 3), np.int64)

    def add(self, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= max(1, self.floor)
        if good.any():
            rows = np.concatenate((self.rows, np.column_stack((scores[good], missing[good], ids[good]))))
            self.rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))[: self.k]]
            if len(self.rows) == self.k:
                self.floor = max(self.floor, int(self.rows[-1, 0]))


def search(shard: Shard, terms: np.ndarray, weights: np.ndarray, best: Best, missing: np.ndarray, ids: np.ndarray) -> int:
    """Put the shard's best documents for an item's terms into ``best``; the number of documents scored."""
    places = [shard.place[term] for term in terms.tolist() if term in shard.place]
    places = sorted((place for place in places if shard.highest[place] > 0), key=lambda place: -shard.highest[place])
    if not places:
        return 0
    item = np.zeros(len(shard.known), np.int64)
    item[places] = weights[shard.known[places]]
    left = np.cumsum(shard.highest[places][::-1])[::-1]
    done = np.zeros(shard.count, bool)
    scored = 0
    for turn, place in enumerate(places):
        if left[turn] < best.floor:
            break
        members, maxima = shard.blocked(place)
        later = places[turn:]
        bounds = maxima[:, later] @ item[later]
        order = np.argsort(-bounds, kind="stable")
        for start in range(0, len(order), CHUNK):
            chosen = [block for block in order[start : start + CHUNK] if bounds[block] >= max(1, best.floor)]
            if not chosen:
                break
            docs = np.concatenate([members[block] for block in chosen])
            docs = docs[~done[docs]]
            done[docs] = True
            scored += len(docs)
            best.add(shard.scores(docs, item), missing[docs], ids[docs])
        # Documents of skipped blocks are done as well: no later list can lift them.
        done[shard.postings[place]] = True
    return scored


# ---- Spark


def _vectors(vocabulary):
    """``(doc_id, text)`` to doc_id, number of terms, and the items' terms with their uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in slices(batches):
            lengths, ends, terms, uses = [], [0], [], []
            for text in batch.column(1):
                counted = Counter(terms_of(text.as_buffer().to_pybytes()))
                lengths.append(counted.total())
                own = sorted((known[term], n) for term, n in counted.items() if term in known)
                terms += [term for term, _ in own]
                uses += [n for _, n in own]
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(uses, pa.int32())),
                ],
                names=["doc_id", "n_terms", "terms", "uses"],
            )

    return run


def _searched(items, documents: int, terms: int, k: int, size: int):
    """Vectors to each item's best documents of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, item_terms, weights, floors = items.value
        best = [Best(k, floor) for floor in floors]
        waiting: list[pa.RecordBatch] = []

        def flush() -> None:
            rows = pa.Table.from_batches(waiting).combine_chunks()
            waiting.clear()
            lists = rows.column("terms").combine_chunks(), rows.column("uses").combine_chunks()
            lists = [own.chunk(0) if isinstance(own, pa.ChunkedArray) else own for own in lists]
            start = np.r_[0, np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
            term = lists[0].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            use = lists[1].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            length = np.repeat(rows.column("n_terms").to_numpy(), np.diff(start))
            shard = Shard(start, term, impacts(use, length, documents, terms), weights)
            ids = rows.column("doc_id")
            missing, filled = ids.is_null().to_numpy(), ids.fill_null(0).to_numpy()
            for own, wanted in zip(best, item_terms, strict=True):
                search(shard, wanted, weights, own, missing, filled)

        rows = 0
        for batch in batches:
            # Shards hold all their documents, even where a batch is larger.
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                if rows + part.num_rows > size and waiting:
                    flush()
                    rows = 0
                waiting.append(part)
                rows += part.num_rows
        if waiting:
            flush()
        found = np.concatenate([own.rows for own in best]) if best else np.empty((0, 3), np.int64)
        owner = np.repeat(np.array(numbers, np.int64), [len(own.rows) for own in best])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(owner, pa.int64()),
                pa.array(found[:, 2], pa.int64(), mask=found[:, 1] > 0),
                pa.array(found[:, 0], pa.int64()),
            ],
            names=["item", "doc_id", "score"],
        )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(vectors: DataFrame, items: DataFrame, vocabulary: list[bytes], totals, k: int, shard: int) -> DataFrame:
    """One block of items against all documents."""
    context = vectors.sparkSession.sparkContext
    documents, terms = totals
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("held"))
    # One row for each term of the block's items.
    weight = F.floor(1000 * F.log((F.lit(2 * documents + 2).cast("double")) / (2 * F.col("held") + 1)))
    weights = np.zeros(len(vocabulary), np.int64)
    for row in held.select("term", weight.alias("weight")).collect():
        weights[row["term"]] = row["weight"]

    numbers, item_terms = [], []
    known = {term: place for place, term in enumerate(vocabulary)}
    for row in items.orderBy("item").collect():
        numbers.append(row["item"])
        item_terms.append(np.array(sorted(known[term.encode()] for term in row["terms"]), np.int64))

    def best(rows: DataFrame, floors: list[int]) -> DataFrame:
        sent = context.broadcast((numbers, item_terms, weights, floors))
        found = rows.mapInArrow(_searched(sent, documents, terms, k, shard), "item long, doc_id long, score long")
        return _ranked(found, k)

    parts = max(1, math.ceil(documents / SAMPLE))
    sample = vectors.where(F.pmod(F.xxhash64("doc_id", "n_terms"), F.lit(parts)) == 0)
    floors = dict.fromkeys(numbers, 0)
    for row in best(sample, [0] * len(numbers)).where(F.col("rank") == k).collect():  # one row an item
        floors[row["item"]] = row["score"]
    return best(vectors, list(floors.values()))


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    shard: int = SHARD,
    item_block: int = ITEM_BLOCK,
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    ship_package(spark)
    words = F.regexp_extract_all(F.translate(whole_text(items, item_text_column), UPPER, LOWER), F.lit(TERM_TEXT), F.lit(0))
    asked = items.select(column(items, item_column).alias("item_id"), F.array_distinct(words).alias("terms"))
    asked = stage(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    blocks = max(1, math.ceil(asked.count() / item_block))
    rows = docs.select(column(docs, id_column).cast("long").alias("doc_id"), whole_text(docs, text_column).alias("text"))
    ranked = []
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        words = part.select(F.explode("terms").alias("term")).distinct().orderBy("term")
        vocabulary = [row["term"].encode() for row in words.collect()]  # of one block
        sent = spark.sparkContext.broadcast({term: place for place, term in enumerate(vocabulary)})
        kind = "doc_id long, n_terms long, terms array<int>, uses array<int>"
        vectors = stage(rows.mapInArrow(_vectors(sent), kind).where("n_terms > 0"), "vectors")
        total = vectors.agg(F.count(F.lit(1)).alias("n"), F.sum("n_terms").alias("terms")).first()
        ranked.append(stage(_block(vectors, part, vocabulary, (total["n"], total["terms"] or 0), k, shard), "ranked"))
    result = ranked[0]
    for more in ranked[1:]:
        result = result.unionByName(more)
    return result.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
