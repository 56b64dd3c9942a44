"""Quality classifier by co-training of a text view and a metadata view.

The text view sees hashed words and word shapes; the metadata view sees the
source, the language, the length and the layout (lines, their lengths, and the
shares of capitals, digits and marks). Both are logistic regressions in numpy,
first fitted on the labelled documents. In each round both score all documents
without a label; for each view and class, the documents that the view is
surest of receive its label and join the training rows of the other view;
documents with equal features are one example. In
the end each view is calibrated on labelled documents that were never trained
on, the calibrated views are combined there, and all documents are scored.

Bounds, all of them parameters: the labelled rows to train on and those to
calibrate on are the first ones by hash, at most ``max_train`` and
``max_calibrate``; a round adds at most ``grow`` documents per view and class.
Only these rows reach the driver. Everything else covers all documents, in
Spark: features are made once and written, and each round scores all of them.

Defined cases: null text is the empty text; null source, language or length
are values of their own, and so are columns that are not there. Very long texts
are one document. Documents with contradicting labels, or a null one,
count as unlabelled. Repeated rows are scored each. Without labels of both
classes every score is 0.5, and every document is kept. Empty tables give
empty results. Further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholaudit.llm.shared import column, ship_package, slices, stage, whole_text
from scholaudit.llm.words import mixed, word_hashes

TEXT_BITS, META_BITS = 14, 12
VIEWS = {"text": 1 << TEXT_BITS, "meta": 1 << META_BITS}
MAX_TRAIN, MAX_CALIBRATE, GROW, ROUNDS = 8_000, 4_000, 400, 3
STEPS, RATE, DECAY = 120, 0.5, 1e-5
THRESHOLD = 0.5

FEATURE = np.dtype([("place", "<u2"), ("value", "<f4")])
LETTERS = regex.compile(rb"[A-Za-z\x80-\xff]+")
FIGURES = regex.compile(rb"[0-9]+")


def _features(places: np.ndarray, values: np.ndarray) -> bytes:
    """Distinct places with their summed values, scaled to length one."""
    places, inverse = np.unique(places, return_inverse=True)
    sums = np.bincount(inverse, weights=values, minlength=len(places))
    length = math.sqrt(float((sums * sums).sum()))
    result = np.empty(len(places), FEATURE)
    result["place"], result["value"] = places, sums / length if length else sums
    return result.tobytes()


def text_features(data: bytes) -> bytes:
    words = data.lower().split()
    shapes = [FIGURES.sub(b"0", LETTERS.sub(b"a", word)) for word in words]
    hashes = np.concatenate((word_hashes(words), mixed(word_hashes(shapes) + np.uint64(1))))
    places, counts = np.unique((mixed(hashes) >> np.uint64(64 - TEXT_BITS)).astype(np.int64), return_counts=True)
    return _features(places, np.log1p(counts))


def _steps(name: str, value: float) -> list[bytes]:
    """A number as the thresholds that it reaches, on a scale of powers."""
    reached = int(max(0, math.log(max(value, 1e-6) * 1e3, 1.7)))
    return [f"{name}>{step}".encode() for step in range(reached + 1)]


def meta_features(data: bytes, source: str | None, lang: str | None, n_chars: int | None) -> bytes:
    size, lines = max(1, len(data)), data.split(b"\n")
    letters = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    marks = size - letters[48:58].sum() - letters[65:91].sum() - letters[97:123].sum() - letters[128:].sum() - letters[32]
    names = [b"all", f"source={source}".encode(), f"lang={lang}".encode(), f"both={source} {lang}".encode()]
    names += [b"length unknown"] if n_chars is None else _steps("length", n_chars / 1e3)
    names += _steps("lines", len(lines) / 1e3) + _steps("line", max(map(len, lines)) / 1e3)
    names += _steps("line mean", size / len(lines) / 1e3)
    for name, count in (("capitals", letters[65:91].sum()), ("figures", letters[48:58].sum()), ("marks", marks)):
        names += _steps(name, float(count) / size)
    names += _steps("repeats", 1 - len(set(lines)) / len(lines))
    places = (mixed(word_hashes(names)) >> np.uint64(64 - META_BITS)).astype(np.int64)
    return _features(places, np.ones(len(places)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [text.as_buffer().to_pybytes() for text in batch.column(1)]
        metadata = zip(*[batch.column(place).to_pylist() for place in (2, 3, 4)], strict=True)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([text_features(text) for text in texts], pa.binary()),
                pa.array([meta_features(text, *own) for text, own in zip(texts, metadata, strict=True)], pa.binary()),
            ],
            names=["doc_id", "text", "meta"],
        )


# ---- the two classifiers


@dataclass
class Rows:
    """Training rows of one view."""

    features: list[np.ndarray] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)

    def add(self, data: bytes, label: int) -> None:
        self.features.append(np.frombuffer(bytes(data), FEATURE))
        self.labels.append(label)


def products(weights: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    """The product of each row with the weights, whose last one is the bias."""
    ends = np.cumsum([len(row) for row in features])
    if not len(ends):
        return np.empty(0)
    every = np.concatenate(features)
    sums = np.r_[0.0, np.cumsum(weights[every["place"]] * every["value"], dtype=np.float64)]
    return sums[ends] - np.r_[0.0, sums[ends[:-1]]] + weights[-1]


def chances(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def fit(rows: Rows, size: int) -> np.ndarray:
    """Weights of a logistic regression, both classes with the same total weight."""
    labels = np.array(rows.labels, float)
    positive = labels.sum()
    weight = np.where(labels > 0, 0.5 / positive, 0.5 / (len(labels) - positive))
    row = np.repeat(np.arange(len(labels)), [len(own) for own in rows.features])
    every = np.concatenate(rows.features)
    place, value = every["place"].astype(np.int64), every["value"].astype(np.float64)
    weights, squares = np.zeros(size + 1), np.full(size + 1, 1e-8)
    for _ in range(STEPS):
        logits = np.bincount(row, weights[place] * value, len(labels)) + weights[-1]
        error = (chances(logits) - labels) * weight
        gradient = np.bincount(place, error[row] * value, size + 1) + DECAY * weights
        gradient[-1] = error.sum()
        squares += gradient * gradient
        weights -= RATE * gradient / np.sqrt(squares)
    return weights


def calibrate(logits: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of the columns of ``logits`` and a bias, by Newton steps with a small prior."""
    columns = np.column_stack((logits, np.ones(len(logits))))
    weights = np.r_[np.full(logits.shape[1], 1 / logits.shape[1]), 0.0]
    prior = np.diag([1e-3] * len(weights))
    for _ in range(30):
        chance = chances(columns @ weights)
        slope = columns.T @ (chance - labels) + prior @ weights
        curve = (columns * (chance * (1 - chance))[:, None]).T @ columns + prior
        weights = weights - np.linalg.solve(curve, slope)
    return weights


# ---- Spark


def _logits(models):
    """``(doc_id, text, meta)``: the views' logits in place of the features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            columns = [
                pa.array(products(weights, [np.frombuffer(row.as_buffer(), FEATURE) for row in batch.column(view)]))
                for view, weights in models.value.items()
            ]
            kept = [batch.column(name) for name in ("doc_id", "print")]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=["doc_id", "print", *models.value])

    return run


def _scored(features: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    models = features.sparkSession.sparkContext.broadcast(weights)
    kind = features.schema["doc_id"].dataType.simpleString()
    return features.mapInArrow(_logits(models), f"doc_id {kind}, print long, text double, meta double")


def clean_labels(labels: DataFrame, label_column: str) -> DataFrame:
    """``(doc_id, label)`` of documents with one label, 0 or 1."""
    rows = labels.select("doc_id", column(labels, label_column).cast("int").alias("label"))
    agreed = (
        rows.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"), F.count_if(F.col("label").isNull()).alias("n"))
    )
    return agreed.where("label = most and n = 0 and label in (0, 1)").select("doc_id", "label")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    max_train: int = MAX_TRAIN,
    max_calibrate: int = MAX_CALIBRATE,
    grow: int = GROW,
    rounds: int = ROUNDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row: doc_id, text_score, meta_score, score, kept."""
    ship_package(docs.sparkSession)
    own = {name.lower() for name in docs.columns}

    def known_or_null(name: str, kind: str) -> Column:
        return (column(docs, name) if name in own else F.lit(None)).cast(kind).alias(name)

    rows = docs.select(
        column(docs, id_column).alias("doc_id"),
        whole_text(docs, text_column).alias("text"),
        known_or_null("source", "string"),
        known_or_null("lang", "string"),
        known_or_null("n_chars", "long"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    read = rows.mapInArrow(_read, f"doc_id {kind}, text binary, meta binary")
    features = stage(read.withColumn("print", F.xxhash64("text", "meta")), "features")
    known = stage(clean_labels(labels, label_column), "clean_labels")

    # The first labelled documents by hash: bounded, so they may be collected.
    order = F.xxhash64("doc_id", F.lit(17))
    chosen = stage(known.orderBy(order, "doc_id").limit(max_train + max_calibrate), "chosen_labels")
    collected = (
        features.join(chosen, "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"), F.min("meta").alias("meta"))
        .collect()
    )
    # Three of max_train + max_calibrate parts train, by an independent hash.
    cut = max_train / (max_train + max_calibrate)
    collected.sort(key=lambda row: row["doc_id"])
    spread = mixed(np.arange(len(collected), dtype=np.uint64)) / 2**64
    train = {view: Rows() for view in VIEWS}
    held = {view: Rows() for view in VIEWS}
    for row, place in zip(collected, spread, strict=True):
        for view in VIEWS:
            (train if place < cut else held)[view].add(row[view], row["label"])

    if any(len(set(part["text"].labels)) < 2 for part in (train, held)):
        return features.select(
            "doc_id", *[F.lit(0.5).alias(name) for name in ("text_score", "meta_score", "score")],
            F.lit(True).alias("kept"),
        )

    taken, examples = known.select("doc_id"), None
    weights = {view: fit(train[view], size) for view, size in VIEWS.items()}
    for _ in range(rounds):
        open_rows = _scored(features, weights).join(taken, "doc_id", "left_anti").where("doc_id is not null")
        if examples is not None:
            open_rows = open_rows.join(examples, "print", "left_anti")
        # Documents with the same features are one example, whose label they all would get.
        open_rows = stage(
            open_rows.groupBy("print").agg(
                F.min("doc_id").alias("doc_id"), F.min("text").alias("text"), F.min("meta").alias("meta")
            ),
            "open",
        )
        picks: dict[tuple[str, int], list] = {}
        for view in VIEWS:
            for label, sure in ((1, F.desc(view)), (0, F.asc(view))):
                agreeing = open_rows.where(F.col(view) > 0 if label else F.col(view) < 0)
                best = agreeing.orderBy(sure, F.xxhash64("doc_id"), "doc_id").limit(grow)  # a top list of fixed length
                picks[view, label] = [row["doc_id"] for row in best.select("doc_id").collect()]
        wanted = sorted({doc for docs_of in picks.values() for doc in docs_of})
        if not wanted:
            break
        kind_of = features.select("doc_id").schema
        new = features.sparkSession.createDataFrame([(doc,) for doc in wanted], kind_of)
        rows_of = {
            row["doc_id"]: row
            for row in features.join(F.broadcast(new), "doc_id")
            .groupBy("doc_id")
            .agg(F.min("text").alias("text"), F.min("meta").alias("meta"), F.min("print").alias("print"))
            .collect()
        }
        for (view, label), docs_of in picks.items():
            other = "meta" if view == "text" else "text"
            for doc in docs_of:
                train[other].add(rows_of[doc][other], label)
        used = [(row["print"],) for row in rows_of.values()]  # at most ``grow`` for each view and class
        used = features.sparkSession.createDataFrame(used, "print long")
        examples = stage(used if examples is None else examples.unionByName(used), "examples")
        weights = {view: fit(train[view], size) for view, size in VIEWS.items()}

    truth = np.array(held["text"].labels, float)
    raw = {view: products(weights[view], held[view].features) for view in VIEWS}
    views = {view: calibrate(raw[view][:, None], truth) for view in VIEWS}
    calibrated = np.column_stack([views[view][0] * raw[view] + views[view][1] for view in VIEWS])
    both = calibrate(calibrated, truth)

    scored = _scored(features, weights)
    own = {view: F.lit(float(views[view][0])) * F.col(view) + F.lit(float(views[view][1])) for view in VIEWS}
    joint = F.lit(float(both[2]))
    for place, view in enumerate(VIEWS):
        joint = joint + F.lit(float(both[place])) * own[view]
    chance = {name: F.round(1 / (1 + F.exp(-logit)), 6) for name, logit in {**own, "joint": joint}.items()}
    return scored.select(
        "doc_id",
        chance["text"].alias("text_score"),
        chance["meta"].alias("meta_score"),
        chance["joint"].alias("score"),
        (chance["joint"] >= threshold).alias("kept"),
    )
