"""Toxicity of documents by a bidirectional gated recurrent network with attention.

A text's words (runs of letters, figures and low lines, lower-cased) are read
in overlapping windows of 32, 16 words apart, the last one reaching the end.
Each word enters as a hashed word vector next to the sum of the vectors of its
character groups (three and five bytes long, and beginnings of three to eight
bytes). Two gated recurrent layers read a window in both directions; attention
weighs their states, and the pooled state gives the window's logit. A document
is judged by its highest window, the mean over its windows and their number,
calibrated on documents that the network was not trained on.

The network is trained in numpy, in one task, on a bounded sample: at most
``max_toxic`` documents with label 1 and ``max_clean`` with label 0, the first
ones by hash, with at most ``TRAIN_WINDOWS`` windows each, chosen by hash. Only
documents hold labels, so every pass first looks for the windows that stand out
most and then learns from these: the two highest of a toxic document, the
highest of a clean one. Calibration uses at most ``max_calibrate`` documents of
either class. Labels come only from documents whose ``crc32(doc_id) mod 5`` is
not 0; 1 is for calibration, the rest for training. Nothing but the text is an
input. All documents and all of their windows are scored.

Defined cases: null text is the empty text; a text without words is read as one
window of nothing. Repeated rows are scored each and enter the sample once.
Documents with contradicting labels, or a null one, count as unlabelled. A null
id belongs to no fold. Without labels of both classes every score is the share
of label 1 among the known labels, 0 without any. Very long texts have many
windows and are scored in parts; a word of any length is one word. Empty tables
give empty results. Further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaudit.llm.co_training import calibrate, clean_labels
from scholaudit.llm.shared import column, ship_package, slices, stage, whole_text
from scholaudit.llm.words import mixed, word_hashes

WINDOW, STRIDE = 32, 16
HIDDEN, WORD_SIZE, CHAR_SIZE, BITS = 8, 8, 8, 16
GROUPS = (3, 5)  # bytes of a character group
STARTS = (3, 4, 5, 6, 7, 8)  # bytes of a word's beginning, its mark included
FOLDS, CALIBRATION_FOLD = 5, 1
MAX_TOXIC, MAX_CLEAN, MAX_CALIBRATE = 2_500, 3_500, 1_000
TRAIN_WINDOWS = 32
EPOCHS, BATCH, RATE = 12, 64, 0.01
WORDS_KEPT = 200_000
PART = 2_048  # windows read at once

WORDS = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def window_starts(words: int) -> np.ndarray:
    """Where the windows of a text begin; one of an empty text."""
    if words <= WINDOW:
        return np.zeros(1, np.int64)
    starts = np.arange(0, words - WINDOW + STRIDE, STRIDE)
    return np.minimum(starts, words - WINDOW)


# ---- words as numbers


def character_groups(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character groups of the words, and how many each word has."""
    marked = [b"<" + word + b">" for word in words]
    sizes = np.array([len(word) for word in marked], np.int64)
    ends = np.cumsum(sizes)
    letters = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    first, left = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes) - np.arange(len(letters))
    owner = np.repeat(np.arange(len(words)), sizes)
    value = np.zeros(len(letters), np.uint64)
    buckets, owners = [], []
    at_start = np.arange(len(letters)) == first
    for size in range(1, max(STARTS) + 1):
        shifted = np.zeros(len(letters), np.uint64)
        if size <= len(letters):
            shifted[: len(letters) - size + 1] = letters[size - 1 :]
        value = value * np.uint64(0x100000001B3) + shifted + np.uint64(1)
        for kinds, salt, where in ((GROUPS, 0, left >= size), (STARTS, 1, at_start & (left >= size))):
            if size in kinds:
                chosen = np.flatnonzero(where)
                buckets.append(mixed(value[chosen] * np.uint64(2) + np.uint64(salt)) >> np.uint64(64 - BITS))
                owners.append(owner[chosen])
    bucket, of = np.concatenate(buckets).astype(np.int64), np.concatenate(owners)
    order = np.argsort(of, kind="stable")
    return bucket[order], np.bincount(of, minlength=len(words))


class Words:
    """Buckets of distinct words: one for the word itself, many for its character groups."""

    def __init__(self, words: list[str]):
        raw = [word.encode("utf-8", "surrogatepass") for word in words]
        self.word = (mixed(word_hashes(raw)) >> np.uint64(64 - BITS)).astype(np.int64)
        self.groups, self.count = character_groups(raw)
        self.start = np.cumsum(self.count) - self.count
        self.scale = (1 / np.sqrt(self.count)).astype(np.float32)


# ---- the network


class Network:
    """Parameters in one array, with views by name."""

    SIZE, STATE = WORD_SIZE + CHAR_SIZE, 2 * HIDDEN
    SHAPES = {
        "word": (1 << BITS, WORD_SIZE),
        "chars": (1 << BITS, CHAR_SIZE),
        "input": (2, WORD_SIZE + CHAR_SIZE, 3 * HIDDEN),
        "input_bias": (2, 3 * HIDDEN),
        "again": (2, HIDDEN, 3 * HIDDEN),
        "again_bias": (2, 3 * HIDDEN),
        "look": (2 * HIDDEN, 2 * HIDDEN),
        "look_bias": (2 * HIDDEN,),
        "weigh": (2 * HIDDEN,),
        "out": (2 * HIDDEN + 1,),
    }
    DENSE = ("input", "input_bias", "again", "again_bias", "look", "look_bias", "weigh", "out")

    def __init__(self, values: np.ndarray):
        self.values = values
        at = 0
        for name, shape in self.SHAPES.items():
            size = math.prod(shape)
            setattr(self, name, values[at : at + size].reshape(shape))
            at += size

    @classmethod
    def start(cls) -> Network:
        size = sum(math.prod(shape) for shape in cls.SHAPES.values())
        network = cls((np.random.default_rng(1).standard_normal(size) * 0.1).astype(np.float32))
        for name, scale in (("input", 3), ("again", 3), ("look", 3), ("weigh", 3), ("out", 3)):
            getattr(network, name)[...] *= scale
        for name in ("input_bias", "again_bias", "look_bias"):
            getattr(network, name)[...] = 0
        network.input_bias[:, :HIDDEN] = -1  # states change slowly at first
        return network

    def vectors(self, words: Words) -> np.ndarray:
        """Of each word: its own vector and the sum of those of its character groups."""
        groups = np.add.reduceat(self.chars[words.groups], words.start, axis=0) * words.scale[:, None]
        return np.concatenate((self.word[words.word], groups), axis=1)

    def entries(self, vectors: np.ndarray) -> np.ndarray:
        """What each word adds to the gates, per direction; the last row is for no word."""
        own = [vectors @ self.input[side] + self.input_bias[side] for side in (0, 1)]
        return np.stack([np.concatenate((one, np.zeros((1, 3 * HIDDEN), one.dtype))) for one in own])

    def states(self, entries: np.ndarray, numbers: np.ndarray, kept: list | None = None) -> np.ndarray:
        """States after each word (time, window, state); ``numbers`` is (time, window), -1 for no word."""
        length, count = numbers.shape
        result = np.empty((length, count, self.STATE), entries.dtype)
        for side in (0, 1):
            own = slice(side * HIDDEN, (side + 1) * HIDDEN)
            state = np.zeros((count, HIDDEN), entries.dtype)
            for time in range(length) if side == 0 else range(length - 1, -1, -1):
                given = entries[side][numbers[time]]
                back = state @ self.again[side] + self.again_bias[side]
                gates = given[:, : 2 * HIDDEN] + back[:, : 2 * HIDDEN]
                gates *= 0.5
                np.tanh(gates, out=gates)
                gates += 1
                gates *= 0.5
                let, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
                fresh = np.tanh(given[:, 2 * HIDDEN :] + reset * back[:, 2 * HIDDEN :])
                there = (numbers[time] >= 0)[:, None]
                step = np.where(there, let, 0) if not there.all() else let
                if kept is not None:
                    kept.append((side, time, state, step, reset, fresh, back[:, 2 * HIDDEN :]))
                state = state + step * (fresh - state)
                result[time, :, own] = state
        return result

    def pooled(self, states: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The states looked at, the attention's weights, and the weighted state."""
        seen = np.tanh(states @ self.look + self.look_bias)
        weights = seen @ self.weigh
        weights[numbers < 0] = -1e9
        weights -= weights.max(axis=0)
        np.exp(weights, out=weights)
        weights /= weights.sum(axis=0)
        return seen, weights, np.einsum("tb,tbs->bs", weights, states)

    def logits(self, entries: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Of windows given as rows of word numbers."""
        result = np.empty(len(numbers), np.float32)
        for start in range(0, len(numbers), PART):
            part = np.ascontiguousarray(numbers[start : start + PART].T)
            pooled = self.pooled(self.states(entries, part), part)[2]
            result[start : start + PART] = pooled @ self.out[:-1] + self.out[-1]
        return result

    def slopes(self, vectors: np.ndarray, numbers: np.ndarray, wanted: np.ndarray, weight: np.ndarray):
        """Loss, slopes of the dense parameters by name, and of the words' vectors."""
        entries, numbers = self.entries(vectors), np.ascontiguousarray(numbers.T)
        kept: list = []
        states = self.states(entries, numbers, kept)
        seen, weights, pooled = self.pooled(states, numbers)
        logits = pooled @ self.out[:-1] + self.out[-1]
        chance = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        loss = -(weight * np.where(wanted > 0, np.log(chance + 1e-9), np.log(1 - chance + 1e-9))).sum()
        error = ((chance - wanted) * weight).astype(vectors.dtype)

        found = {name: np.zeros(self.SHAPES[name], vectors.dtype) for name in self.DENSE}
        found["out"][:-1], found["out"][-1] = pooled.T @ error, error.sum()
        pool_back = error[:, None] * self.out[:-1]
        state_back = weights[:, :, None] * pool_back
        lean = np.einsum("tbs,bs->tb", states, pool_back)
        lean = weights * (lean - (weights * lean).sum(axis=0))
        found["weigh"] = np.einsum("tb,tbs->s", lean, seen)
        inner = lean[:, :, None] * self.weigh * (1 - seen * seen)
        found["look"] = np.einsum("tbs,tbr->sr", states, inner, optimize=True)
        found["look_bias"] = inner.sum(axis=(0, 1))
        state_back += inner @ self.look.T

        entry_back = np.zeros_like(entries)
        carried = {side: np.zeros((numbers.shape[1], HIDDEN), vectors.dtype) for side in (0, 1)}
        for side, time, before, step, reset, fresh, back in reversed(kept):
            coming = carried[side] + state_back[time, :, side * HIDDEN : (side + 1) * HIDDEN]
            fresh_back = coming * step * (1 - fresh * fresh)
            step_back = coming * (fresh - before) * step * (1 - step)
            reset_back = fresh_back * back * reset * (1 - reset)
            given_back = np.concatenate((step_back, reset_back, fresh_back), axis=1)
            back_back = np.concatenate((step_back, reset_back, fresh_back * reset), axis=1)
            np.add.at(entry_back[side], numbers[time], given_back)
            found["again"][side] += before.T @ back_back
            found["again_bias"][side] += back_back.sum(axis=0)
            carried[side] = coming * (1 - step) + back_back @ self.again[side].T
        vector_back = np.zeros_like(vectors)
        for side in (0, 1):
            own = entry_back[side][:-1]
            found["input"][side] = vectors.T @ own
            found["input_bias"][side] = own.sum(axis=0)
            vector_back += own @ self.input[side].T
        return loss, found, vector_back


def _moved(parameter: np.ndarray, slope: np.ndarray, first: np.ndarray, second: np.ndarray, turn: int) -> None:
    """One step of Adam."""
    first += 0.1 * (slope - first)
    second += 0.001 * (slope * slope - second)
    parameter -= RATE * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-7)


def _move_rows(table: np.ndarray, past: np.ndarray, rows: np.ndarray, slopes: np.ndarray) -> None:
    """One step of Adagrad on the rows, whose slopes are summed first."""
    order = np.argsort(rows, kind="stable")
    used, starts = np.unique(rows[order], return_index=True)
    sums = np.add.reduceat(slopes[order], starts, axis=0)
    past[used] += sums * sums
    table[used] -= 0.05 * sums / (np.sqrt(past[used]) + 1e-6)


def train(windows: list[list[str]], document: np.ndarray, toxic: np.ndarray, epochs: int = EPOCHS) -> Network:
    """From windows of words, the number of each one's document (rising) and the documents' labels."""
    known = {word: place for place, word in enumerate(sorted({word for window in windows for word in window}))}
    words = Words([*known, "_"])  # the last one for windows of nothing
    numbers = np.full((len(windows), WINDOW), -1, np.int64)
    for place, window in enumerate(windows):
        numbers[place, : len(window)] = [known[word] for word in window]
    network, rnd = Network.start(), np.random.default_rng(5)
    past = Network(np.full_like(network.values, 1e-6))
    first, second = Network(np.zeros_like(network.values)), Network(np.zeros_like(network.values))
    share = np.where(toxic > 0, 0.25 / max(1, (toxic > 0).sum()), 0.5 / max(1, (toxic == 0).sum()))
    turn = 0
    for epoch in range(epochs):
        scores = network.logits(network.entries(network.vectors(words)), numbers)
        if epoch == 0:
            scores = rnd.random(len(scores))
        order = np.lexsort((-scores, document))
        rank = np.arange(len(order)) - np.searchsorted(document[order], document[order])
        chosen = order[rank < np.where(toxic[document[order]] > 0, 2, 1)]
        chosen = chosen[rnd.permutation(len(chosen))]
        for start in range(0, len(chosen), BATCH):
            rows = chosen[start : start + BATCH]
            used, local = np.unique(numbers[rows], return_inverse=True)
            local = local.reshape(len(rows), WINDOW)
            if used[0] < 0:
                used, local = used[1:], local - 1
            part = _chosen_words(words, used)
            weight = (share[document[rows]] * len(chosen) / len(rows)).astype(np.float32)
            _, slopes, vector_back = network.slopes(
                network.vectors(part), local, toxic[document[rows]].astype(np.float32), weight
            )
            turn += 1
            for name, slope in slopes.items():
                _moved(getattr(network, name), slope, getattr(first, name), getattr(second, name), turn)
            _move_rows(network.word, past.word, part.word, vector_back[:, :WORD_SIZE])
            group_back = np.repeat(vector_back[:, WORD_SIZE:] * part.scale[:, None], part.count, axis=0)
            _move_rows(network.chars, past.chars, part.groups, group_back)
    return network


def _chosen_words(words: Words, rows: np.ndarray) -> Words:
    if not len(rows):
        rows = np.array([len(words.word) - 1])
    part = Words.__new__(Words)
    part.word, part.count, part.scale = words.word[rows], words.count[rows], words.scale[rows]
    part.start = np.cumsum(part.count) - part.count
    inside = np.arange(part.count.sum()) - np.repeat(part.start, part.count)
    part.groups = words.groups[np.repeat(words.start[rows], part.count) + inside]
    return part


# ---- scoring


class Reader:
    """Windows of texts scored by a network; entries of words are remembered for a bounded number of words."""

    def __init__(self, values: np.ndarray):
        self.network = Network(values)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.entries = np.zeros((2, 1, 3 * HIDDEN), np.float32)

    def learn(self, words: list[str]) -> None:
        new = [word for word in dict.fromkeys(words) if word not in self.known]
        if not new:
            return
        size = len(self.known)
        fresh = self.network.entries(self.network.vectors(Words(new)))
        need = size + len(new) + 1
        if need > self.entries.shape[1]:
            grown = np.zeros((2, max(need, 2 * self.entries.shape[1]), 3 * HIDDEN), np.float32)
            grown[:, :size] = self.entries[:, :size]
            self.entries = grown
        self.entries[:, size : size + len(new)] = fresh[:, :-1]
        self.known.update(zip(new, range(size, size + len(new)), strict=True))

    def logits(self, texts: list[str]) -> list[np.ndarray]:
        """The windows' logits of each text."""
        parted = [words_of(text) for text in texts]
        if len(self.known) > WORDS_KEPT:
            self.forget()
        self.learn([word for words in parted for word in words])
        rows = []
        for words in parted:
            numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            if len(words) < WINDOW:
                rows.append(np.r_[numbers, np.full(WINDOW - len(words), -1)][None])
            else:
                rows.append(np.lib.stride_tricks.sliding_window_view(numbers, WINDOW)[window_starts(len(words))])
        logits = self.network.logits(self.entries, np.concatenate(rows))
        return np.split(logits, np.cumsum([len(own) for own in rows])[:-1])


def summary(logits: np.ndarray) -> tuple[float, float, float]:
    """Of a document: its highest window, the logit of the mean chance, the logarithm of its windows' number."""
    mean = np.clip((1 / (1 + np.exp(-np.clip(logits.astype(np.float64), -30, 30)))).mean(), 1e-9, 1 - 1e-9)
    return float(logits.max()), float(np.log(mean / (1 - mean))), math.log(len(logits))


# ---- Spark

FEATURES = ("highest", "mean", "windows")


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows to train on, without overlap, of every sampled document."""
    for batch in slices(batches, 64):
        out = {"doc": [], "label": [], "windows": []}
        for doc, label, text in zip(*[batch.column(place).to_pylist() for place in range(3)], strict=True):
            words = words_of(text)
            parts = [words[at : at + WINDOW] for at in range(0, max(1, len(words)), WINDOW)]
            if len(parts) > TRAIN_WINDOWS:
                order = np.argsort(mixed(np.arange(len(parts), dtype=np.uint64) + np.uint64(len(words))))
                parts = [parts[place] for place in order[:TRAIN_WINDOWS]]
            out["doc"].append(str(doc))
            out["label"].append(label)
            out["windows"].append([" ".join(part) for part in parts])
        yield pa.RecordBatch.from_pydict(
            out, schema=pa.schema([("doc", pa.string()), ("label", pa.int32()), ("windows", pa.list_(pa.string()))])
        )


def _train_task(epochs: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc")
        windows = table.column("windows").to_pylist()
        document = np.repeat(np.arange(len(windows)), [len(own) for own in windows])
        toxic = table.column("label").to_numpy()
        network = train([window.split() for own in windows for window in own], document, toxic, epochs)
        return pa.table({"network": pa.array([network.values.astype("<f4").tobytes()], pa.binary())})

    return run


def _score(network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(network.value)
        for batch in slices(batches, 64):
            found = np.array([summary(own) for own in reader.logits(batch.column(1).to_pylist())])
            columns = [pa.array(np.ascontiguousarray(found[:, place])) for place in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *FEATURES])

    return run


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
    max_calibrate: int = MAX_CALIBRATE,
    epochs: int = EPOCHS,
) -> DataFrame:
    """One row per row: doc_id, held_out, score, predicted, highest and mean window, number of windows."""
    spark = docs.sparkSession
    ship_package(spark)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    rows = docs.select(column(docs, id_column).alias("doc_id"), whole_text(docs, text_column).alias("text"))
    held_out = F.coalesce(fold == 0, F.lit(False)).alias("held_out")
    known = clean_labels(labels, label_column).withColumn("fold", fold).where("fold <> 0")

    # The first labelled documents of each class and use by hash: bounded numbers.
    order = [F.xxhash64("doc_id", F.lit(23)), F.col("doc_id")]
    is_training = F.col("fold") != CALIBRATION_FOLD

    def first(training: bool, label: int, most: int) -> DataFrame:
        own = known.where(is_training if training else ~is_training).where(F.col("label") == label)
        return own.orderBy(*order).limit(most).select("doc_id", "label", F.lit(training).alias("training"))

    with_text = rows.select("doc_id").distinct()
    known = stage(known.join(with_text, "doc_id", "left_semi"), "known_labels")
    chosen = stage(
        first(True, 1, max_toxic)
        .unionByName(first(True, 0, max_clean))
        .unionByName(first(False, 1, max_calibrate))
        .unionByName(first(False, 0, max_calibrate)),
        "sample",
    )
    classes = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    sizes = {(row["training"], row["label"]) for row in chosen.select("training", "label").distinct().collect()}
    if not {(True, 0), (True, 1)} <= sizes:
        share = classes.get(1, 0) / max(1, sum(classes.values()))
        constant = F.lit(float(share))
        return rows.select(
            "doc_id",
            held_out,
            constant.alias("score"),
            (constant >= 0.5).cast("int").alias("predicted"),
            *[F.lit(None).cast("double").alias(name) for name in FEATURES],
        )

    sample = (
        rows.join(chosen.where("training").drop("training"), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .mapInArrow(_sample_windows, "doc string, label int, windows array<string>")
    )
    whole = stage(sample, "windows").withColumn("all", F.lit(1))  # bounded
    trained = whole.groupBy("all").applyInArrow(_train_task(epochs), "network binary")
    network = spark.sparkContext.broadcast(np.frombuffer(bytes(trained.collect()[0]["network"]), "<f4"))  # one network

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = stage(
        rows.mapInArrow(_score(network), f"doc_id {kind}, " + ", ".join(f"{name} double" for name in FEATURES)),
        "windows_scored",
    )
    known_scores = scored.join(chosen, "doc_id").dropDuplicates(["doc_id"])
    whole_fold = {(False, 0), (False, 1)} <= sizes
    pairs = (known_scores.where("not training") if whole_fold else known_scores).orderBy("doc_id").collect()
    # The sample holds the classes in other shares than the labels do.
    truth = np.array([row["label"] for row in pairs], float)
    features = np.array([[row[name] for name in FEATURES] for row in pairs])
    weights = calibrate(features, truth)
    drawn = truth.mean() / (1 - truth.mean())
    prior = math.log(classes[1] / classes[0] / drawn)
    logit = F.lit(float(weights[-1] + prior))
    for name, weight in zip(FEATURES, weights, strict=False):
        logit = logit + F.lit(float(weight)) * F.col(name)
    score = F.round(1 / (1 + F.exp(-logit)), 6)
    return scored.select(
        "doc_id", held_out, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), *FEATURES
    )
