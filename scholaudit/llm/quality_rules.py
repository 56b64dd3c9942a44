"""Quality rules with the frequency of lines across documents.

The base rules measure each whole text. On top of them, every normalised line
(ASCII lower case, words parted by one space) is hashed, and the different
documents of a host that hold it are counted. A line above the limits is
boilerplate: it is removed, and a document of which the larger part of the
words is removed is depleted and rejected.

Documents are different when their normalised lines are. Near copies are not
different documents, so before a line that is above the limits is boilerplate,
the near copies among its documents are put together: documents of a host that
agree in some of sixteen smallest window hashes are compared, word by word, with
one of them. A document with lines of its own, of which most words are not in
that one, is a different document, however much they share; the others are one
document with it. So the lines of a text that exists a thousand times with
words changed here and there are not taken for boilerplate, whereas a notice
below a thousand texts is, however long.

The measures run over Arrow batches in numpy. Hashes of lines, with their
numbers of words, are the only thing about texts that shuffles; they are made
different and counted in two steps, so that a line or a host with a third of
all rows is spread over all tasks.

Defined cases: null text is the empty text, without words or lines; it fails
the base rules. Documents of one line alone are one document for it. Documents that
differ only in lines of one or two words are near copies. Null hosts count as one host. Repeated rows get the same
verdict each and count as one document for their lines. Lines without a word
are never duplicates and never boilerplate. Empty tables give empty results.
Further columns, whatever their names, are carried along by
``apply_rules``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaudit.llm.shared import column, fresh, ship_package, slices, stage, whole_text
from scholaudit.llm.words import mixed, shingles, signed

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

#: A line is boilerplate in more different documents of its host than both of these.
MAX_DOCUMENTS, MAX_SHARE = 20, 0.001
#: A document is depleted when more than this share of its words is boilerplate.
MAX_REMOVED_SHARE = 0.5

#: Near copies are looked for among documents that agree in so many of so many smallest hashes.
SKETCHES, MIN_AGREEING = 16, 2
#: A line of a document is its own when it has so many words, most of them not in the document it is compared with.
MIN_OWN_WORDS = 3

UNKNOWN = "\x00"  # stands for the null host while grouping
CONTINUATION = np.uint8(0xC0)
SEEDS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) << np.uint64(32))


def line_hash(words: list[bytes]) -> int:
    return np.uint64(xxhash.xxh64_intdigest(b" ".join(words).lower())).view(np.int64).item()


def repeated_words(windows: np.ndarray, n_words: int) -> int:
    """Words inside windows that occur twice or more."""
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again) or n_words < WINDOW:
        return 0
    found = np.isin(windows, again)
    covered = np.zeros(n_words, bool)
    for shift in range(WINDOW):
        covered[shift : shift + len(found)] |= found
    return int(covered.sum())


def measure_text(data: bytes) -> dict:
    """All measures of one text, given as UTF-8."""
    lines = data.split(b"\n")
    parted = [line.split() for line in lines]
    words = [word for line in parted for word in line]
    windows = shingles(words, WINDOW)
    full = [place for place, line in enumerate(parted) if line]
    sizes = np.array([len(parted[place]) for place in full], np.int64)
    bare = data.translate(None, SPACES)
    return {
        "n_words": len(words),
        "word_chars": int(np.count_nonzero((np.frombuffer(bare, np.uint8) & CONTINUATION) != 0x80)),
        "n_symbols": len(data) - len(data.translate(None, SYMBOLS)),
        "n_dup_lines": len(full) - len({lines[place] for place in full}),
        "n_repeat_words": repeated_words(windows, len(words)),
        "hashes": [line_hash(parted[place]) for place in full],
        "counts": sizes,
        "sketches": sketches(windows),
    }


def sketches(windows: np.ndarray) -> np.ndarray:
    """The smallest hash of the windows in each of several orders."""
    if not len(windows):
        return np.zeros(SKETCHES, np.int64)
    return signed(np.array([mixed(windows ^ seed).min() for seed in SEEDS], np.uint64))


def own_lines(text: str, other: str) -> list[int]:
    """Hashes of the lines whose words are mostly not in the other text; a word is there with one of its neighbours."""
    lines = [line.lower().split() for line in text.encode().split(b"\n")]
    words = [word for line in lines for word in line]
    theirs = other.encode().lower().split()
    known = np.isin(shingles(words, 2), shingles(theirs, 2)) if len(words) > 1 else np.isin(words, theirs)
    there = np.zeros(len(words), bool)
    there[: len(known)] |= known
    there[len(words) - len(known) :] |= known
    own, at = set(), 0
    for line in lines:
        if len(line) >= MIN_OWN_WORDS and 2 * int(there[at : at + len(line)].sum()) < len(line):
            own.add(line_hash(line))
        at += len(line)
    return sorted(own)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    for batch in slices(batches):
        rows = [measure_text(text.as_buffer().to_pybytes()) for text in batch.column(2)]
        hashes = pa.array([row["hashes"] for row in rows], pa.list_(pa.int64()))
        counts = pa.array([row["counts"] for row in rows], pa.list_(pa.int64()))
        sketched = pa.array([row["sketches"] for row in rows], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(number, number + len(rows)), pa.int64()),
                batch.column(0),
                batch.column(1),
                batch.column(3),
                *[pa.array([row[name] for row in rows], pa.int64()) for name in MEASURES],
                hashes,
                counts,
                sketched,
            ],
            names=["row", "doc_id", "host", "text_hash", *MEASURES, "hashes", "counts", "sketches"],
        )
        number += len(rows)


def measure(docs: DataFrame, id_column: str, host_column: str, text_column: str) -> DataFrame:
    """The measures of every row, written once; ``row`` numbers the rows."""
    text = whole_text(docs, text_column)
    rows = docs.select(
        column(docs, id_column).alias("doc_id"),
        F.coalesce(column(docs, host_column).cast("string"), F.lit(UNKNOWN)).alias("host"),
        text.alias("text"),
        F.xxhash64(text).alias("text_hash"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, host string, text_hash long, " + ", ".join(f"{n} long" for n in MEASURES)
    measured = rows.mapInArrow(_measure, schema + ", hashes array<long>, counts array<long>, sketches array<long>")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    content = F.xxhash64("hashes")  # of the normalised lines
    return stage(measured.withColumn("base_failed", failed).withColumn("content", content), "measures")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number under which a text counts: its leader's, or one of its own with that one's and its own lines."""
    for batch in slices(batches):
        numbers = []
        rows = zip(*[batch.column(place).to_pylist() for place in (2, 3, 4)], strict=True)
        for leader, text, other in rows:
            own = own_lines(text, other)
            hashed = xxhash.xxh64_intdigest(np.array([leader, *own], np.int64).tobytes())
            numbers.append(np.uint64(hashed).view(np.int64).item() if own else leader)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(numbers, pa.int64())], names=["host", "content", "document"]
        )


def near_copies(contents: DataFrame, texts: DataFrame) -> DataFrame:
    """``(host, content, document)`` of the contents that are compared with another one, their leader.

    ``contents`` has host, content, text_hash and sketches, a row for each
    content of a host; ``texts`` has host, text_hash and text.
    """
    keys = stage(
        contents.select("host", "content", F.posexplode("sketches").alias("place", "sketch")), "sketches"
    )
    smallest = stage(
        keys.groupBy("host", "place", "sketch")
        .agg(F.min("content").alias("leader"), F.count(F.lit(1)).alias("contents"))
        .where("contents > 1")
        .drop("contents"),
        "smallest",
    )
    # The leader is the content that is smallest most often; leaders have leaders, so once more.
    agreeing = (
        keys.join(smallest, ["host", "place", "sketch"])
        .groupBy("host", "content", "leader")
        .agg(F.count(F.lit(1)).alias("agreeing"))
        .where(F.col("agreeing") >= MIN_AGREEING)
        .groupBy("host", "content")
        .agg(F.max(F.struct("agreeing", F.bitwise_not("leader").alias("turned"))).alias("best"))
        .select("host", "content", F.bitwise_not("best.turned").alias("leader"))
        .where("leader <> content")
    )
    agreeing = stage(agreeing, "agreeing")
    further = agreeing.select("host", F.col("content").alias("leader"), F.col("leader").alias("further"))
    led = stage(
        agreeing.join(further, ["host", "leader"], "left").select(
            "host", "content", F.coalesce("further", "leader").alias("leader")
        ),
        "led",
    )
    wanted = led.select("host", "content").union(led.select("host", "leader")).distinct()
    found = stage(
        texts.join(contents.join(wanted, ["host", "content"]).select("host", "content", "text_hash"), ["host", "text_hash"])
        .groupBy("host", "content")
        .agg(F.first("text").alias("text")),
        "near_texts",
    )
    leaders = stage(
        found.join(led.select("host", F.col("leader").alias("content")).distinct(), ["host", "content"]).select(
            "host", F.col("content").alias("leader"), F.col("text").alias("other")
        ),
        "leaders",
    )
    pairs = stage(found.join(led, ["host", "content"]), "near_pairs").join(leaders, ["host", "leader"])
    return pairs.select("host", "content", "leader", "text", "other").mapInArrow(
        _documents, "host string, content long, document long"
    )


def boilerplate_lines(
    measured: DataFrame, texts: DataFrame, max_documents: int = MAX_DOCUMENTS, max_share: float = MAX_SHARE
) -> DataFrame:
    """``(host, line)`` of the lines above the limits; ``texts`` has the host, text_hash and text of the rows."""
    hosts = stage(measured.groupBy("host").agg(F.count(F.lit(1)).alias("host_documents")), "hosts")
    lines = measured.select("host", "content", F.explode("hashes").alias("line"))

    def above(different: DataFrame) -> DataFrame:
        often = different.groupBy("host", "line").agg(F.count(F.lit(1)).alias("documents"))
        often = often.where(F.col("documents") > max_documents)
        return (
            often.join(hosts, "host").where(F.col("documents") > max_share * F.col("host_documents")).select("host", "line")
        )

    common = stage(above(lines.distinct()), "common_lines")
    held = stage(lines.join(common, ["host", "line"]).distinct(), "held_lines")
    holding = held.select("host", "content").distinct()
    contents = stage(
        measured.select("host", "content", "text_hash", "sketches")
        .join(holding, ["host", "content"])
        .groupBy("host", "content")
        .agg(F.min(F.struct("text_hash", "sketches")).alias("one"))
        .select("host", "content", "one.*"),
        "contents",
    )
    documents = stage(near_copies(contents, texts), "near_copies")
    different = held.join(documents, ["host", "content"], "left").select(
        "host", "line", F.coalesce("document", "content").alias("document")
    )
    return stage(above(different.distinct()), "boilerplate_lines")


def verdicts(
    docs: DataFrame,
    id_column: str = "doc_id",
    host_column: str = "source",
    text_column: str = "text",
    max_documents: int = MAX_DOCUMENTS,
    max_share: float = MAX_SHARE,
    max_removed_share: float = MAX_REMOVED_SHARE,
) -> DataFrame:
    """One row per row: doc_id, the measures, base_failed, n_boilerplate_words, kept; host, text_hash and lines."""
    measured = measure(docs, id_column, host_column, text_column)
    text = whole_text(docs, text_column)
    texts = docs.select(
        F.coalesce(column(docs, host_column).cast("string"), F.lit(UNKNOWN)).alias("host"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )
    limits = boilerplate_lines(measured, texts, max_documents, max_share)
    removed = (
        measured.select("row", "host", F.explode(F.arrays_zip("hashes", "counts")).alias("part"))
        .select("row", "host", F.col("part.hashes").alias("line"), F.col("part.counts").alias("words"))
        .join(limits, ["host", "line"])
        .groupBy("row")
        .agg(F.sum("words").alias("n_boilerplate_words"), F.collect_set("line").alias("lines"))
    )
    judged = measured.drop("hashes", "counts", "sketches", "content").join(removed, "row", "left")
    words = F.coalesce("n_boilerplate_words", F.lit(0).cast("long"))
    kept = ~F.col("base_failed") & (words <= max_removed_share * F.col("n_words"))
    return judged.withColumn("n_boilerplate_words", words).withColumn("kept", kept)


def rule_report(docs: DataFrame, **options) -> DataFrame:
    """One row per row: doc_id, the measures, base_failed, n_boilerplate_words, kept."""
    ship_package(docs.sparkSession)
    return verdicts(docs, **options).select("doc_id", *MEASURES, "base_failed", "n_boilerplate_words", "kept")


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes the text and its boilerplate lines from the last two columns and gives the text that is left."""
    for batch in slices(batches):
        texts = []
        for text, bad in zip(batch.column(-2).to_pylist(), batch.column(-1).to_pylist(), strict=True):
            if bad:
                bad = set(bad)
                lines = ((line, line.encode().split()) for line in text.split("\n"))
                text = "\n".join(line for line, words in lines if not words or line_hash(words) not in bad)
            texts.append(text)
        columns = [*batch.columns[:-2], pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])


def apply_rules(
    docs: DataFrame,
    id_column: str = "doc_id",
    host_column: str = "source",
    text_column: str = "text",
    **limits: float,
) -> DataFrame:
    """The documents that are kept, without their boilerplate lines, with the columns of ``docs``.

    Decisions are joined by id, host and text, on which equal rows agree. A
    null text stays null unless its document is rejected.
    """
    ship_package(docs.sparkSession)
    judged = verdicts(docs, id_column, host_column, text_column, **limits)
    known = {name: fresh(docs, f"rule_{name}") for name in ("doc_id", "host", "text_hash", "lines")}
    decisions = stage(
        judged.where("kept")
        .dropDuplicates(["doc_id", "host", "text_hash"])
        .select(*[F.col(name).alias(alias) for name, alias in known.items()]),
        "decisions",
    )
    left_over = fresh(docs, "rule_text")
    joined = docs.join(
        decisions,
        column(docs, id_column).eqNullSafe(F.col(known["doc_id"]))
        & (F.coalesce(column(docs, host_column).cast("string"), F.lit(UNKNOWN)) == F.col(known["host"]))
        & (F.xxhash64(whole_text(docs, text_column)) == F.col(known["text_hash"])),
    )
    own = [column(joined, name) for name in docs.columns]
    rows = joined.select(*own, whole_text(joined, text_column).alias(left_over), F.col(known["lines"]))
    cut = rows.mapInArrow(_without_lines, rows.schema[:-1])
    return cut.select(
        *[
            column(cut, left_over).alias(name) if name.lower() == text_column.lower() else column(cut, name)
            for name in docs.columns
        ]
    )
