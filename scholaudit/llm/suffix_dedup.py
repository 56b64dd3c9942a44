"""Removal of repeated substrings, bucket by bucket, with a difference-cover sample.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else is removed. Only the first ``length`` bytes of a suffix matter, so
suffixes are equal or not by a 104-bit fingerprint of these bytes: 64 bits of
one polynomial and 40 of another. They are sorted by it, one bucket of suffixes
at a time, each bucket in one task and of bounded size. Among n suffixes that
are compared, two different ones are taken for equal with a chance of about
n ** 2 / 2 ** 105, which is one in forty million at n = 10 ** 12.

Sorting all suffixes would move ten bytes for each byte of text. The
difference cover prevents that. COVER holds twelve residues modulo 133 such
that for any two places i and j one offset d < 133 has i + d and j + d both in
the sample. If the suffixes at i and j agree in ``length`` bytes, then the
sample suffixes at i + d and j + d agree in length - 132 bytes. So first the
sample (9 % of the suffixes) is sorted by that many bytes, and only suffixes
within 132 bytes before a sample suffix that has an equal are sorted by all
``length`` bytes. The sample decides nothing by itself, and whatever it lets
through is compared in full.

Long repeats would still send each of their suffixes. So the first sort also
takes spans: of all suffixes one in 32 is chosen by its own fingerprint, hence
the same ones in equal passages, and a span is the text from one chosen suffix
to the end of the next one. Where a span has an equal, all suffixes in it do.
One span of each class of equals still sends its suffixes, so that others can
meet them; beside these, the second sort is left with the suffixes around the
ends of repeats.

Tasks first combine equal suffixes of their own texts, so that a passage in a
third of all documents reaches its bucket once per task and not once per
document. Texts move between machines only where the sample found something;
which ones these are is told by a Bloom filter with 16 bits for each of them, up to
``MOST_FILTER_BITS``; where it is full more texts move, with the same result. What is sent
about a suffix is its fingerprint and the gap to the previous one of its
bucket; answers name the suffixes by their number within the sending task's
block, and each block sends a directory of its texts along. Blocks are made
from rows in a fixed order, so a repeated task makes the same block.

Texts are the same text if their 64-bit hashes are. Defined cases: null text
is the empty text. A text of fewer than ``length`` bytes has nothing to remove.
A text that occurs in several rows is removed in all of them if it has
``length`` bytes. Empty tables give empty results. Further columns, whatever
their names, are ignored by ``repeated_substrings`` and carried along by
``without_repeats``, where bytes that are no longer UTF-8 after a cut become
U+FFFD.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaudit.llm.shared import column, ship_package, slices, stage, whole_text
from scholaudit.llm.words import mixed

# A perfect difference set: every residue but 0 is the difference of exactly one pair.
PERIOD = 133
COVER = np.array([0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109])

PIECE = PERIOD * 7_500  # a longer text is read in pieces of so many bytes
BLOCK = 1_000_000  # suffixes that a task combines before it sends them
BUCKET = 3_000_000  # suffixes of a bucket
SAMPLE_BYTES, FULL_BYTES = 4, 13  # of a fingerprint that are sent
CHOSEN = 32  # one suffix in so many ends a span
LEAST_FILTER_BITS, MOST_FILTER_BITS = 16, 27  # powers of two; 16 MB at most
FILTER_BLOCK = 1 << 14

_BASE = 0x9E3779B97F4A7C15
_OTHER_BASE = 0xD6E8FEB86659FD93
_LETTERS, _OTHER_LETTERS = np.random.default_rng(20_240_601).integers(0, 2**64, (2, 256), dtype=np.uint64)


def _powers(base: int, count: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2 ** 64."""
    values = np.ones(count, np.uint64)
    done = 1
    while done < count:
        more = min(done, count - done)
        values[done : done + more] = values[:more] * np.uint64(pow(base, done, 2**64))
        done += more
    return values


class Fingerprints:
    """Fingerprints of substrings of texts of up to ``size`` bytes."""

    def __init__(self, size: int):
        self.size = size
        self.tables = [
            (letters, _powers(base, size + 1), _powers(pow(base, -1, 2**64), size + 1))
            for letters, base in ((_LETTERS, _BASE), (_OTHER_LETTERS, _OTHER_BASE))
        ]

    def of(self, data: bytes, places: np.ndarray, length: int, other: int = 0) -> np.ndarray:
        """64 bits each, of the first polynomial or the other one."""
        letters, up, down = self.tables[other]
        values = letters[np.frombuffer(data, np.uint8)]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values * up[: len(data)], out=sums[1:])
        return mixed((sums[places + length] - sums[places]) * down[places])

    def both(self, data: bytes, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        return self.of(data, places, length), self.of(data, places, length, 1)


def unpacked(data) -> bytes:
    """A text as ``_passing`` packs it: its size in eight bytes, then zstd."""
    size = int.from_bytes(bytes(data[:8]), "little")
    return pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def packed(data) -> bytes:
    return len(data).to_bytes(8, "little") + (pa.compress(data, codec="zstd", asbytes=True) if len(data) else b"")


def pieces(size: int) -> Iterator[int]:
    yield from range(0, max(size, 1), PIECE)


def sample_places(size: int, length: int) -> np.ndarray:
    """Places of the cover in a text of ``size`` bytes at which a sample suffix fits."""
    last = size - (length - PERIOD + 1)
    if size < length:
        return np.empty(0, np.int64)
    places = (np.arange(last // PERIOD + 1)[:, None] * PERIOD + COVER).ravel()
    return places[places <= last]


def chosen_suffixes(data, prints: Fingerprints, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and both fingerprints of the suffixes that end spans."""
    places, found, others = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for begin in range(0, len(data) - length + 1, PIECE):
        count = min(PIECE, len(data) - length + 1 - begin)
        part = data[begin : begin + count + length - 1]
        values = prints.of(part, np.arange(count), length)
        here = np.flatnonzero(values % np.uint64(CHOSEN) == 0)
        places.append(here + begin)
        found.append(values[here])
        others.append(prints.of(part, here, length, 1) if len(here) else values[:0])
    return np.concatenate(places), np.concatenate(found), np.concatenate(others)


def span_prints(
    places: np.ndarray, prints: np.ndarray, others: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers and fingerprints of the spans between neighbours; suffixes farther apart than ``length`` make none."""
    steps = np.diff(places)
    numbers = np.flatnonzero(steps <= length)
    size = steps[numbers].astype(np.uint64)
    found = [
        mixed((mixed(ends[numbers]) + ends[numbers + 1]) * np.uint64(base) + size)
        for ends, base in ((prints, _BASE), (others, _OTHER_BASE))
    ]
    return numbers, *found


def classes(first: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal fingerprints are neighbours, and whether each one there equals the one before."""
    if not other.any():  # the sample sends no second part
        order = np.argsort(first, kind="stable")
    else:
        order = np.lexsort((other, first))
    first, other = first[order], other[order]
    return order, np.r_[False, (first[1:] == first[:-1]) & (other[1:] == other[:-1])][: len(order)]


def packed_numbers(numbers: np.ndarray) -> bytes:
    """Rising numbers as gaps of one or two bytes; the largest value stands for itself and goes on."""
    gaps = np.diff(numbers, prepend=0)
    kind, most = ("<u1", 255) if len(gaps) and gaps.mean() < 128 else ("<u2", 65_535)
    ends = np.cumsum(gaps // most + 1)
    values = np.full(ends[-1] if len(ends) else 0, most, kind)
    values[ends - 1] = gaps % most
    return kind[2].encode() + values.tobytes()


def unpacked_numbers(data) -> np.ndarray:
    kind = "<u" + bytes(data[:1]).decode()
    values = np.frombuffer(data, kind, offset=1)
    return np.cumsum(values, dtype=np.int64)[values != np.iinfo(kind).max]


def candidate_ranges(marks: np.ndarray, size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the runs of suffixes that lie up to 132 bytes before a mark."""
    first = np.maximum(marks - (PERIOD - 1), 0)
    last = np.minimum(marks, size - length)
    fit = first <= last
    first, last = first[fit], last[fit]
    if not len(first):
        return first, last
    new = np.r_[True, first[1:] > last[:-1] + 1]
    return first[new], np.r_[last[:-1][new[1:]], last[-1]]


# ---- blocks of suffixes and their buckets


class Block:
    """Suffixes of one task, numbered in order, and the directory of the texts they are from.

    ``offset`` is the first of the block's buckets, ``width`` the bytes of a
    fingerprint that are sent, ``sorts`` names what the numbers count.
    """

    def __init__(self, number: int, sorts: str, buckets: int, width: int, offset: int = 0):
        self.number, self.sorts, self.buckets, self.width, self.offset = number, sorts, buckets, width, offset
        self.prints: list[np.ndarray] = []
        self.others: list[np.ndarray] = []
        self.directory: list[tuple[int, int, int, int]] = []  # text, size of text, first place, suffixes
        self.certain: list[tuple[int, int, int]] = []  # text, first byte and byte behind the last to remove
        self.count = 0

    def add(self, text: int, size: int, first: int, prints: np.ndarray, others: np.ndarray | None = None) -> None:
        self.directory.append((text, size, first, len(prints)))
        self.prints.append(prints)
        self.others.append(np.zeros(len(prints), np.uint64) if others is None else others)
        self.count += len(prints)

    def rows(self) -> pa.RecordBatch:
        """What to send to the buckets; the directory and own repeats go to a group of the block alone."""
        none = np.empty(0, np.uint64)
        prints, others = np.concatenate([none, *self.prints]), np.concatenate([none, *self.others])
        order, again = classes(prints, others)
        leads = order[np.r_[~again[:-1] & again[1:], False][: len(order)]]
        own = np.sort(order[again | np.r_[again[1:], False][: len(order)]])
        leaders = np.sort(leads)
        first = np.sort(order[~again])  # sorts are stable, so the first of equals leads them
        prints, others = prints[first], others[first]
        # By other bits than those that are sent, and for any number of buckets.
        bucket = (mixed(prints + np.uint64(_OTHER_BASE)) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        groups, payloads = [], []
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else ():
            values = np.concatenate(
                [half[part].astype("<u8").view(np.uint8).reshape(-1, 8) for half in (prints, others)], axis=1
            )[:, : self.width]
            groups.append(self.offset + int(bucket[part[0]]))
            payloads.append(
                len(part).to_bytes(4, "little") + bytes([self.width]) + values.tobytes() + packed_numbers(first[part])
            )
        alone = {
            self.sorts: np.array(self.directory, "<i8").tobytes(),
            "own": packed_numbers(own),
            "leaders": packed_numbers(leaders),
            "certain": np.array(self.certain, "<i8").tobytes(),
        }
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*groups, *[-1 - self.number] * len(alone)], pa.int64()),
                pa.array([self.number] * (len(groups) + len(alone)), pa.int64()),
                pa.array(["suffixes"] * len(groups) + list(alone), pa.string()),
                pa.array([*payloads, *alone.values()], pa.binary()),
            ],
            names=["bucket", "block", "kind", "data"],
        )


SENT = "bucket long, block long, kind string, data binary"


def _sort_bucket(leaders_from: int | None = None):
    """Sorts a bucket of suffixes and answers with the numbers of those that have an equal.

    Buckets from ``leaders_from`` on also answer which one is the first of its equals.
    """

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:
            return table.select(["block", "kind", "data"])
        blocks, prints, others, numbers = [], [], [], []
        for block, data in zip(table.column("block").to_pylist(), table.column("data"), strict=True):
            data = data.as_buffer()
            count, width = int.from_bytes(bytes(data[:4]), "little"), bytes(data[4:5])[0]
            value = np.zeros((count, 16), np.uint8)
            value[:, :width] = np.frombuffer(data, np.uint8, count * width, 5).reshape(count, width)
            halves = value.view("<u8")
            blocks.append(block)
            prints.append(halves[:, 0])
            others.append(halves[:, 1])
            numbers.append(unpacked_numbers(data[5 + count * width :]))
        ends = np.cumsum([len(part) for part in prints])[:-1]
        order, again = classes(np.concatenate(prints), np.concatenate(others))
        del prints, others
        equal = np.r_[again, False]
        has_equal, leads = np.zeros(len(order), bool), np.zeros(len(order), bool)
        has_equal[order[equal[1:] | equal[:-1]]] = True
        leads[order[equal[1:] & ~equal[:-1]]] = True
        answers = {"repeated": has_equal}
        if leaders_from is not None and bucket >= leaders_from:
            answers["leaders found"] = leads
        parts = {
            kind: [packed_numbers(own[mark]) for own, mark in zip(numbers, np.split(marks, ends), strict=True)]
            for kind, marks in answers.items()
        }
        return pa.table(
            {
                "block": pa.array(blocks * len(parts), pa.int64()),
                "kind": [kind for kind in parts for _ in blocks],
                "data": pa.array([data for part in parts.values() for data in part], pa.binary()),
            }
        )

    return run


def _union(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, np.int64), *parts]))


def _answers(table: pa.Table) -> Iterator[tuple[str, int, int, list[tuple[int, np.ndarray, np.ndarray]]]]:
    """Of one block: what it sorts, and of each text the hash, the size and the runs of suffixes.

    A run has the first place and the numbers of the suffixes found in it, of all and of leaders.
    """
    numbers: dict[str, list[np.ndarray]] = {"repeated": [], "leaders found": [], "own": [], "leaders": []}
    directory, sorts = np.empty((0, 4), np.int64), ""
    for kind, data in zip(table.column("kind").to_pylist(), table.column("data"), strict=True):
        if kind in numbers:
            numbers[kind].append(unpacked_numbers(data.as_buffer()))
        elif kind != "certain":
            directory, sorts = np.frombuffer(data.as_buffer(), "<i8").reshape(-1, 4), kind
    elsewhere = _union(numbers["repeated"])
    every = _union([elsewhere, *numbers["own"]])
    leading = _union([*numbers["leaders found"], np.setdiff1d(_union(numbers["leaders"]), elsewhere)])
    ends = np.cumsum(directory[:, 3])
    cuts, leading_cuts = (np.searchsorted(marks, np.r_[0, ends]) for marks in (every, leading))
    texts: dict[tuple[int, int], list[tuple[int, np.ndarray, np.ndarray]]] = {}
    for row, (text, size, first, count) in enumerate(directory.tolist()):
        begin = ends[row] - count
        own = every[cuts[row] : cuts[row + 1]] - begin
        if len(own):
            leads = leading[leading_cuts[row] : leading_cuts[row + 1]] - begin
            texts.setdefault((text, size), []).append((first, own, leads))
    for (text, size), runs in texts.items():
        yield sorts, text, size, runs


# ---- Bloom filter of texts


def _filter_cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    hashes = mixed(hashes.view(np.uint64))
    return np.stack((hashes >> np.uint64(64 - bits), hashes & np.uint64((1 << bits) - 1))).astype(np.int64)


def filter_bits(texts: int) -> int:
    """The power of two of bits for so many texts."""
    return min(MOST_FILTER_BITS, max(LEAST_FILTER_BITS, math.ceil(math.log2(16 * max(1, texts)))))


def text_filter(rows: DataFrame, name: str) -> tuple[int, np.ndarray]:
    """The power of two and the bits of the texts' hashes, eight in a byte."""
    size = filter_bits(rows.count())

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [np.empty(0, np.int64)]
        for batch in batches:
            cells.append(np.unique(_filter_cells(batch.column(0).to_numpy(zero_copy_only=False), size)))
        every = np.unique(np.concatenate(cells))
        used, starts = np.unique(every // FILTER_BLOCK, return_index=True)
        packed = []
        for part in np.split(every % FILTER_BLOCK, starts[1:]) if len(used) else ():
            bits = np.zeros(FILTER_BLOCK, bool)
            bits[part] = True
            packed.append(np.packbits(bits, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(packed, pa.binary())], names=["place", "bits"]
        )

    def unite(table: pa.Table) -> pa.Table:
        bits = np.zeros(FILTER_BLOCK // 8, np.uint8)
        for part in table.column("bits"):
            bits |= np.frombuffer(part.as_buffer(), np.uint8)
        return pa.table({"place": table.column("place").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    schema = "place int, bits binary"
    united = rows.select(name).mapInArrow(parts, schema).groupBy("place").applyInArrow(unite, schema)
    bits = np.zeros(((1 << size) // FILTER_BLOCK, FILTER_BLOCK // 8), np.uint8)
    for row in united.collect():  # 16 MB at most
        bits[row["place"]] = np.frombuffer(row["bits"], np.uint8)
    return size, bits.ravel()


def in_filter(known: tuple[int, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    cells = _filter_cells(hashes, known[0])
    return (known[1][cells >> 3] >> (cells & 7) & 1).astype(bool).all(axis=0)


def _passing(known, once: bool = False):
    """Keeps the rows whose text may be in the filter, with packed data; with ``once`` a text once per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            hashes = batch.column("text_hash").to_numpy(zero_copy_only=False)
            keep = in_filter(known.value, hashes)
            if once:
                first = np.zeros(len(hashes), bool)
                first[np.unique(hashes, return_index=True)[1]] = True
                keep &= first
            batch = batch.filter(pa.array(keep))
            place = batch.schema.get_field_index("data")
            data = pa.array([packed(value.as_buffer()) for value in batch.column(place)], pa.binary())
            yield batch.set_column(place, batch.schema.field(place), data)

    return run


# ---- the two sorts


def _block_number() -> Iterator[int]:
    yield from range(TaskContext.get().partitionId() << 24, (TaskContext.get().partitionId() + 1) << 24)


def _send_first(length: int, buckets: int):
    """The sample suffixes, and the spans, which have buckets of their own."""
    short = length - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, prints = _block_number(), Fingerprints(PIECE + length)

        def blocks() -> tuple[Block, Block]:
            return (
                Block(next(numbers), "sample", buckets, SAMPLE_BYTES),
                Block(next(numbers), "spans", buckets, FULL_BYTES, buckets),
            )

        sample, spans = blocks()
        for batch in slices(batches):
            for text, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = data.as_buffer()
                places = sample_places(len(data), length)
                for begin in pieces(len(data)) if len(places) else ():
                    inside = places[(places >= begin) & (places < begin + PIECE)]
                    if len(inside):
                        part = data[begin : begin + PIECE + length]
                        sample.add(text, len(data), begin, prints.of(part, inside - begin, short))
                _, found, others = span_prints(*chosen_suffixes(data, prints, length), length)
                if len(found):
                    spans.add(text, len(data), 0, found, others)
                if sample.count >= BLOCK:
                    yield sample.rows()
                    yield spans.rows()
                    sample, spans = blocks()
        if sample.count:
            yield sample.rows()
            yield spans.rows()

    return run


FOUND = ("marks", "spans", "leaders")


def _read_first(length: int):
    """``(text_hash, n_suffixes, marks, spans, leaders)``: what has an equal, in each text.

    Marks are places of sample suffixes; spans and leaders are numbers of spans.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = []
        for sorts, text, size, runs in _answers(table):
            if sorts == "spans":
                spans, leaders = (np.concatenate([part[kind] for part in runs]) for kind in (1, 2))
                rows.append((text, 0, None, spans.astype("<i8").tobytes(), leaders.astype("<i8").tobytes()))
                continue
            places = sample_places(size, length)
            marks = np.sort(np.concatenate([places[np.searchsorted(places, first) + own] for first, own, _ in runs]))
            first, last = candidate_ranges(marks, size, length)
            rows.append((text, int((last - first + 1).sum()), marks.astype("<i8").tobytes(), None, None))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table(
            [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)],
            names=["text_hash", "n_suffixes", *FOUND],
        )

    return run


def uncertain_ranges(
    first: np.ndarray, last: np.ndarray, certain_first: np.ndarray, certain_last: np.ndarray
) -> Iterator[tuple[int, int]]:
    """The ranges without the certain ones; both are in order and free of overlaps."""
    cuts = iter([*zip(certain_first.tolist(), certain_last.tolist(), strict=True), (1 << 62, 1 << 62)])
    cut_first, cut_last = next(cuts)
    for start, stop in zip(first.tolist(), last.tolist(), strict=True):
        while start <= stop:
            while cut_last < start:
                cut_first, cut_last = next(cuts)
            if cut_first > start:
                yield start, min(stop, cut_first - 1)
            start = max(start, min(stop, cut_first - 1) + 1)
            if cut_first <= start:
                start = cut_last + 1


def united_ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges in order, of which neighbours that share a place become one."""
    new = np.r_[True, first[1:] > last[:-1]][: len(first)]
    return first[new], last[np.r_[new[1:], True][: len(first)]]


def _send_full(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, prints = _block_number(), Fingerprints(PIECE + length)
        block = Block(next(numbers), "full", buckets, FULL_BYTES)
        before = None
        for batch in slices(batches):
            for text, data, *found in zip(
                batch.column(0).to_pylist(), batch.column(1), *[batch.column(place).to_pylist() for place in (2, 3, 4)],
                strict=True,
            ):
                if text == before:
                    continue  # a copy, which is removed anyway
                before = text
                data = unpacked(data.as_buffer())
                marks, spans, leaders = (np.frombuffer(part or b"", "<i8") for part in found)
                first, last = candidate_ranges(marks, len(data), length)
                known_first = known_last = np.empty(0, np.int64)
                if len(spans):
                    chosen, *ends = chosen_suffixes(data, prints, length)
                    numbered, *_ = span_prints(chosen, *ends, length)
                    sure = numbered[spans]
                    block.certain += [
                        (text, start, stop + length)
                        for start, stop in zip(*(end.tolist() for end in united_ranges(chosen[sure], chosen[sure + 1])), strict=True)
                    ]
                    known = numbered[np.setdiff1d(spans, leaders)]
                    # The last suffix of a span belongs to the next one.
                    known_first, known_last = united_ranges(chosen[known], chosen[known + 1] - 1)
                for start, stop in uncertain_ranges(first, last, known_first, known_last):
                    for begin in range(start, stop + 1, PIECE):
                        count = min(PIECE, stop + 1 - begin)
                        part = data[begin : begin + count + length - 1]
                        block.add(text, len(data), begin, *prints.both(part, np.arange(count), length))
                if block.count >= BLOCK:
                    yield block.rows()
                    block = Block(next(numbers), "full", buckets, FULL_BYTES)
        if block.count or block.certain:
            yield block.rows()

    return run


def _read_full(length: int):
    """``(text_hash, spans)``: first and behind-the-last byte of runs to remove."""

    def run(table: pa.Table) -> pa.Table:
        texts, spans = [], []
        for kind, data in zip(table.column("kind").to_pylist(), table.column("data"), strict=True):
            if kind == "certain":
                rows = np.frombuffer(data.as_buffer(), "<i8").reshape(-1, 3)
                for part in np.split(rows, np.flatnonzero(np.diff(rows[:, 0])) + 1) if len(rows) else ():
                    texts.append(part[0, 0].item())
                    spans.append(np.ascontiguousarray(part[:, 1:]).tobytes())
        for _, text, _, runs in _answers(table):
            places = np.sort(np.concatenate([first + own for first, own, _ in runs]))
            new = np.r_[True, places[1:] > places[:-1] + length]
            texts.append(text)
            spans.append(
                np.stack((places[new], np.r_[places[:-1][new[1:]], places[-1]] + length), axis=1).astype("<i8").tobytes()
            )
        return pa.table({"text_hash": pa.array(texts, pa.int64()), "spans": pa.array(spans, pa.binary())})

    return run


def unite_spans(parts: list[bytes]) -> np.ndarray:
    """Spans that overlap or touch become one."""
    spans = np.concatenate([np.frombuffer(part, "<i8").reshape(-1, 2) for part in parts])
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    return np.stack((spans[new, 0], np.r_[reach[:-1][new[1:]], reach[-1]]), axis=1)


def repeated_spans(texts: DataFrame, narrow: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Of texts ``(text_hash, text)``: ``(text_hash, spans)`` to remove from single ones, and the hashes of copied ones.

    ``narrow`` has text_hash and n_bytes of the same rows.
    """
    context = texts.sparkSession.sparkContext
    ship_package(texts.sparkSession)
    sizes = stage(
        narrow.where(F.col("n_bytes") >= length)
        .groupBy("text_hash", "n_bytes")
        .agg(F.count(F.lit(1)).alias("copies")),
        "text_sizes",
    )
    suffixes = sizes.agg(F.sum(F.col("n_bytes") * F.col("copies"))).first()[0] or 0
    buckets = max(1, math.ceil(suffixes * len(COVER) / PERIOD / BUCKET))
    answered = "block long, kind string, data binary"
    first = (
        texts.select("text_hash", F.encode("text", "utf-8").alias("data"))
        .mapInArrow(_send_first(length, buckets), SENT)
        .groupBy("bucket")
        .applyInArrow(_sort_bucket(leaders_from=buckets), answered)
        .groupBy("block")
        .applyInArrow(
            _read_first(length), "text_hash long, n_suffixes long, marks binary, spans binary, leaders binary"
        )
    )
    marks = stage(first, "first_sort")
    some = context.broadcast(text_filter(marks, "text_hash"))
    total = marks.agg(F.sum("n_suffixes")).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET))
    rows = (
        texts.select("text_hash", F.encode("text", "utf-8").alias("data"))
        .mapInArrow(_passing(some, once=True), "text_hash long, data binary")
        .join(_one_row(marks), "text_hash")
        .select("text_hash", "data", *FOUND)
        .sortWithinPartitions("text_hash")
    )
    spans = (
        rows.mapInArrow(_send_full(length, buckets), SENT)
        .groupBy("bucket")
        .applyInArrow(_sort_bucket(), answered)
        .groupBy("block")
        .applyInArrow(_read_full(length), "text_hash long, spans binary")
    )
    copied = stage(sizes.where("copies > 1").select("text_hash"), "copied_texts")
    single = spans.groupBy("text_hash").agg(F.collect_set("spans").alias("spans"))
    return stage(single.join(copied, "text_hash", "left_anti"), "repeated_spans"), copied


def _one_row(marks: DataFrame) -> DataFrame:
    """One row per text with marks: what was found in it, from all blocks; a text's copies agree in that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            united = [
                [_union([np.frombuffer(part, "<i8") for part in parts]).tobytes() for parts in column.to_pylist()]
                for column in batch.columns[1:]
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(values, pa.binary()) for values in united]], names=["text_hash", *FOUND]
            )

    grouped = marks.groupBy("text_hash").agg(*[F.collect_set(name).alias(name) for name in FOUND])
    rows = grouped.where(F.size("marks") > 0)
    return stage(rows.mapInArrow(run, "text_hash long, marks binary, spans binary, leaders binary"), "found_in_texts")


def _cut(keep_data: bool):
    """Of ``(doc, data, spans)``: doc, the numbers, and what is left of the data or its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, removed, runs, kept = [], [], [], []
            for data, parts in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                data, spans = unpacked(data.as_buffer()), unite_spans(parts)
                left, at = [], 0
                for start, stop in spans.tolist():
                    left.append(data[at:start])
                    at = stop
                left = b"".join([*left, data[at:]])
                kept.append(left if keep_data else hashlib.sha256(left).hexdigest())
                sizes.append(len(data))
                removed.append(len(data) - len(left))
                runs.append(len(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(values, pa.int64()) for values in (sizes, removed, runs)],
                 pa.array(kept, pa.binary() if keep_data else pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept" if keep_data else "kept_sha256"],
            )

    return run


def _to_cut(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``(doc, data, spans)`` of the rows ``(doc, data, text_hash)`` to cut; only about these move with their data."""
    known = rows.sparkSession.sparkContext.broadcast(text_filter(spans, "text_hash"))
    return rows.mapInArrow(_passing(known), rows.schema).join(spans, "text_hash").select("doc", "data", "spans")


def repeated_substrings(
    docs: DataFrame, length: int = 200, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    text = whole_text(docs, text_column)
    texts = docs.select(column(docs, id_column).alias("doc"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    data = F.encode("text", "utf-8")
    narrow = stage(
        texts.select(
            "doc", "text_hash", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(data, 256).alias("digest")
        ),
        "narrow_rows",
    )
    spans, copied = repeated_spans(texts.select("text_hash", "text"), narrow, length)
    kind = texts.schema["doc"].dataType.simpleString()
    changed = _to_cut(texts.select("doc", data.alias("data"), "text_hash"), spans).mapInArrow(
        _cut(keep_data=False), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    touched = stage(
        spans.select("text_hash", F.lit(False).alias("whole")).unionByName(copied.withColumn("whole", F.lit(True))),
        "touched_texts",
    )
    gone, none = F.col("whole").isNotNull(), F.lit(0).cast("long")
    uncut = (
        narrow.join(touched, "text_hash", "left")
        .where("whole is null or whole")
        .select(
            F.col("doc").alias("doc_id"),
            "n_bytes",
            F.when(gone, F.col("n_bytes")).otherwise(none).alias("n_removed"),
            F.when(gone, F.lit(1).cast("long")).otherwise(none).alias("n_spans"),
            F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("digest")).alias("kept_sha256"),
        )
    )
    return uncut.unionByName(changed)


def without_repeats(docs: DataFrame, length: int = 200, text_column: str = "text") -> DataFrame:
    """The rows with what is left of their texts, with the columns of ``docs``."""
    names = [name for name in docs.columns if name.lower() != text_column.lower()]
    text = whole_text(docs, text_column)
    doc = F.struct(F.lit(0).alias("none"), *[column(docs, name).alias(f"c{place}") for place, name in enumerate(names)])
    texts = docs.select(doc.alias("doc"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    narrow = texts.select("text_hash", F.octet_length("text").cast("long").alias("n_bytes"))
    spans, copied = repeated_spans(texts.select("text_hash", "text"), narrow, length)
    rows = texts.select("doc", F.encode("text", "utf-8").alias("data"), "text_hash")
    kind = texts.schema["doc"].dataType.simpleString()
    changed = _to_cut(rows, spans).mapInArrow(
        _cut(keep_data=True), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    whole = copied.withColumn("whole", F.lit(True))
    left = F.when(F.col("whole").isNull(), F.col("data")).otherwise(F.lit(b""))
    rest = rows.join(spans.select("text_hash"), "text_hash", "left_anti").join(whole, "text_hash", "left")
    every = rest.select("doc", left.alias("kept")).unionByName(changed.select(F.col("doc_id").alias("doc"), "kept"))
    fields = {name: F.col(f"doc.c{place}") for place, name in enumerate(names)}
    readable = F.make_valid_utf8(F.col("kept").cast("string"))
    return every.select(*[fields[name].alias(name) if name in fields else readable.alias(name) for name in docs.columns])
