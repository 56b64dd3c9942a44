from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from scholaudit.llm import suffix_dedup as dedup


def removed(texts, length):
    places = {}
    for text in texts:
        for place in range(len(text) - length + 1):
            part = text[place : place + length]
            places[part] = places.get(part, 0) + 1
    marks = []
    for text in texts:
        mark = np.zeros(len(text), bool)
        for place in range(len(text) - length + 1):
            if places[text[place : place + length]] > 1:
                mark[place : place + length] = True
        marks.append(mark)
    return marks


def rows():
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passages = [prose(n) for n in (34, 40, 45, 60, 120, 400)]
    found = []
    for place in range(120):
        text = prose(rnd.randint(0, 120))
        if rnd.random() < 0.6:
            text += rnd.choice(passages) + prose(rnd.randint(0, 50)) + rnd.choice(["", rnd.choice(passages)])
        found.append((place, text))
    found += [(500, "z" * 450), (501, "z" * 199), (502, "q" * 201), (503, None), (504, ""), (None, found[5][1])]
    found += [(505, found[7][1]), (505, found[7][1])]
    return found


@pytest.mark.parametrize("block", [1_000_000, 700])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(dedup, "BUCKET", 5_000)
    cases = rows()
    docs = spark.createDataFrame(cases, "doc_id long, text string").selectExpr("*", "1 as text_hash").repartition(6)
    if block < 1_000_000:  # as many tasks, and so blocks, as texts
        docs = docs.repartition(100)
    texts = [(text or "").encode() for _, text in cases]
    expected = []
    for (doc, _), text, mark in zip(cases, texts, removed(texts, 200), strict=True):
        kept = bytes(np.frombuffer(text, np.uint8)[~mark])
        runs = int((np.diff(np.r_[0, mark.astype(int)]) == 1).sum())
        expected.append((doc, len(text), int(mark.sum()), runs, hashlib.sha256(kept).hexdigest()))
    found = map(tuple, dedup.repeated_substrings(docs).collect())
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_texts_that_are_left(spark):
    cases = rows()
    docs = spark.createDataFrame(cases, "doc_id long, text string").selectExpr("*", "2 as whole")
    texts = [(text or "").encode() for _, text in cases]
    expected = [
        (doc, bytes(np.frombuffer(text, np.uint8)[~mark]).decode("utf-8", "replace"), 2)
        for (doc, _), text, mark in zip(cases, texts, removed(texts, 200), strict=True)
    ]
    left = dedup.without_repeats(docs)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(expected, key=repr)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert dedup.repeated_substrings(docs).count() == 0


def test_cover_has_every_difference():
    assert len({(a - b) % dedup.PERIOD for a in dedup.COVER for b in dedup.COVER}) == dedup.PERIOD


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(dedup, "PIECE", dedup.PERIOD * 2)
    text = random.Random(1).randbytes(3000)
    prints = dedup.Fingerprints(3000)
    whole = prints.of(text, np.arange(2801), 200)
    chosen, found, others = dedup.chosen_suffixes(text, prints, 200)
    assert (others == prints.of(text, np.arange(2801), 200, 1)[chosen]).all()
    assert chosen.tolist() == np.flatnonzero(whole % np.uint64(dedup.CHOSEN) == 0).tolist()
    assert (found == whole[chosen]).all()


def test_numbers_round_trip():
    rnd = random.Random(4)
    for most in (50, 3000, 1_000_000):
        numbers = sorted(rnd.sample(range(most), rnd.randint(0, 40)))
        assert dedup.unpacked_numbers(dedup.packed_numbers(np.array(numbers, np.int64))).tolist() == numbers


def test_uncertain_ranges():
    rnd = random.Random(1)

    def ranges():
        ends = sorted(rnd.sample(range(60), 2 * rnd.randint(0, 4)))
        return np.array(ends[::2], np.int64), np.array(ends[1::2], np.int64)

    def places(first, last):
        return {place for start, stop in zip(first, last, strict=True) for place in range(start, stop + 1)}

    for _ in range(500):
        own, known = ranges(), ranges()
        found = [place for start, stop in dedup.uncertain_ranges(*own, *known) for place in range(start, stop + 1)]
        assert sorted(found) == sorted(places(*own) - places(*known))


def sent(prints, others, buckets=1, width=dedup.FULL_BYTES):
    """A block's rows to the buckets, and which of its own it tells to be equal."""
    block = dedup.Block(0, "full", buckets, width)
    block.add(1, 10_000, 0, np.array(prints, np.uint64), np.array(others, np.uint64))
    rows = block.rows().to_pylist()
    own = next(row["data"] for row in rows if row["kind"] == "own")
    return [row for row in rows if row["kind"] == "suffixes"], dedup.unpacked_numbers(own).tolist()


def repeated(blocks):
    """What a bucket answers to several blocks."""
    table = pa.Table.from_pylist(
        [{**row, "block": number} for number, rows in enumerate(blocks) for row in rows],
        pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("kind", pa.string()), ("data", pa.binary())]),
    )
    found = dedup._sort_bucket()(table).to_pylist()
    return [dedup.unpacked_numbers(row["data"]).tolist() for row in found]


@pytest.mark.parametrize("bit", [0, 7, 31, 55, 56, 60, 63])
def test_every_bit_of_the_first_polynomial_counts(bit):
    first, own = sent([5, 9], [1, 1])
    assert own == []
    other, _ = sent([5 ^ (1 << bit), 9], [1, 1])
    assert repeated([first, other]) == [[1], [1]]


def test_equal_halves_are_no_equals():
    """Suffixes that one polynomial takes for equal are told apart by the other, in a block and in a bucket."""
    first, own = sent([7, 7, 7, 8], [1, 2, 1, 1])
    assert own == [0, 2]
    other, own = sent([7, 7], [3, 2])
    assert own == []
    assert repeated([first, other]) == [[1], [1]]
    alone, _ = sent([7] * 50, list(range(100, 150)))
    assert repeated([first, alone]) == [[], []]


def test_all_buckets_are_used():
    rnd = np.random.default_rng(3)
    prints = rnd.integers(0, 2**64, 2_000_000, dtype=np.uint64)
    buckets = 300_000
    block = dedup.Block(0, "full", buckets, dedup.FULL_BYTES)
    used = dedup.mixed(prints + np.uint64(dedup._OTHER_BASE)) % np.uint64(buckets)
    counts = np.bincount(used.astype(np.int64), minlength=buckets)
    assert (counts > 0).mean() > 0.99 and counts.max() < 40
    block.add(1, 10, 0, prints[:1000], prints[:1000])
    groups = [row["bucket"] for row in block.rows().to_pylist() if row["kind"] == "suffixes"]
    assert sorted(groups) == sorted(set(used[:1000].tolist()))


def test_the_filter_grows_with_the_texts():
    assert dedup.filter_bits(0) == dedup.LEAST_FILTER_BITS
    assert [2 ** dedup.filter_bits(n) // n >= 16 for n in (10_000, 1_000_000, 4_000_000)] == [True] * 3
    assert dedup.filter_bits(10**12) == dedup.MOST_FILTER_BITS


def test_the_filter_holds_its_texts(spark):
    rnd = np.random.default_rng(5)
    held, others = rnd.integers(-(2**62), 2**62, (2, 20_000))
    known = dedup.text_filter(spark.createDataFrame([(int(n),) for n in held], "text_hash long").repartition(5), "text_hash")
    assert dedup.in_filter(known, held).all() and dedup.in_filter(known, others).mean() < 0.05
