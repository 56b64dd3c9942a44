"""Batches by tree against the plain forms, and words read from whole texts."""

from __future__ import annotations

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from scholaudit.llm import pseudo_likelihood
from scholaudit.llm.words import text_hashes, word_hashes

SIZES = [(60, 4, 256), (5, 4, 256), (0, 4, 256), (1, 1, 256), (3000, 9, 2), (700, 12, 256)]


def batch(count, top_bits, seed=3):
    """A random network and random words, in the order of their trees and ways."""
    words = [f"w{place}".encode() for place in range(max(count, 1))]
    top = word_hashes(words)[: min(count, (1 << top_bits) - 1)]
    code = pseudo_likelihood.Code(top, count - len(top), top_bits)
    rnd = np.random.default_rng(seed)
    network = pseudo_likelihood.Network(code, rnd.standard_normal((pseudo_likelihood.Network.rows(code), 9)))
    reader = pseudo_likelihood.Reader(code)
    texts = [[words[place] for place in rnd.integers(0, len(words), size)] for size in (300, 0, 1, 1500)]
    read = reader.read(*pseudo_likelihood.list_hashes(texts))
    here, ways = reader.by_tree(read, rnd.permutation(len(read.hashes)))
    return network, read.neighbours(here), ways, reader.ways(read.hashes[here], read.ranks[here])


@pytest.mark.parametrize(("count", "top_bits", "leaf_words"), SIZES)
def test_chances_by_tree_are_those_word_by_word(monkeypatch, count, top_bits, leaf_words):
    monkeypatch.setattr(pseudo_likelihood, "LEAF_WORDS", leaf_words)
    network, neighbours, ways, plain = batch(count, top_bits)
    assert np.allclose(network.log_chances_by_tree(neighbours, ways), network.log_chances(neighbours, plain), rtol=0, atol=1e-9)


@pytest.mark.parametrize(("count", "top_bits", "leaf_words"), SIZES)
def test_a_step_by_tree_is_that_word_by_word(monkeypatch, count, top_bits, leaf_words):
    monkeypatch.setattr(pseudo_likelihood, "LEAF_WORDS", leaf_words)
    network, neighbours, ways, plain = batch(count, top_bits)
    network.vectors[:, 8] = network.scales[:, 8] = network.bias[:, 8] = 0
    fixed, of_nodes, back = network.slopes(neighbours, plain)
    first = len(fixed) + network.code.neighbours
    slopes, times = np.zeros_like(network.values), np.zeros(len(network.values))
    slopes[: len(fixed)], times[: len(fixed)] = fixed, len(back)
    np.add.at(slopes[first:], plain[1], of_nodes)
    np.add.at(times[first:], plain[1], 1)
    past = np.random.default_rng(5).random(slopes.shape)
    moved, squares, uses = network.values.copy(), past.copy(), np.zeros(len(slopes))
    copy = pseudo_likelihood.Network(network.code, moved)
    copy.step(neighbours, ways, pseudo_likelihood.Network(network.code, squares), uses)
    # Vectors of neighbours move by the scales that have moved.
    for place in range(2 * pseudo_likelihood.REACH):
        np.add.at(slopes[len(fixed) : first, :-1], neighbours[:, place], back * copy.scales[place, :-1])
        np.add.at(times[len(fixed) : first], neighbours[:, place], 1)
    slopes /= np.sqrt(np.maximum(times, 1))[:, None]
    past += slopes * slopes
    assert (uses == times).all()
    assert np.allclose(squares, past, rtol=1e-5)
    assert np.allclose(moved, network.values - pseudo_likelihood.RATE * slopes / (np.sqrt(past) + 1e-6), rtol=1e-5, atol=1e-6)


def test_uses_of_a_node_stand_together(monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "LEAF_WORDS", 2)
    network, neighbours, ways, _ = batch(3000, 9)
    rows = network.slopes_by_tree(neighbours, ways)[3]
    assert len(rows) > 1000 and len(set(rows.tolist())) == len(pseudo_likelihood._sums_by_row(rows, np.zeros((len(rows), 8)))[0])


def test_words_of_whole_texts():
    rnd = random.Random(1)
    letters = "ab \t\n\x0b\x0c\r\x1c\x00\x85\xa0é漢" + "wxyz" * 12
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(400))) for _ in range(300)]
    texts += ["", " ", "a", "x" * 100, "ab\n", "12345678", "x" * 31, "x" * 32]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts, kind)
        for part in (column, column.slice(3, 100), column.slice(300), column.slice(0, 0), column.slice(300, 2), pa.array([], kind)):
            split = [text.as_py().encode().split() for text in part]
            counts, hashes = text_hashes(part)
            assert counts.tolist() == [len(words) for words in split]
            assert (hashes == word_hashes([word for words in split for word in words])).all()


def test_tasks_look_up_no_words_one_by_one(monkeypatch):
    """Words are hashed on the bytes of the texts, without a Python object for each."""
    monkeypatch.setattr(pseudo_likelihood, "word_hashes", None)
    texts = pa.array(["the old dog sees the tree " * 40, "", "a man"])
    counted = list(pseudo_likelihood._count_words(iter([pa.RecordBatch.from_arrays([texts], names=["text"])])))
    assert sum(batch.column(1).to_numpy().sum() for batch in counted) == 242
    hashes = np.unique(text_hashes(texts)[1])
    code = pseudo_likelihood.Code(hashes[:3], len(hashes) - 3, 2)
    sent = [SimpleNamespace(value=value) for value in (code, pseudo_likelihood.Network.start(code).values)]
    assert list(pseudo_likelihood._train(*sent)(iter([pa.RecordBatch.from_arrays([texts], names=["text"])])))
    shares = SimpleNamespace(value=pseudo_likelihood.Shares(hashes[:0], np.empty(0)))
    rows = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([4, 5, 6]), texts], names=["row", "doc_id", "text"])
    (scored,) = pseudo_likelihood._score(*sent, shares)(iter([rows]))
    assert scored.column(2).to_pylist() == [240, 0, 2]
