"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network predicts each word from the two words on either side of it, with
the word itself masked. The hidden state is tanh of a bias and the neighbours'
vectors, each scaled by its place. The chance of a word is the product of the
choices on its way down a binary tree, each one a logistic function of the
state and the node's vector. A document's score is the sum over its words of
the logarithms of these conditional chances, and its mean.

The vocabulary is every different word of the corpus. The tree first tells a
word's level. The most frequent words (``2 ** top_bits - 1``) have a level for
each power of two of their rank, and leaves of their own. All other words are
on the last level and go down by the bits of their hash, to one leaf for each
``LEAF_WORDS`` of them, so the tree grows with the vocabulary; the words of a
leaf share its chance by their counts, which are of all documents and exact.
Neighbours have vectors of their own, or by hash beyond the top words, whose
number grows in the same way.

The first ``DENSE`` choices of a tree are made for all nodes of its head at
once, by products of matrices; further ones step by step, node by node.

Every window of the corpus trains the network once. A round takes the documents
of one part by hash; each task trains a copy on its documents, and copies are
averaged row by row, weighted by how often a row was used, in Spark. Only the
averaged network passes the driver.

The counts of the ``KNOWN`` most frequent words, at most, travel to the tasks;
occurrences of all other words meet their counts in a join.

Defined cases: null text is the empty text; a text without words has the sum 0
and no mean. The words beyond a text's ends are one special word. Repeated
rows get the same score each and all count in training. Very long texts are
scored in parts of ``PART`` words with their neighbours. With no words at all
the network stays as it starts. Empty tables give empty results. Further
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaudit.llm.shared import column, ship_package, slices, stage, whole_text
from scholaudit.llm.words import mixed, signed, text_hashes, word_hashes

REACH = 2  # words on either side
HIDDEN = 8
TOP_BITS = 14  # 2 ** TOP_BITS - 1 words have leaves of their own
LEVELS = 5  # bits of a level; the last one is for all other words
LEAF_WORDS = 256
DENSE = 6  # steps of each tree whose nodes are all computed
KNOWN = 1 << 18
ROUNDS, BATCH, RATE = 2, 4_096, 0.1
SHARD_WORDS = 2_000_000
PART = 16_384
PIECES = 64  # in which networks travel to be averaged
WORDS_COUNTED = 2_000_000

NEIGHBOURS = [place for place in range(2 * REACH + 1) if place != REACH]


def _head(steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a tree's first steps, for each way (its choices as bits), the nodes on it and the choices there."""
    on_way = np.zeros((1 << steps, 1 << steps), np.float32)
    choice = np.zeros((1 << steps, 1 << steps), np.float32)
    for way in range(1 << steps):
        for step in range(steps):
            node = (1 << step) + (way >> (steps - step))
            on_way[way, node] = 1
            choice[way, node] = way >> (steps - 1 - step) & 1
    return on_way, choice


# For each level, the nodes of its way among the 2 ** LEVELS of the first tree, and the choices there.
_LAST = (1 << LEVELS) - 1
_ON_WAY, _CHOICE = _head(LEVELS)

# The same as the numbers of the five nodes, and 1 or -1 for the choices there.
_WAY = np.nonzero(_ON_WAY)[1].reshape(1 << LEVELS, LEVELS)
_SIGN = np.take_along_axis(2 * _CHOICE - 1, _WAY, axis=1)


class Head:
    """For the words of one tree, their level's five nodes and, behind them, the first nodes of the tree.

    By way: the numbers of its nodes; 1 or 0 and 1 or -1 for its choices; 1 for the nodes of the tree on it.
    """

    def __init__(self, level: int, steps: int):
        on_way, choice = _head(steps)
        self.level, self.on_way = _WAY[level], on_way
        below = np.nonzero(on_way)[1].reshape(len(on_way), steps)
        of_level = np.tile(_CHOICE[level, self.level], (len(on_way), 1))
        self.nodes = np.concatenate((np.tile(np.arange(LEVELS), (len(on_way), 1)), LEVELS + below), axis=1)
        self.choice = np.concatenate((of_level, np.take_along_axis(choice, below, axis=1)), axis=1)
        self.sign = 2 * self.choice - 1


class Code:
    """Levels of words, their ways below, and the rows of the network that they use.

    ``frequent`` has the hashes of the top words by falling frequency,
    ``rare`` is the number of all other words. Neighbours: row 0 is the edge,
    then the top words, then shared ones. Nodes: those of the top words' levels,
    then those of the last level.
    """

    def __init__(self, frequent: np.ndarray, rare: int, top_bits: int = TOP_BITS):
        self.frequent = frequent[: (1 << top_bits) - 1]
        order = np.argsort(self.frequent)
        self.order = np.append(order, -1)
        self.sorted = np.append(self.frequent[order], np.uint64(~np.uint64(0)))
        # Where words begin that start with some 16 bits, and how many do at most.
        self.first = np.searchsorted(self.sorted[:-1] >> np.uint64(48), np.arange((1 << 16) + 1, dtype=np.uint64))
        self.longest = int(np.diff(self.first).max())
        self.depth = max(1, math.ceil(math.log2(max(1, rare / LEAF_WORDS))))
        self.shared = 1 + len(self.frequent)
        self.neighbours = self.shared + (1 << self.depth)
        self.others = 1 << max(1, len(self.frequent)).bit_length()
        self.nodes = self.others + (1 << self.depth)
        # All trees below the levels, longest first: (steps, number before the first node, level).
        trees = [(level, (1 << level) - 1, level) for level in range(len(self.frequent).bit_length())]
        self.trees = sorted([*trees, (self.depth, self.others, _LAST)], reverse=True)
        self.way_bits = self.trees[0][0]
        self.heads = [Head(level, min(steps, DENSE)) for steps, _, level in self.trees]
        self.head_nodes = np.concatenate([before + np.arange(1 << min(steps, DENSE)) for steps, before, _ in self.trees])

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """Of top words; -1 for all others."""
        place = self.first.take((hashes >> np.uint64(48)).view(np.int64))
        for _ in range(self.longest):
            place += self.sorted.take(place) < hashes
        return np.where(self.sorted.take(place) == hashes, self.order.take(place), -1)

    def leaf(self, hashes: np.ndarray) -> np.ndarray:
        """The leaf of words that are not among the top ones."""
        return (mixed(hashes) >> np.uint64(64 - self.depth)).astype(np.int64)

    def neighbour_rows(self, hashes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        return np.where(ranks >= 0, 1 + ranks, self.shared + self.leaf(hashes ^ np.uint64(0x5BD1E995)))

    def levels(self, ranks: np.ndarray) -> np.ndarray:
        return np.where(ranks >= 0, np.frexp(np.maximum(ranks + 1, 1).astype(np.float64))[1] - 1, _LAST)

    def ways(self, hashes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes below the levels, with choices (1 or 0), of all words, and the length of each word's way."""
        top = ranks >= 0
        length = np.where(top, self.levels(ranks), self.depth)
        code = np.where(top, ranks + 1 - (np.int64(1) << np.where(top, length, 0)), self.leaf(hashes))
        owner = np.repeat(np.arange(len(hashes)), length)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
        value, bits = code[owner], length[owner]
        heap = (np.int64(1) << step) + (value >> (bits - step))  # a node's number among those of its tree
        # The tree of level l has its nodes at 2 ** l and beyond.
        node = np.where(top[owner], (np.int64(1) << bits) + heap - 1, self.others + heap)
        return node, (value >> (bits - 1 - step)) & 1, length


def _run_sums(values: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Sums of runs of rows, which may be empty."""
    values = np.concatenate((values, np.zeros((1, *values.shape[1:]), values.dtype)))
    sums = np.add.reduceat(values, np.cumsum(length) - length, axis=0)
    sums[length == 0] = 0
    return sums


def _small(values: np.ndarray, most: int) -> np.ndarray:
    """16 bits where they do: such numbers are sorted in linear time."""
    return values.astype(np.uint16) if most <= 1 << 16 else values


def _sigmoid(logits: np.ndarray) -> np.ndarray:
    """In place."""
    np.maximum(logits, -60, out=logits)
    np.exp(np.negative(logits, out=logits), out=logits)
    logits += 1
    return np.reciprocal(logits, out=logits)


def _softplus(logits: np.ndarray) -> np.ndarray:
    """In place; of 60 at most, so that no chance is 0."""
    np.minimum(logits, 60, out=logits)
    np.exp(logits, out=logits)
    logits += 1
    return np.log(logits, out=logits)


def _put(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Whole rows, each as one value."""
    row = f"V{table.itemsize * table.shape[1]}"
    table.view(row)[:, 0].put(rows, np.ascontiguousarray(values).view(row)[:, 0])


def _sums_by_row(rows: np.ndarray, slopes: np.ndarray, biases: np.ndarray | None = None):
    """Different rows, of rows that stand together, the sums of their slopes, biases behind, and how many there are."""
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])[: len(rows)])
    sums = np.zeros((len(starts), HIDDEN + 1), slopes.dtype)
    if len(starts):
        pairs = np.result_type(slopes.dtype, np.complex64)  # two columns are summed as one complex number
        sums[:, :HIDDEN] = np.add.reduceat(slopes.view(pairs), starts, axis=0).view(slopes.dtype)
        if biases is not None:
            sums[:, HIDDEN] = np.add.reduceat(biases, starts)
    return rows[starts], sums, np.diff(np.append(starts, len(rows)))


class Ways(NamedTuple):
    """Of words by trees and ways: choices below the levels as bits, and the number of words by tree.

    In this order words that use a node stand together, at every step of a tree.
    """

    ways: np.ndarray
    sizes: np.ndarray


class Network:
    """Rows of neighbours' vectors and of nodes' vectors with their biases, and the few others."""

    def __init__(self, code: Code, values: np.ndarray):
        self.code, self.values = code, values
        width = HIDDEN + 1
        parts = np.split(values, np.cumsum([1, 2 * REACH, 1 << LEVELS, code.neighbours]))
        self.bias, self.scales, self.levels, self.vectors, self.nodes = parts
        assert values.shape == (self.rows(code), width)

    @staticmethod
    def rows(code: Code) -> int:
        return 1 + 2 * REACH + (1 << LEVELS) + code.neighbours + code.nodes

    @classmethod
    def start(cls, code: Code) -> Network:
        network = cls(code, np.zeros((cls.rows(code), HIDDEN + 1), np.float32))
        network.scales[:, :HIDDEN] = 0.5
        network.vectors[:, :HIDDEN] = np.random.default_rng(1).standard_normal((code.neighbours, HIDDEN)) * 0.3
        return network

    def _scaling(self) -> np.ndarray:
        """The scales as a matrix, from vectors side by side to their scaled sum."""
        return np.concatenate([np.diag(scales) for scales in self.scales])

    def states(self, neighbours: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The neighbours' vectors side by side, and the hidden states with a 1 at their end, which meets the biases."""
        vectors = self.vectors.take(neighbours.ravel(), axis=0).reshape(len(neighbours), -1)
        states = vectors @ self._scaling()
        states += self.bias[0]
        np.tanh(states, out=states)
        states[:, HIDDEN] = 1
        return vectors, states

    def hidden(self, neighbours: np.ndarray) -> np.ndarray:
        return self.states(neighbours)[1][:, :HIDDEN]

    def _heads(self, ways: Ways, states: np.ndarray) -> Iterator[tuple]:
        """By tree with words: their places, its head, their ways in it, its nodes' vectors, the logits on the ways, and where."""
        end = 0
        for (steps, before, _), head, size in zip(self.code.trees, self.code.heads, ways.sizes, strict=True):
            here = slice(end, end := end + size)
            if size:
                most = min(steps, DENSE)
                nodes = np.concatenate((self.levels[head.level], self.nodes[before : before + (1 << most)]))
                first = ways.ways[here] >> (steps - most)
                at = head.nodes.take(first, axis=0)
                at += np.arange(0, size * len(nodes), len(nodes))[:, None]
                yield here, head, first, nodes, (states[here] @ nodes.T).ravel().take(at), at

    def _tails(self, ways: Ways) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The nodes and choices of each further step, of the first words, whose trees have it."""
        trees = [(size, steps, before) for (steps, before, _), size in zip(self.code.trees, ways.sizes, strict=True)]
        sizes, steps, before = np.array([tree for tree in trees if tree[1] > DENSE], np.int64).reshape(-1, 3).T
        left, before = np.repeat(steps - DENSE, sizes), np.repeat(before, sizes)
        for step in range(DENSE, max(steps, default=0)):
            count = int(sizes[steps > step].sum())
            if not count:
                return
            value = ways.ways[:count] >> (left[:count] - 1)
            yield before[:count] + (1 << step) + (value >> 1), value & 1
            left -= 1

    def log_chances_by_tree(self, neighbours: np.ndarray, ways: Ways) -> np.ndarray:
        """The same as log_chances, of words by trees and ways."""
        _, states = self.states(neighbours)
        logs = np.empty(len(states))
        for here, head, first, _, logits, _ in self._heads(ways, states):
            logits *= head.sign.take(first, axis=0)
            logs[here] = -_softplus(np.negative(logits, out=logits)).sum(axis=1)
        for rows, choices in self._tails(ways):
            own = self.nodes.take(rows, axis=0)
            logits = np.einsum("ij,ij->i", own, states[: len(rows)])
            logs[: len(rows)] -= _softplus(np.where(choices, -logits, logits))
        return logs

    def slopes_by_tree(self, neighbours: np.ndarray, ways: Ways):
        """The same as slopes, of words by trees and ways.

        Of the bias, the scales and the levels; of the heads' nodes, summed, with
        their uses; of further nodes, by number, without and of their biases; of
        the states.
        """
        vectors, states = self.states(neighbours)
        kind = self.values.dtype
        back = np.empty_like(states)
        fixed = np.zeros((1 + 2 * REACH + (1 << LEVELS), HIDDEN + 1), kind)
        levels = fixed[1 + 2 * REACH :]
        sums = {}
        for here, head, first, nodes, logits, at in self._heads(ways, states):
            error = np.zeros((len(first), len(nodes)), kind)
            error.ravel()[at] = _sigmoid(logits) - head.choice.take(first, axis=0)
            np.matmul(error, nodes, out=back[here])
            total = error.T @ states[here]
            levels[head.level] += total[:LEVELS]
            sums[head] = total[LEVELS:], np.bincount(first, minlength=len(head.on_way)) @ head.on_way
        none = [(np.zeros((len(head.on_way), HIDDEN + 1), kind), np.zeros(len(head.on_way))) for head in self.code.heads]
        of_heads, uses = map(np.concatenate, zip(*map(sums.get, self.code.heads, none), strict=True))
        inner = np.ascontiguousarray(states[:, :HIDDEN])
        rows, of_nodes, of_biases = [np.empty(0, np.int64)], [np.empty((0, HIDDEN), kind)], [np.empty(0, kind)]
        for at, choices in self._tails(ways):
            own = self.nodes.take(at, axis=0)
            error = _sigmoid(np.einsum("ij,ij->i", own, states[: len(at)]))
            error -= choices
            rows.append(at)
            of_nodes.append(inner[: len(at)] * error[:, None])
            of_biases.append(error)
            own *= error[:, None]
            back[: len(at)] += own
        back *= 1 - states * states
        fixed[0] = back.sum(axis=0)
        of_scales = (vectors.T @ back).reshape(2 * REACH, HIDDEN + 1, HIDDEN + 1)
        fixed[1 : 1 + 2 * REACH] = np.diagonal(of_scales, axis1=1, axis2=2)
        return fixed, of_heads, uses, *map(np.concatenate, (rows, of_nodes, of_biases)), back[:, :HIDDEN]

    def step(self, neighbours: np.ndarray, ways: Ways, squares: Network, uses: np.ndarray) -> None:
        """One step of Adagrad on a batch; ``uses`` counts how often each row was moved."""
        fixed, of_heads, times, rows, of_nodes, of_biases, back = self.slopes_by_tree(neighbours, ways)
        count = len(fixed)
        fixed /= math.sqrt(len(back))
        squares.values[:count] += fixed * fixed
        self.values[:count] -= RATE * fixed / (np.sqrt(squares.values[:count]) + 1e-6)
        uses[:count] += len(back)
        scaling = np.concatenate([np.diag(scales[:HIDDEN]) for scales in self.scales])
        of_vectors, before = (back @ scaling.T).reshape(-1, HIDDEN), count + len(self.vectors)
        order = np.argsort(_small(neighbours.ravel(), len(self.vectors)), kind="stable")
        self._move(squares, uses, count, *_sums_by_row(neighbours.ravel()[order], of_vectors.take(order, axis=0)))
        self._move(squares, uses, before, self.code.head_nodes, of_heads, times)
        self._move(squares, uses, before, *_sums_by_row(rows, of_nodes, of_biases))

    def _move(self, squares: Network, uses: np.ndarray, before: int, rows: np.ndarray, sums: np.ndarray, times: np.ndarray):
        """Different rows, counted from ``before``, by the sums of their slopes."""
        rows = rows + before
        # Frequent rows move by their mean slope times the root of their uses.
        sums /= np.sqrt(np.maximum(times, 1), dtype=np.float32)[:, None]
        squared = squares.values.take(rows, axis=0)
        squared += sums * sums
        _put(squares.values, rows, squared)
        np.sqrt(squared, out=squared)
        squared += 1e-6
        sums *= RATE
        sums /= squared
        _put(self.values, rows, self.values.take(rows, axis=0) - sums)
        uses[rows] += times

    # Word by word, in any order: the plain forms that those by tree are tested against.

    def _errors(self, hidden: np.ndarray, levels: np.ndarray, nodes: np.ndarray, length: np.ndarray):
        """Logits at the levels' nodes of all words, vectors of the nodes below, the states there and the logits."""
        of_levels = np.clip(hidden @ self.levels[:, :HIDDEN].T + self.levels[:, HIDDEN], -60, 60)
        own, spread = self.nodes[nodes], np.repeat(hidden, length, axis=0)
        return of_levels, own, spread, np.einsum("ij,ij->i", own[:, :HIDDEN], spread) + own[:, HIDDEN]

    def log_chances(self, neighbours: np.ndarray, words: tuple) -> np.ndarray:
        """Of words given as (levels, nodes, choices, lengths), from rows of neighbours."""
        levels, nodes, choices, length = words
        of_levels, _, _, logits = self._errors(self.hidden(neighbours), levels, nodes, length)
        on_way = np.take_along_axis(of_levels, _WAY[levels], axis=1) * _SIGN[levels]
        # Logits are clipped, so no chance is 0 and a product of five is none either.
        of_level = np.log(1 + np.exp(-on_way)).sum(axis=1)
        return -of_level - _run_sums(np.log(1 + np.exp((1 - 2 * choices) * np.clip(logits, -60, 60))), length)

    def slopes(self, neighbours: np.ndarray, words: tuple):
        """Of the loss: of the bias, the scales and the levels; of nodes one by one; of the states."""
        levels, nodes, choices, length = words
        hidden = self.hidden(neighbours)
        of_levels, own, spread, logits = self._errors(hidden, levels, nodes, length)
        level_error = (1 / (1 + np.exp(-of_levels)) - _CHOICE[levels]) * _ON_WAY[levels]
        error = 1 / (1 + np.exp(-logits)) - choices
        of_nodes = np.empty((len(error), HIDDEN + 1), self.values.dtype)
        np.multiply(spread, error[:, None], out=of_nodes[:, :HIDDEN])
        of_nodes[:, HIDDEN] = error
        back = level_error @ self.levels[:, :HIDDEN]
        back += _run_sums(error[:, None] * own[:, :HIDDEN], length)
        back *= 1 - hidden * hidden
        fixed = np.zeros((1 + 2 * REACH + (1 << LEVELS), HIDDEN + 1), self.values.dtype)
        fixed[0, :HIDDEN] = back.sum(axis=0)
        for place in range(2 * REACH):
            fixed[1 + place, :HIDDEN] = (back * self.vectors[neighbours[:, place], :HIDDEN]).sum(axis=0)
        fixed[1 + 2 * REACH :, :HIDDEN] = level_error.T @ hidden
        fixed[1 + 2 * REACH :, HIDDEN] = level_error.sum(axis=0)
        return fixed, of_nodes, back


class Words(NamedTuple):
    """Words with edges before, between and behind their texts.

    Of words: hashes, ranks, trees, choices below the levels as bits, places.
    At all places: rows as neighbours.
    """

    hashes: np.ndarray
    ranks: np.ndarray
    trees: np.ndarray
    ways: np.ndarray
    places: np.ndarray
    rows: np.ndarray

    def neighbours(self, here: np.ndarray | slice) -> np.ndarray:
        return self.rows.take(self.places[here, None] + (np.array(NEIGHBOURS) - REACH))


class Reader:
    """Words of texts as hashes, levels, ways and rows; those of the top words are at hand."""

    def __init__(self, code: Code):
        self.code = code
        ranks = np.append(np.arange(len(code.frequent)), -1)  # the last one for all other words
        levels = code.levels(ranks)
        tree_of_level = np.zeros(1 << LEVELS, np.int64)
        tree_of_level[[level for _, _, level in code.trees]] = np.arange(len(code.trees))
        self.trees = tree_of_level[levels]
        self.top_ways = ranks + 1 - (1 << np.where(ranks >= 0, levels, 0))

    def ways(self, hashes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Levels, nodes, choices and lengths, word by word."""
        return self.code.levels(ranks), *self.code.ways(hashes, ranks)

    def by_tree(self, words: Words, here: np.ndarray) -> tuple[np.ndarray, Ways]:
        """The words at some numbers by trees and ways, and their ways."""
        trees = words.trees[here]
        here = here[np.argsort(trees << self.code.way_bits | words.ways[here], kind="stable")]
        return here, Ways(words.ways[here], np.bincount(trees, minlength=len(self.code.trees)))

    def read(self, counts: np.ndarray, hashes: np.ndarray) -> Words:
        """Words of texts, given by their hashes and the number of words of each text."""
        ranks = self.code.ranks(hashes)
        places = np.arange(len(hashes)) + np.repeat(REACH * np.arange(1, len(counts) + 1), counts)
        rows = np.zeros(len(hashes) + REACH * (len(counts) + 1), np.int64)
        rows[places] = 1 + ranks
        other = np.flatnonzero(ranks < 0)
        ways = self.top_ways.take(ranks)
        ways[other] = self.code.leaf(hashes[other])
        rows[places[other]] = self.code.neighbour_rows(hashes[other], ranks[other])
        return Words(hashes, ranks, self.trees.take(ranks), ways, places, rows)

    def windows(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all words of the texts: number of words by text, hashes, ranks and the rows of their neighbours."""
        counts, hashes = list_hashes(texts)
        words = self.read(counts, hashes)
        return counts, hashes, words.ranks, words.neighbours(slice(None))


def top_first(ranks: np.ndarray) -> np.ndarray:
    """An order with the top words before all others."""
    return np.argsort(ranks < 0, kind="stable")


def list_hashes(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The number of words of each text, and the hashes of all words."""
    return np.array([len(own) for own in texts], np.int64), word_hashes(list(chain.from_iterable(texts)))


def hashes_of(batches: Iterator[pa.RecordBatch], place: int, rows: int = 64) -> Iterator[tuple]:
    """Batches in small parts, with the number of words of each text and the hashes of all words."""
    for batch in slices(batches, rows):
        yield batch, *text_hashes(batch.column(place))


# ---- Spark


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their uses, counted in the task for a bounded number of uses at once."""
    read, size = [np.empty(0, np.uint64)], 0

    def rows() -> pa.RecordBatch:
        words = np.sort(np.concatenate(read))
        starts = np.flatnonzero(np.append(True, words[1:] != words[:-1])[: len(words)])
        uses = np.diff(np.append(starts, len(words)))
        return pa.RecordBatch.from_arrays([pa.array(signed(words[starts])), pa.array(uses)], names=["word", "uses"])

    for _, _, hashes in hashes_of(batches, 0):
        read.append(hashes)
        size += len(hashes)
        if size > WORDS_COUNTED:
            yield rows()
            read, size = [np.empty(0, np.uint64)], 0
    yield rows()


def _unsigned(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().view(np.uint64)


class Shares:
    """Logarithms of words' shares of their leaves, of the words whose counts are at hand."""

    def __init__(self, hashes: np.ndarray, logs: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.logs = hashes[order], logs[order].astype(np.float64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """NaN where the word is not at hand."""
        if not len(self.hashes):
            return np.full(len(hashes), np.nan)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[place] == hashes, self.logs[place], np.nan)


def count_vocabulary(
    texts: DataFrame, top_bits: int = TOP_BITS, known: int = KNOWN
) -> tuple[Code, Shares, DataFrame, int]:
    """The code of all words, the shares of frequent ones, ``(word, log_share)`` of all but the top ones, and all uses."""
    uses = stage(
        texts.mapInArrow(_count_words, "word long, uses long").groupBy("word").agg(F.sum("uses").alias("uses")),
        "word_uses",
    )
    totals = uses.agg(F.count(F.lit(1)).alias("words"), F.sum("uses").alias("uses")).first()

    def fewest(most: int) -> int:
        """The least number of uses that at most so many words have."""
        above = 0
        for row in uses.groupBy("uses").count().orderBy(F.desc("uses")).limit(most).collect():  # rows rise with uses
            above += row["count"]
            if above > most:
                return row["uses"] + 1
        return 1

    # At most 2 ** top_bits - 1 rows; words of equal frequency are all among them or none.
    frequent = uses.where(F.col("uses") >= fewest((1 << top_bits) - 1)).orderBy(F.desc("uses"), "word").toArrow()
    code = Code(_unsigned(frequent, "word"), totals["words"] - len(frequent), top_bits)
    sent = texts.sparkSession.sparkContext.broadcast(code)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_numpy().view(np.uint64)
            other = pa.array(sent.value.ranks(words) < 0)
            leaf = pa.array(sent.value.leaf(words))
            yield pa.RecordBatch.from_arrays([*batch.columns, leaf], names=["word", "uses", "leaf"]).filter(other)

    others = stage(uses.mapInArrow(leaves, "word long, uses long, leaf long"), "other_words")
    of_leaf = others.groupBy("leaf").agg(F.sum("uses").alias("leaf_uses"))
    share = F.log(F.col("uses") / F.col("leaf_uses")).alias("log_share")
    shares = stage(others.join(of_leaf, "leaf").select("word", "uses", share), "word_shares")
    at_hand = shares.where(F.col("uses") >= fewest(known)).select("word", "log_share").toArrow()  # at most ``known``
    near = Shares(_unsigned(at_hand, "word"), at_hand.column("log_share").to_numpy())
    return code, near, shares.select("word", "log_share"), totals["uses"] or 0


def _train(code, network):
    """The documents of a task train a copy, which leaves in pieces with the uses of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, copy = Reader(code.value), Network(code.value, network.value.copy())
        squares = Network(code.value, np.zeros_like(copy.values))
        uses = np.zeros(len(copy.values), np.float32)
        rnd = np.random.default_rng(3)
        trained = False
        for _, counts, hashes in hashes_of(batches, 0):
            words = reader.read(counts, hashes)
            order = rnd.permutation(len(hashes))
            for start in range(0, len(order), BATCH):
                here, ways = reader.by_tree(words, order[start : start + BATCH])
                copy.step(words.neighbours(here), ways, squares, uses)
                trained = True
        if not trained:
            return
        for piece, rows in enumerate(np.array_split(np.arange(len(uses)), PIECES)):
            used = rows[uses[rows] > 0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([piece], pa.int32()),
                    pa.array([used.astype("<i4").tobytes()], pa.binary()),
                    pa.array([uses[used].astype("<f4").tobytes()], pa.binary()),
                    pa.array([copy.values[used].astype("<f2").tobytes()], pa.binary()),
                ],
                names=["piece", "rows", "uses", "data"],
            )

    return run


def _average(table: pa.Table) -> pa.Table:
    """One piece of the network from all copies, in a fixed order: rows used, and their weighted means."""
    parts = sorted(zip(*[[bytes(data) for data in table.column(n).to_pylist()] for n in ("rows", "uses", "data")], strict=True))
    rows = np.concatenate([np.frombuffer(part, "<i4") for part, _, _ in parts])
    uses = np.concatenate([np.frombuffer(part, "<f4") for _, part, _ in parts]).astype(np.float64)
    data = np.concatenate([np.frombuffer(part, "<f2").reshape(-1, HIDDEN + 1) for _, _, part in parts])
    order = np.argsort(rows, kind="stable")
    used, starts = np.unique(rows[order], return_index=True)
    if len(used):
        weights = uses[order, None]
        data = np.add.reduceat(weights * data[order], starts, axis=0) / np.add.reduceat(weights, starts, axis=0)
    return pa.table(
        {
            "rows": pa.array([used.astype("<i4").tobytes()], pa.binary()),
            "data": pa.array([data.astype("<f4").tobytes()], pa.binary()),
        }
    )


def train(texts: DataFrame, code: Code, words: int, rounds: int = ROUNDS) -> Network:
    context = texts.sparkSession.sparkContext
    sent, network = context.broadcast(code), Network.start(code)
    shards = max(1, math.ceil(words / SHARD_WORDS))
    for turn in range(rounds):
        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn).coalesce(shards)
        copies = part.mapInArrow(
            _train(sent, context.broadcast(network.values)), "piece int, rows binary, uses binary, data binary"
        )
        averaged = copies.groupBy("piece").applyInArrow(_average, "rows binary, data binary")
        for row in averaged.collect():  # one network
            rows = np.frombuffer(row["rows"], "<i4")
            network.values[rows] = np.frombuffer(row["data"], "<f4").reshape(-1, HIDDEN + 1)
    return network


def score_hashes(network: Network, reader: Reader, counts: np.ndarray, hashes: np.ndarray):
    """Of all words of texts, their ranks and the logarithms of their chances, shares left out."""
    words, logs = reader.read(counts, hashes), np.empty(len(hashes))
    for start in range(0, len(logs), PART):
        here, ways = reader.by_tree(words, np.arange(start, min(start + PART, len(logs))))
        logs[here] = network.log_chances_by_tree(words.neighbours(here), ways)
    return words.ranks, logs


def score_words(network: Network, reader: Reader, texts: list[list[bytes]]):
    """Numbers of words by text, and of all words the hashes, ranks and logarithms of the chances, shares left out."""
    counts, hashes = list_hashes(texts)
    return counts, hashes, *score_hashes(network, reader, counts, hashes)


def _score(code, network, shares):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, model, near = Reader(code.value), Network(code.value, network.value), shares.value
        for batch, counts, hashes in hashes_of(batches, 2):
            ranks, logs = score_hashes(model, reader, counts, hashes)
            other = np.flatnonzero(ranks < 0)
            known = near.of(hashes[other])
            absent = np.isnan(known)
            logs[other] += np.where(absent, 0, known)
            missing = other[absent]
            ends = np.r_[0, np.cumsum(counts)]
            sums = np.r_[0.0, np.cumsum(logs)][ends]
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(missing, ends).astype(np.int32)), pa.array(signed(hashes[missing]))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts), pa.array(np.diff(sums)), lists],
                names=["row", "doc_id", "n_words", "log_likelihood", "missing"],
            )

    return run


def score_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int = ROUNDS,
    top_bits: int = TOP_BITS,
    known: int = KNOWN,
) -> DataFrame:
    """One row per row: doc_id, n_words, log_likelihood, mean_log_likelihood."""
    context = docs.sparkSession.sparkContext
    ship_package(docs.sparkSession)
    texts = docs.select(whole_text(docs, text_column).alias("text"))
    code, near, shares, words = count_vocabulary(texts, top_bits, known)
    network = train(texts, code, words, rounds)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        column(docs, id_column).alias("doc_id"),
        whole_text(docs, text_column).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = [context.broadcast(one) for one in (code, network.values, near)]
    scored = stage(
        rows.mapInArrow(
            _score(*sent), f"row long, doc_id {kind}, n_words long, log_likelihood double, missing array<long>"
        ),
        "words_scored",
    )
    # Occurrences of words whose counts the tasks did not have.
    rest = (
        scored.select("row", F.explode("missing").alias("word"))
        .join(shares, "word")
        .groupBy("row")
        .agg(F.sum("log_share").alias("shares"))
    )
    total = F.col("log_likelihood") + F.coalesce("shares", F.lit(0.0))
    return scored.join(rest, "row", "left").select(
        "doc_id",
        "n_words",
        F.round(total, 3).alias("log_likelihood"),
        F.round(F.when(F.col("n_words") > 0, total / F.col("n_words")), 6).alias("mean_log_likelihood"),
    )
