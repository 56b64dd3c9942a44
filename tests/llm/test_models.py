"""Held-out quality of the trained operators."""

from __future__ import annotations

import random

import numpy as np

from scholaudit.llm import co_training, pseudo_likelihood
from scholaudit.llm.words import word_hashes


def sentences(rnd, n):
    parts = [["the", "a"], ["red", "old", "big"], ["dog", "cat", "man"], ["sees", "likes"], ["the", "a"], ["house", "tree"]]
    return " ".join(rnd.choice(part) for _ in range(n) for part in parts)


def test_pseudo_likelihood(spark):
    rnd = random.Random(1)
    rows = [(place, sentences(rnd, 20)) for place in range(400)]
    words = rows[0][1].split()
    shuffled = list(words)
    rnd.shuffle(shuffled)
    rows += [(1000, " ".join(shuffled)), (1001, None), (1002, ""), (1003, "zzz yyy"), (None, "the"), (0, rows[0][1])]
    rows += [(1004, sentences(rnd, 8_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as row", "3 as word")
    for top_bits in (14, 3):  # all words among the top ones, and most of them not
        found = pseudo_likelihood.score_documents(docs.repartition(4), top_bits=top_bits, known=4).collect()
        assert len(found) == len(rows)
        by = {row["doc_id"]: row for row in found}
        assert by[0]["n_words"] == 120 and by[1004]["n_words"] == 48_000
        assert by[0]["mean_log_likelihood"] > -1.6 > -2 > by[1000]["mean_log_likelihood"]
        assert abs(by[1004]["mean_log_likelihood"] - by[0]["mean_log_likelihood"]) < 0.3
        assert (by[1001]["n_words"], by[1001]["log_likelihood"], by[1001]["mean_log_likelihood"]) == (0, 0.0, None)
        assert len({row["log_likelihood"] for row in found if row["doc_id"] == 0}) == 1
    assert pseudo_likelihood.score_documents(docs.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert [row["log_likelihood"] for row in pseudo_likelihood.score_documents(empty).collect()] == [0.0, 0.0]


def test_a_rare_word_scores_above_a_typing_error(spark):
    """Both are beyond the top words; the word is known from its count and its neighbours."""
    rnd = random.Random(4)
    rows = [(place, sentences(rnd, 20).replace("tree", "sequoia" if place % 4 else "tree")) for place in range(300)]
    rows += [(1000, "the old sequoia"), (1001, "the old seqouia"), (1002, "sequoia the old"), (1003, "the old house")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pseudo_likelihood.score_documents(docs, top_bits=3, known=2).collect()
    by = {row["doc_id"]: row["log_likelihood"] for row in found}
    assert by[1000] > by[1001] + 2  # more than the chance of its leaf
    assert by[1000] > by[1002]
    assert by[1003] > by[1001]


def code_of(count, top_bits=4, seed=1):
    words = [f"w{place}".encode() for place in range(count)]
    hashes = word_hashes(words)
    top = min(count, (1 << top_bits) - 1)
    return words, pseudo_likelihood.Code(hashes[:top], count - top, top_bits)


def random_network(code, seed=2):
    values = np.random.default_rng(seed).standard_normal((pseudo_likelihood.Network.rows(code), pseudo_likelihood.HIDDEN + 1))
    return pseudo_likelihood.Network(code, values)


def test_chances_of_all_words_sum_to_one(monkeypatch):
    """Over top words, leaves and the levels that no word is on."""
    monkeypatch.setattr(pseudo_likelihood, "LEAF_WORDS", 4)
    words, code = code_of(15 + 64)
    network, reader = random_network(code), pseudo_likelihood.Reader(code)
    hashes = word_hashes(words)
    neighbours = np.tile(np.array([[0, 3, 9, 17]]), (len(words), 1))
    chances = np.exp(network.log_chances(neighbours, reader.ways(hashes, code.ranks(hashes))))
    leaves = code.leaf(hashes[15:])
    every_leaf = dict(zip(leaves.tolist(), chances[15:].tolist(), strict=True))
    assert len(every_leaf) == 1 << code.depth
    # A word's share of its leaf is the rest of its chance, so a leaf counts once.
    used = chances[:15].sum() + sum(every_leaf.values())
    hidden = network.hidden(neighbours[:1])
    of_levels = (hidden @ network.levels[:, :-1].T + network.levels[:, -1])[0]
    on_way, choice = pseudo_likelihood._ON_WAY, pseudo_likelihood._CHOICE
    level = np.exp(-(np.logaddexp(0, (1 - 2 * choice) * of_levels) * on_way).sum(axis=1))
    assert abs(level.sum() - 1) < 1e-9
    assert abs(used + level[4:31].sum() - 1) < 1e-9


def test_the_reader_goes_the_ways_of_the_code():
    words, code = code_of(700, 5)
    reader, hashes = pseudo_likelihood.Reader(code), word_hashes(words)
    ranks = code.ranks(hashes)
    levels, *ways = reader.ways(hashes, ranks)
    assert (levels == code.levels(ranks)).all()
    for own, stated in zip(ways, code.ways(hashes, ranks), strict=True):
        assert (own == stated).all()


def test_ways_tell_all_words_apart(monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "LEAF_WORDS", 1)
    words, code = code_of(400, 6)
    hashes = word_hashes(words)
    ranks = code.ranks(hashes)
    nodes, choices, length = code.ways(hashes, ranks)
    ends = np.cumsum(length)
    ways = {
        (level, tuple(nodes[end - size : end]), tuple(choices[end - size : end]))
        for level, end, size in zip(code.levels(ranks), ends, length, strict=True)
    }
    assert len(ways) == 63 + len(set(code.leaf(hashes[63:]).tolist()))
    assert nodes.max() < code.nodes and (np.bincount(nodes[: ends[62]], minlength=1)[:1] == 0).all()
    assert ranks[:63].tolist() == list(range(63)) and (ranks[63:] == -1).all()


def test_gradient():
    words, code = code_of(60)
    network, reader = random_network(code, 3), pseudo_likelihood.Reader(code)
    rnd = np.random.default_rng(4)
    _, hashes, ranks, neighbours = reader.windows([[words[place] for place in rnd.integers(0, 60, 50)]])
    order = pseudo_likelihood.top_first(ranks)
    neighbours, chosen = neighbours[order], reader.ways(hashes[order], ranks[order])
    fixed, of_nodes, back = network.slopes(neighbours, chosen)
    slopes = np.zeros_like(network.values)
    slopes[: len(fixed)] = fixed
    first = len(fixed) + code.neighbours
    np.add.at(slopes[first:], chosen[1], of_nodes)
    for place in range(2 * pseudo_likelihood.REACH):
        np.add.at(slopes[len(fixed) : first, :-1], neighbours[:, place], back * network.scales[place, :-1])
    for row in [0, 1, 4, 6, 9, *rnd.integers(len(fixed), len(slopes), 40)]:
        column = int(rnd.integers(0, pseudo_likelihood.HIDDEN + (row > 4)))
        kept, size = network.values[row, column], 1e-6
        losses = []
        for value in (kept + size, kept - size):
            network.values[row, column] = value
            losses.append(-network.log_chances(neighbours, chosen).sum())
        network.values[row, column] = kept
        if row >= len(fixed) and row < first and column == pseudo_likelihood.HIDDEN:
            continue  # vectors of neighbours have no bias
        assert abs((losses[0] - losses[1]) / (2 * size) - slopes[row, column]) < 1e-4, (row, column)


def test_texts_alone_and_together():
    words, code = code_of(40)
    network = random_network(code)
    rnd = random.Random(5)
    texts = [[rnd.choice(words) for _ in range(size)] for size in (4, 0, 60, 1)]
    counts, *_, logs = pseudo_likelihood.score_words(network, pseudo_likelihood.Reader(code), texts)
    assert counts.tolist() == [4, 0, 60, 1]
    alone = [pseudo_likelihood.score_words(network, pseudo_likelihood.Reader(code), [text])[-1] for text in texts]
    assert np.allclose(np.concatenate(alone), logs)


def test_co_training(spark):
    rnd = random.Random(2)
    good, bad = [f"g{place}" for place in range(80)], [f"b{place}" for place in range(80)]
    rows, labels = [], []
    for place in range(900):
        label = int(rnd.random() < 0.6)
        own = rnd.choices(good if label else bad, k=12) + rnd.choices([f"n{place}" for place in range(60)], k=30)
        rnd.shuffle(own)
        source = rnd.choice(["s1", "s2"] if (rnd.random() < 0.85) == bool(label) else ["s3", "s4"])
        rows.append((place, " ".join(own), source, "en", 200))
        if place < 60:
            labels.append((place, label, 0))
    truth = {row[0]: int(any(word.startswith("g") for word in row[1].split())) for row in rows}
    labels += [(61, 0, 0), (61, 1, 0), (62, None, 0), (None, 1, 0)]
    rows += [(5000, None, None, None, None), (5001, "", "s1", "en", 0), (None, "g1 g2", "s1", "en", 5), (0, rows[0][1], "s1", "en", 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    options = {"max_train": 40, "max_calibrate": 20, "grow": 40}
    found = co_training.classify(docs.selectExpr("*", "1 as kept"), table, **options).collect()
    assert len(found) == len(rows)
    held = [row for row in found if row["doc_id"] is not None and 60 <= row["doc_id"] < 900]
    right = [int(row["score"] > 0.5) == truth[row["doc_id"]] for row in held]
    assert np.mean(right) > 0.9
    bare = co_training.classify(docs.select("doc_id", "text"), table, **options)
    assert bare.count() == len(rows)
    assert co_training.classify(docs.limit(0), table, **options).count() == 0
    without = co_training.classify(docs, table.limit(0), **options)
    assert without.where("score = 0.5 and kept").count() == len(rows)


def test_copies_are_one_example(spark):
    """A thousand copies of the surest text do not fill the lists of the rounds."""
    rnd = random.Random(6)
    rows, labels = [], []
    for place in range(500):
        label = place % 2
        words = rnd.choices([f"g{n}" if label else f"b{n}" for n in range(30)], k=8) + [f"n{rnd.randrange(40)}"] * 3
        rows.append((place, " ".join(words), "s1" if label else "s3", "en", 100))
        if place < 60:
            labels.append((place, label))
    rows += [(10_000 + copy, "g1 g2 g3 g4 g5 " * 6, "s1", "en", 100) for copy in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    added = []
    fit = co_training.fit

    def counted(own, size):
        added.append(len({row.tobytes() for row in own.features}) - len(own.features))
        return fit(own, size)

    co_training.fit = counted
    try:
        scored = co_training.classify(docs, table, max_train=40, max_calibrate=20, grow=30, rounds=2).collect()
    finally:
        co_training.fit = fit
    # The text view's rows, first and in each round, are different ones.
    assert len(scored) == len(rows) and set(added[::2]) == {0}
