"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np

from scholaudit.llm import bond_negatives


def brute_force(rows):
    used = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        used.append((vec_id, [math.floor(256 * x) for x in vector], label))

    def score(a, b):
        return sum(x * y for x, y in zip(a[1], b[1], strict=False))

    def order(pair):
        return (-pair[0], pair[1][0] is None, pair[1][0] or 0)

    result = []
    for place, anchor in enumerate(used):
        if anchor[0] is None or anchor[0] % 100:
            continue
        scored = [(score(anchor, row), row) for at, row in enumerate(used) if at != place]
        positives = sorted((pair for pair in scored if pair[1][2] == anchor[2]), key=order)[:5]
        for high, positive in positives:
            window = [p for p in scored if p[1][2] != anchor[2] and 30 * high <= 100 * p[0] <= 90 * high]
            for rank, (low, negative) in enumerate(sorted(window, key=order)[:10], 1):
                result.append((anchor[0], positive[0], rank, negative[0], high, low))
    return sorted(result, key=repr)


def vectors(seed, n, size=12, labels=4, digits=2):
    rnd = random.Random(seed)
    # Few digits make many equal scores.
    return [
        (place, [round(rnd.gauss(0.1, 0.3), digits) for _ in range(size)], rnd.randrange(labels)) for place in range(n)
    ]


def frame(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return table.selectExpr("*", "1 as row", "2 as Vector", "3 as score").repartition(3)


def as_floats(rows):
    """The vectors as the table stores them."""
    return [
        (i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows
    ]


def found(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_against_brute_force(spark):
    rows = vectors(1, 620)
    rows += [rows[3], rows[100], (200, [0.5] * 12, 1), (None, rows[0][1], 0), (None, rows[5][1], 2)]
    rows += [(1000, None, 1), (1100, [1.0] * 12, None), (1200, [math.nan] + [1.0] * 11, 1), (1300, [], 2)]
    rows += [(1401, [None] + [1.0] * 11, 1), (1500, [math.inf] + [1.0] * 11, 1), (1600, [0.3] * 5, 3), (1700, [-0.2] * 12, 0)]
    expected = brute_force(as_floats(rows))
    mined = bond_negatives.hard_negatives(frame(spark, rows))
    assert mined.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert found(mined) == expected and len(expected) > 100
    assert found(bond_negatives.hard_negatives(frame(spark, rows), slab=50, anchor_block=3)) == expected


def test_few_rows_and_equal_scores(spark):
    rows = vectors(2, 9, labels=2) + [(100 * place, [0.25] * 12, place % 2) for place in range(1, 8)]
    assert found(bond_negatives.hard_negatives(frame(spark, rows))) == brute_force(as_floats(rows))


def test_one_label_and_empty_tables(spark):
    rows = [(place, vector, 1) for place, vector, _ in vectors(3, 40) if place % 7]
    assert found(bond_negatives.hard_negatives(frame(spark, [*rows, (100, [0.1] * 12, 1)]))) == []
    assert found(bond_negatives.hard_negatives(frame(spark, rows).limit(0))) == []


def test_large_components(spark):
    """Scores beyond what doubles hold exactly."""
    rnd = random.Random(4)
    rows = [(place, [float(rnd.randrange(-(2**17), 2**18)) for _ in range(6)], rnd.randrange(3)) for place in range(300)]
    expected = brute_force(as_floats(rows))
    assert max(row[4] for row in expected) > 2**50
    assert found(bond_negatives.hard_negatives(frame(spark, rows))) == expected


def test_scan_shrinks_the_candidates(monkeypatch):
    """Rows that can't reach the bar are not read to the end."""
    rnd = np.random.default_rng(5)
    rows = rnd.integers(-50, 50, (2000, 32))
    slab = bond_negatives.Slab(rows, np.zeros(2000), np.arange(2000), np.zeros(2000, bool), np.arange(2000))
    anchor = np.array([200, 150, 100, 60, *[5] * 28])
    every = rows @ anchor
    low = np.sort(every)[-20]
    candidates, scores = bond_negatives.scan(slab, anchor, np.arange(2000), np.array([low]), None)
    assert sorted(candidates.tolist()) == np.flatnonzero(every >= low).tolist()
    assert (scores == every[candidates]).all()
    # One window with both ends.
    candidates, _ = bond_negatives.scan(slab, anchor, np.arange(2000), np.array([0]), np.array([1000]))
    assert sorted(candidates.tolist()) == np.flatnonzero((every >= 0) & (every <= 1000)).tolist()
