from __future__ import annotations

import random

import numpy as np
import pytest

from scholaudit.llm import jaccard_join as join


def rows_with_groups(seed=5, groups=12, copies=10):
    rnd = random.Random(seed)
    words = [f"w{place}" for place in range(400)]
    rows = []
    for group in range(groups):
        base = [rnd.choice(words) for _ in range(rnd.choice([8, 40, 150]))]
        for _ in range(rnd.randint(1, copies)):
            text = list(base)
            for _ in range(rnd.randint(0, max(1, len(text) // 40))):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
    rows += [(2000, ""), (2001, None), (2002, "one"), (2003, "One"), (2004, "one two"), (2004, "one two"), (None, "one two")]
    return rows


def expected(rows, size, percent):
    sets = []
    for _, text in rows:
        words = [word for word in (text or "").encode().lower().split()]
        sets.append({tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set())
    forest = join.Forest(len(rows))
    for i, first in enumerate(sets):
        for j in range(i):
            if first and sets[j] and 100 * len(first & sets[j]) >= percent * len(first | sets[j]):
                forest.join(i, j)
    least = {}
    for place, (doc, _) in enumerate(rows):
        if doc is not None:
            root = forest.root(place)
            least[root] = min(least.get(root, doc), doc)
    return sorted(
        ((doc, len(sets[place]), least.get(forest.root(place)) if sets[place] else doc) for place, (doc, _) in enumerate(rows)),
        key=repr,
    )


@pytest.mark.parametrize(
    "options",
    [
        {"size": 3, "percent": 90},
        {"size": 5, "percent": 80},
        {"size": 2, "percent": 60, "hot": 3, "region_shingles": 100, "block_shingles": 500},
    ],
)
def test_components(spark, options):
    rows = rows_with_groups()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "text").repartition(5)
    found = sorted(map(tuple, join.link_components(docs, **options).collect()), key=repr)
    assert found == expected(rows, options["size"], options["percent"])


def test_one_stays(spark):
    rows = rows_with_groups()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kept_id", "'x' as `a.b`")
    kept = join.one_per_component(docs, size=3, percent=90)
    assert kept.columns == docs.columns
    found = sorted((row["doc_id"] for row in kept.collect()), key=repr)
    wanted = {row[2] for row in expected(rows, 3, 90)}
    assert found == sorted(wanted, key=repr)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert join.link_components(docs).count() == 0
    assert join.one_per_component(docs).count() == 0


def test_voronoi_cells_find_all_links():
    rnd = np.random.default_rng(4)
    base = [rnd.integers(0, 2**63, 60, dtype=np.uint64) for _ in range(12)]
    sets = []
    for _ in range(300):
        own = base[rnd.integers(12)].copy()
        own[rnd.integers(0, 60, rnd.integers(0, 7))] = rnd.integers(0, 2**63, 1, dtype=np.uint64)
        sets.append(np.unique(own))
    region, plain = join.Region(sets, 85), join.Forest(len(sets))
    region.join(np.arange(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if join.linked(sets[i], sets[j], 85):
                plain.join(i, j)
    assert [region.forest.root(i) for i in range(300)] == [plain.root(i) for i in range(300)]


def test_profiles_never_rule_out_a_link():
    rnd = np.random.default_rng(2)
    for n in (9, 40, 700):
        first = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
        for drop in range(max(1, n // 10)):
            second = first[drop:]
            for classes in (16, 64):
                fit = join.may_link(
                    len(first), join.profile(first, classes), np.array([len(second)]),
                    join.profile(second, classes)[None, :], 90,
                )[0]
                assert fit or not join.linked(first, second, 90)
