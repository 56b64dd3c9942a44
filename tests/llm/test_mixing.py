from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from scholaudit.llm import mixing


def docs_of(spark):
    rnd = random.Random(5)
    rows = []
    for place in range(3000):
        source = "big" if rnd.random() < 0.6 else rnd.choice(["a", "b", "c", None])
        rows.append((place, source, " ".join("w" * rnd.randint(1, 30))))
    rows += [(5000, "a", None), (5001, "a", ""), (5002, "b", "w " * 4000), (None, "c", "w"), (5003, "c", "x"), (5003, "c", "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string")


def tokens(text):
    return len((text or "").split()) + 1


@pytest.mark.parametrize("target", [{"max_repetition": 2.0}, {"target_entropy": 1.5}, {"max_repetition": 1e9}])
def test_weights(spark, target):
    rows, docs = docs_of(spark)
    found = mixing.mixing_schedule(docs, block_tokens=5_000, **target).collect()
    sums = defaultdict(int)
    for _, source, text in rows:
        sums[source] += tokens(text)
    total = sum(sums.values())
    weights = {row["source"]: row["weight"] for row in found}
    assert math.isclose(sum(weights.values()), 1, abs_tol=1e-6)
    passes = [weights[source] / (sums[source] / total) for source in sums]
    if "target_entropy" in target:
        assert math.isclose(-sum(w * math.log(w) for w in weights.values()), 1.5, abs_tol=1e-6)
    elif target["max_repetition"] == 2.0:
        assert math.isclose(max(passes) / min(passes), 2.0, rel_tol=1e-6)
    else:
        assert len({round(weight, 6) for weight in weights.values()}) == 1
    # Every document is used, as often as its source's passes say; passes differ by one use at most.
    uses = Counter((row["doc_id"], row["source"]) for row in found if row["doc_id"] not in (None, 5003))
    assert set(uses) == {(doc, source) for doc, source, _ in rows if doc not in (None, 5003)}
    for (_, source), count in uses.items():
        expected = weights[source] / (sums[source] / total) / min(passes)
        assert expected - 1.001 <= count <= expected + 1.001


def test_blocks(spark):
    rows, docs = docs_of(spark)
    found = mixing.mixing_schedule(docs, max_repetition=2.0, block_tokens=5_000).collect()
    blocks = defaultdict(list)
    for row in found:
        blocks[row["block"]].append(row)
    assert sorted(blocks) == list(range(len(blocks)))
    long = tokens("w " * 4000)
    for block in blocks.values():
        assert sorted(row["position"] for row in block) == list(range(1, len(block) + 1))
        assert sum(row["n_tokens"] for row in block) <= 5_000 + long + 200
    shares = defaultdict(int)
    for row in blocks[0]:
        shares[row["source"]] += row["n_tokens"]
    weights = {row["source"]: row["weight"] for row in found}
    assert abs(shares["big"] / 5_000 - weights["big"]) < 0.05
    # The start of every use in its source's stream is its tokens so far; blocks follow from it.
    again = mixing.mixing_schedule(docs.repartition(7), max_repetition=2.0, block_tokens=5_000).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, found), key=repr)


def test_rows(spark):
    rows, docs = docs_of(spark)
    docs = docs.selectExpr("*", "doc_id as block", "1 as row")
    mixed = mixing.mix(docs, max_repetition=2.0, block_tokens=5_000)
    assert mixed.columns == docs.columns
    found = Counter((row["doc_id"], row["text"]) for row in mixed.collect())
    assert set(found) == {(doc, text) for doc, _, text in rows}
    assert found[5003, "x"] % 2 == 0


def test_small_buckets(spark, monkeypatch):
    rows, docs = docs_of(spark)
    expected = Counter(row["source"] for row in mixing.mixing_schedule(docs, max_repetition=2.0).collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    found = Counter(row["source"] for row in mixing.mixing_schedule(docs, max_repetition=2.0).collect())
    assert all(abs(found[source] - expected[source]) <= 0.05 * expected[source] for source in expected)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mixing_schedule(docs, max_repetition=2.0).count() == 0
    assert mixing.mix(docs, target_entropy=1.0).count() == 0
    with pytest.raises(ValueError):
        mixing.mixing_schedule(docs)
