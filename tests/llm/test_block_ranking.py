"""Ranked search against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from scholaudit.llm import block_ranking

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    upper = str.maketrans(block_ranking.UPPER, block_ranking.LOWER)
    return TERMS.findall((text or "").translate(upper))


def brute_force(docs, items, k=10):
    counted = [(doc, Counter(terms_of(text))) for doc, text in docs]
    counted = [(doc, uses) for doc, uses in counted if uses]
    total, words = len(counted), sum(uses.total() for _, uses in counted)
    held = Counter(term for _, uses in counted for term in uses)
    result = []
    for item, text in items:
        scores = []
        for doc, uses in counted:
            m = 10 + (90 * uses.total() * total) // words
            score = 0
            for term in set(terms_of(text)) & set(uses):
                weight = math.floor(1000 * math.log((2 * total + 2) / (2 * held[term] + 1)))
                score += weight * ((1_000_000_000 * uses[term]) // (1000 * uses[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        scores.sort(key=lambda row: row[:3])
        result += [(item, rank, row[3], -row[0]) for rank, row in enumerate(scores[:k], 1)]
    return sorted(result, key=repr)


def tables(spark, seed, n):
    rnd = random.Random(seed)
    common, rare = [f"w{place}" for place in range(30)], [f"Rare{place}é" for place in range(400)]

    def text(size):
        return " ".join(rnd.choice(rare) if rnd.random() < 0.2 else rnd.choice(common) for _ in range(size))

    docs = [(place, text(rnd.choice([1, 5, 30, 120]))) for place in range(n)]
    docs += [(3, docs[3][1]), (n + 1, docs[5][1]), (n + 2, None), (n + 3, ""), (n + 4, "... !!"), (None, docs[7][1])]
    docs += [(n + 5, text(20_000)), (n + 6, "W1-w2_W3 été ÉTÉ 東京 Ⅳ"), (n + 7, "w1,w2.w3")]
    items = [(place, text(12)) for place in range(25)]
    items += [(0, items[0][1]), (90, None), (91, ""), (92, "nowhere"), (None, "w1 w2"), (93, "ÉTÉ 東京 w3 w3 w3")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as Terms")
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as item")
    return docs, items, frame.repartition(5), asked


def found(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_against_brute_force(spark):
    docs, items, frame, asked = tables(spark, 1, 900)
    expected = brute_force(docs, items)
    ranked = block_ranking.rank_documents(frame, asked)
    assert ranked.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(ranked) == expected
    assert found(block_ranking.rank_documents(frame, asked, shard=37, item_block=10)) == expected


def test_fewer_and_more_than_k(spark):
    docs, items, frame, asked = tables(spark, 2, 60)
    assert found(block_ranking.rank_documents(frame, asked, k=3)) == brute_force(docs, items, 3)
    assert found(block_ranking.rank_documents(frame, asked, k=500)) == brute_force(docs, items, 500)


def test_empty_tables(spark):
    _, _, frame, asked = tables(spark, 3, 20)
    assert found(block_ranking.rank_documents(frame.limit(0), asked)) == []
    assert found(block_ranking.rank_documents(frame, asked.limit(0))) == []


def random_shard(seed, docs=400, terms=60):
    rnd = np.random.default_rng(seed)
    size = rnd.integers(1, 25, docs)
    start = np.r_[0, np.cumsum(size)]
    own = np.concatenate([np.sort(rnd.choice(terms, one, replace=False)) for one in size])
    weights = rnd.integers(0, 9000, terms)
    return block_ranking.Shard(start, own, rnd.integers(1, 10**6, len(own)), weights), weights


def test_blocks_hold_each_list_and_its_maxima(monkeypatch):
    monkeypatch.setattr(block_ranking, "BLOCK", 16)
    shard, _ = random_shard(4)
    for place, postings in enumerate(shard.postings):
        members, maxima = shard.blocked(place)
        assert sorted(np.concatenate(members).tolist()) == postings.tolist()
        for docs, highest in zip(members, maxima, strict=True):
            expected = np.zeros(len(shard.known), np.int64)
            for doc in docs:
                rows = slice(shard.start[doc], shard.start[doc + 1])
                expected[shard.local[rows]] = np.maximum(expected[shard.local[rows]], shard.impact[rows])
            assert (expected == highest).all()


def test_skipped_blocks_lose_nothing(monkeypatch):
    """A search scores fewer documents than hold a term and finds the same ones."""
    monkeypatch.setattr(block_ranking, "BLOCK", 8)
    shard, weights = random_shard(5, docs=3000)
    rnd = np.random.default_rng(6)
    less = 0
    for _ in range(40):
        terms = np.sort(rnd.choice(60, 5, replace=False))
        item = np.zeros(len(shard.known), np.int64)
        for term in terms.tolist():
            item[shard.place[term]] = weights[term]
        every = shard.scores(np.arange(shard.count), item)
        best = block_ranking.Best(10, 0)
        scored = block_ranking.search(
            shard, terms, weights, best, np.zeros(shard.count, np.int64), np.arange(shard.count)
        )
        expected = sorted((-int(score), doc) for doc, score in enumerate(every) if score > 0)[:10]
        assert [(-row[0], row[2]) for row in best.rows.tolist()] == expected
        less += scored < 0.7 * (every > 0).sum()
    assert less >= 20
