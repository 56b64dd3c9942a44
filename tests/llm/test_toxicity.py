"""The recurrent network: gradients, windows, held-out documents, odd tables."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from scholaudit.llm import toxicity


def test_windows_overlap_and_cover_every_word():
    for words in (*range(100), 1000, 1001, 1015, 1016, 1017):
        starts = toxicity.window_starts(words)
        assert starts[0] == 0 and (np.diff(starts) <= toxicity.STRIDE).all() and (np.diff(starts) > 0).all()
        assert starts[-1] + toxicity.WINDOW >= words


def test_character_groups():
    buckets, counts = toxicity.character_groups([b"cat", b"a", b"cats"])
    # <cat>: groups of 3: 3, of 5: 1, beginnings of 3, 4, 5; <a>: 1 and 1; <cats>: 4, 2 and beginnings of 3 to 6.
    assert counts.tolist() == [7, 2, 10]
    again, _ = toxicity.character_groups([b"cats"])
    assert again.tolist() == buckets[9:].tolist()
    shared = set(buckets[:7].tolist()) & set(buckets[9:].tolist())
    assert len(shared) >= 4  # <ca, cat, and the beginnings <ca, <cat


def test_gradients():
    rnd = np.random.default_rng(2)
    network = toxicity.Network(toxicity.Network.start().values.astype(np.float64))
    vectors = rnd.standard_normal((9, network.SIZE))
    numbers = rnd.integers(0, 9, (5, 7))
    numbers[1, 4:] = -1
    numbers[2] = -1
    wanted, weight = np.array([1.0, 0, 1, 0, 1]), rnd.random(5)
    _, slopes, vector_back = network.slopes(vectors, numbers, wanted, weight)

    def loss():
        return network.slopes(vectors, numbers, wanted, weight)[0]

    def numeric(array, place):
        kept, step = array[place], 1e-6
        array[place] = kept + step
        above = loss()
        array[place] = kept - step
        below = loss()
        array[place] = kept
        return (above - below) / (2 * step)

    for name in network.DENSE:
        array = getattr(network, name)
        for _ in range(6):
            place = tuple(int(rnd.integers(size)) for size in array.shape)
            assert slopes[name][place] == pytest.approx(numeric(array, place), rel=1e-3, abs=1e-6), (name, place)
    for _ in range(8):
        place = (int(rnd.integers(9)), int(rnd.integers(network.SIZE)))
        assert vector_back[place] == pytest.approx(numeric(vectors, place), rel=1e-3, abs=1e-6)


def test_windows_read_alone_and_together():
    values = toxicity.Network.start().values
    texts = ["a b c", "", " ".join(f"w{place}" for place in range(100)), "b", "é東京 " * 50]
    together = toxicity.Reader(values).logits(texts)
    assert [len(own) for own in together] == [len(toxicity.window_starts(len(toxicity.words_of(t)))) for t in texts]
    for text, own in zip(texts, together, strict=True):
        assert np.allclose(toxicity.Reader(values).logits([text])[0], own, atol=1e-5)
    # A window is read as the words it holds.
    words = texts[2].split()
    for start, logit in zip(toxicity.window_starts(100), together[2], strict=True):
        assert np.allclose(toxicity.Reader(values).logits([" ".join(words[start : start + 32])])[0], logit, atol=1e-5)


def corpus(n, seed=1):
    """Toxic documents hold some rude words, or words that begin alike."""
    rnd = random.Random(seed)
    parts = ["an", "er", "on", "sti", "re", "th", "ing", "ou"]
    rows = []
    for doc in range(n):
        words = ["".join(rnd.choices(parts, k=rnd.randint(1, 4))) for _ in range(rnd.choice([20, 60, 300]))]
        toxic = int(rnd.random() < 0.3)
        if toxic:
            start = rnd.randrange(len(words) - 15)
            for place in rnd.sample(range(start, start + 15), 4):
                words[place] = rnd.choice(["rotter", "fiend", "zugva" + rnd.choice(parts), "zugva" + rnd.choice(parts)])
        rows.append((doc, " ".join(words), toxic))
    return rows


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 0


def test_held_out_documents(spark):
    rows = corpus(900)
    extra = [(2000, None), (2001, ""), (2002, "... --- !"), (2003, "x" * 50_000), (2004, "an er " * 40_000), (0, rows[0][1])]
    extra += [(None, rows[1][1]), (2005, "an er on " * 9000 + " rotter fiend rotter zugvaan fiend rotter " + "re th " * 9000)]
    docs = spark.createDataFrame([row[:2] for row in rows] + extra, "doc_id long, text string")
    docs = docs.selectExpr("*", "1 as label", "0.5 as Score", "7 as windows").repartition(4)
    labels = [(doc, toxic, 1 - toxic) for doc, _, toxic in rows]
    labels += [(5000, 1, 0), (None, 1, 0), (7, 1, 0), (7, 0, 0), (8, None, 0)]
    known = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    found = toxicity.score_documents(docs, known, epochs=8).collect()
    assert len(found) == len(rows) + len(extra)
    by = {row["doc_id"]: row for row in found}
    assert all(row["held_out"] == (row["doc_id"] is not None and held_out(row["doc_id"])) for row in found)
    assert all(0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5) for row in found)
    test = [(by[doc]["predicted"], toxic) for doc, _, toxic in rows if held_out(doc)]
    assert sum(guess == toxic for guess, toxic in test) / len(test) > 0.93
    assert sum(guess for guess, toxic in test if toxic) / sum(toxic for _, toxic in test) > 0.85
    assert by[2000]["score"] == by[2001]["score"] == by[2002]["score"] < 0.5
    assert by[2004]["predicted"] == 0 and by[2005]["score"] > by[2004]["score"]
    assert len({row["score"] for row in found if row["doc_id"] == 0}) == 1


def test_labels_of_held_out_documents_change_nothing(spark):
    rows = corpus(150, seed=3)
    docs = spark.createDataFrame([row[:2] for row in rows], "doc_id long, text string")
    turned = [(doc, 1 - toxic if held_out(doc) else toxic) for doc, _, toxic in rows]
    first, second = (
        toxicity.score_documents(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), epochs=1)
        .orderBy("doc_id")
        .collect()
        for labels in ([(doc, toxic) for doc, _, toxic in rows], turned)
    )
    assert first == second


def test_one_class_and_empty_tables(spark):
    docs = spark.createDataFrame([(doc, text) for doc, text, _ in corpus(30)], "doc_id long, text string")
    one = spark.createDataFrame([(doc, 0) for doc in range(30)], "doc_id long, toxic int")
    assert {(row["score"], row["predicted"]) for row in toxicity.score_documents(docs, one).collect()} == {(0.0, 0)}
    assert {row["score"] for row in toxicity.score_documents(docs, one.limit(0)).collect()} == {0.0}
    assert toxicity.score_documents(docs.limit(0), one).count() == 0
