from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scholaudit.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "\n\n  x \t", "it's I'LL we're'd 123４５ ①②", "a<|endoftext|>b <|endoftext|>", "the" * 2000, "x" * 3000,
    "\x1c\x1d a\x85b\u2028c\u00a0d\u3000", "e\u0301 日本語 한국어 😀😀", "\u0558 \u0c5c1 a\U0003d000b", "a b  c   d",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(n: int) -> list[str]:
    rnd = random.Random(1)
    common = [32, 10, 0x27, 0x73, 0x61, 0x31, 0x1C, 0x85, 0xA0, 0x3000]
    points = [point for point in range(0x20000) if not 0xD800 <= point < 0xE000]
    return ["".join(chr(rnd.choice(points if rnd.random() < 0.5 else common)) for _ in range(30)) for _ in range(n)]


def test_same_ids_and_text_as_the_library(library):
    own = bpe.Bpe(PATH)
    for text in TEXTS + random_texts(500):
        ids = library.encode(text, add_special_tokens=False).ids
        encoded = own.encode(text)
        assert np.frombuffer(encoded, "<u4").tolist() == ids, text
        assert own.decode(encoded) == library.decode(ids, skip_special_tokens=False) == text


def test_decoding_parts_of_characters(library):
    own = bpe.Bpe(PATH)
    ids = library.encode("日本語😀", add_special_tokens=False).ids
    for stop in range(len(ids)):
        assert own.decode(np.array(ids[:stop], "<u4").tobytes()) == library.decode(ids[:stop], skip_special_tokens=False)


def test_bounded_memory(monkeypatch, library):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 3)
    own = bpe.Bpe(PATH)
    text = "one two three four five six one two seven"
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text).ids
    assert len(own.known) <= 3


def test_digests(spark, library):
    rows = [(place, text) for place, text in enumerate(TEXTS)] + [(99, None), (99, None), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "text")
    found = sorted(bpe.token_digests(docs, PATH).collect(), key=repr)
    expected = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        data = np.array(ids, "<u4").tobytes()
        expected.append(
            (doc, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), True)
        )
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_encode_and_decode_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = bpe.decode(bpe.encode(docs, PATH), PATH).orderBy("doc_id").collect()
    assert [(row["decoded"], row["round_trip"]) for row in rows] == [("a b", True), ("", True)]
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs.withColumnRenamed("doc_id", "Token_IDs"), PATH)
