"""Byte-level BPE encoding and decoding.

A word's symbols form a doubly linked list, and a priority queue holds the
rank and place of every pair that the vocabulary can merge. The lowest rank,
leftmost first, is merged in place; entries whose symbols have changed since
are skipped as stale. Decoding concatenates the bytes of the vocabulary's
strings and reads them as UTF-8, with U+FFFD for what is not.

Texts are cut first at the added tokens, as the tokenizers library does by
default, and then into words by the pattern of byte-level vocabularies.
Encoded words are remembered in a table of bounded size. Tokenizer files are
read inside the tasks from a path that is a parameter, so they must be at
that path on every machine.

Defined cases: null text is the empty text, with no tokens. Repeated rows give
repeated results. Further columns are carried along by ``encode``; a column of
theirs named like an output column must be renamed first, which raises a
``ValueError`` before any work.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholaudit.llm.shared import ship_package, slices, whole_text

# The word pattern of byte-level vocabularies. White space is
# Unicode's property, which leaves out U+001C to U+001F.
_CUT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?[^\p{{White_Space}}{letter}{number}]+"
    r"|\p{{White_Space}}+(?!\P{{White_Space}})|\p{{White_Space}}+"
)
WORDS = regex.compile(_CUT.format(letter=r"\p{L}", number=r"\p{N}"))

# Letters and digits of the regex module's Unicode tables that
# are not yet assigned in those of the tokenizers library (Unicode 16), where
# they count as neither.
NEWER = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF "
    "10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 "
    "16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 "
    "1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 "
    "1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
_NEWER = "[" + "".join("-".join(rf"\U{int(end, 16):08x}" for end in part.split("-")) for part in NEWER.split()) + "]"
HAS_NEWER = regex.compile(_NEWER)
STRICT_WORDS = regex.compile(
    "(?V1)" + _CUT.format(letter=rf"[\p{{L}}--{_NEWER}]", number=rf"[\p{{N}}--{_NEWER}]")
)

MEMORY_WORDS = 400_000  # words in each of two generations whose ids are remembered, per Python worker
MEMORY_LENGTH = 64  # longer words are encoded each time


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(byte) if byte in plain else chr(next(others)) for byte in range(256)]


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class _Newer(Exception):
    """A word has one of the newer letters, so its text must be cut by the strict pattern."""


class Bpe:
    """One vocabulary with its merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model, before = stated["model"], stated["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or stated["normalizer"]:
            raise ValueError(f"{path} is not a byte-level BPE without normaliser and prefix space")
        letters = byte_letters()
        byte_of = {letter: byte for byte, letter in enumerate(letters)}
        vocabulary = model["vocab"]
        self.first = [vocabulary[letter] for letter in letters]
        pairs = (pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"])
        self.merges = {
            (vocabulary[left], vocabulary[right]): (rank, vocabulary[left + right])
            for rank, (left, right) in enumerate(pairs)
        }
        added = {token["content"]: token["id"] for token in stated["added_tokens"]}
        self.strings = [b""] * (1 + max([*vocabulary.values(), *added.values()]))
        for text, place in vocabulary.items():
            self.strings[place] = bytes(byte_of[letter] for letter in text)
        for text, place in added.items():
            self.strings[place] = text.encode()
        self.added = {text: _packed([place]) for text, place in added.items()}
        longest_first = sorted(added, key=len, reverse=True)
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        ids: list[int] = [self.first[byte] for byte in word]
        n = len(ids)
        if n < 2:
            return ids
        find, push, pop = self.merges.get, heapq.heappush, heapq.heappop
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        pairs = zip(range(n), ids, ids[1:], strict=False)
        queue = [(*found, place, left, right) for place, left, right in pairs if (found := find((left, right)))]
        heapq.heapify(queue)
        while queue:
            _, merged, place, left, right = pop(queue)
            following = after[place]
            if ids[place] != left or following < 0 or ids[following] != right:
                continue  # stale: one of the two was merged since
            ids[place], ids[following] = merged, -1
            after[place] = beyond = after[following]
            if beyond >= 0:
                before[beyond] = place
                if found := find((merged, ids[beyond])):
                    push(queue, (*found, place, merged, ids[beyond]))
            previous = before[place]
            if previous >= 0:
                if found := find((ids[previous], merged)):
                    push(queue, (*found, previous, ids[previous], merged))
        return [symbol for symbol in ids if symbol >= 0]

    def _learn(self, word: str) -> bytes:
        encoded = self.older.get(word)
        if encoded is None:
            if not word.isascii() and HAS_NEWER.search(word):
                raise _Newer
            encoded = _packed(self.merge(word.encode()))
        if len(word) <= MEMORY_LENGTH:
            if len(self.known) >= MEMORY_WORDS:
                self.older, self.known = self.known, {}
            self.known[word] = encoded
        return encoded

    def _words(self, text: str) -> bytes:
        known, learn = self.known.get, self._learn
        try:
            return b"".join([known(word) or learn(word) for word in WORDS.findall(text)])
        except _Newer:
            words = STRICT_WORDS.findall(text)
            return b"".join([_packed(self.merge(word.encode())) for word in words])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.added_pattern:
            return self._words(text)
        parts = self.added_pattern.split(text)
        return b"".join(self.added[part] if place % 2 else self._words(part) for place, part in enumerate(parts))

    def decode(self, ids: bytes) -> str:
        strings = self.strings
        return b"".join([strings[place] for place in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """The vocabulary, once per Python worker."""
    return Bpe(path)


def _clash(docs: DataFrame, new: list[str]) -> None:
    taken = {name.lower() for name in docs.columns} & set(new)
    if taken:
        raise ValueError(f"rename these columns first: {sorted(taken)}")


def encode(docs: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """The rows with ``token_ids`` (array of int) and ``round_trip``, whether these decode to the text again."""
    ship_package(docs.sparkSession)
    _clash(docs, ["token_ids", "round_trip"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in slices(batches):
            texts = batch.column(-1).to_pylist()
            encoded = [bpe.encode(text) for text in texts]
            offsets = np.cumsum([0, *(len(ids) // 4 for ids in encoded)])
            values = pa.array(np.frombuffer(b"".join(encoded), "<i4"))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            same = pa.array([bpe.decode(own) == text for own, text in zip(encoded, texts, strict=True)], pa.bool_())
            names = [*batch.schema.names[:-1], "token_ids", "round_trip"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids, same], names)

    new = [T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]
    return docs.withColumn("token_ids", whole_text(docs, text_column)).mapInArrow(
        run, T.StructType([*docs.schema.fields, *new])
    )


def decode(tokens: DataFrame, path: str, ids_column: str = "token_ids") -> DataFrame:
    """The rows with ``decoded`` (string)."""
    ship_package(tokens.sparkSession)
    _clash(tokens, ["decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in slices(batches):
            texts = [bpe.decode(_packed(ids or [])) for ids in batch.column(-1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "decoded"]
            )

    schema = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.StringType())])
    return tokens.withColumn("decoded", F.col(ids_column)).mapInArrow(run, schema)


def token_digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in slices(batches):
            counts, ids_sha, text_sha, same = [], [], [], []
            for text in batch.column(1):
                text = text.as_py()
                ids = bpe.encode(text)
                decoded = bpe.decode(ids)
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                same.append(decoded == text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"],
            )

    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), whole_text(docs, text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    )
