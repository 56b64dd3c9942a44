"""Words and hashed word shingles, for use inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

WORDS_KEPT = 500_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hash by word, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


_PRIMES = [
    np.uint64(prime)
    for prime in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
]


def _turned(values: np.ndarray, bits: int) -> np.ndarray:
    return (values << np.uint64(bits)) | (values >> np.uint64(64 - bits))


def _span_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The xxHash of spans of bytes, all at once; only long ones one by one."""
    p1, p2, p3, p4, p5 = _PRIMES
    hashes = sizes.astype(np.uint64) + p5

    def read(kind: str, places: np.ndarray) -> np.ndarray:
        width = np.dtype(kind).itemsize
        return np.ndarray(len(data) - width + 1, kind, data, 0, (1,))[places].astype(np.uint64)

    for lane in range(3):  # whole eight bytes
        here = np.flatnonzero(sizes >= 8 * (lane + 1))
        if not len(here):
            break
        value = _turned(read("<u8", starts[here] + 8 * lane) * p2, 31) * p1
        hashes[here] = _turned(hashes[here] ^ value, 27) * p1 + p4
    here = np.flatnonzero(sizes & 4)
    if len(here):
        value = read("<u4", starts[here] + (sizes[here] & ~7)) * p1
        hashes[here] = _turned(hashes[here] ^ value, 23) * p2 + p3
    for byte in range(3):
        here = np.flatnonzero((sizes & 3) > byte)
        value = data[starts[here] + (sizes[here] & ~3) + byte] * p5
        hashes[here] = _turned(hashes[here] ^ value, 11) * p1
    hashes ^= hashes >> np.uint64(33)
    hashes *= p2
    hashes ^= hashes >> np.uint64(29)
    hashes *= p3
    hashes ^= hashes >> np.uint64(32)
    for place in np.flatnonzero(sizes >= 32).tolist():
        start = int(starts[place])
        hashes[place] = xxhash.xxh64_intdigest(data[start : start + int(sizes[place])])
    return hashes


def text_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of words of each text, and the hashes of all words, without a Python object for each."""
    if not len(texts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    if first == last:
        return np.zeros(len(texts), np.int64), np.empty(0, np.uint64)
    data, offsets = np.frombuffer(data, np.uint8)[first:last], offsets - first
    inside = (data != 32) & ((data < 9) | (data > 13))
    # Before and behind each byte of a word there may be none, a space or a text's end.
    joined = np.zeros(len(data) + 1, bool)
    joined[1:-1] = inside[1:] & inside[:-1]
    joined[offsets] = False
    starts = np.flatnonzero(inside & ~joined[:-1])
    sizes = np.flatnonzero(inside & ~joined[1:]) + 1 - starts
    return np.diff(np.searchsorted(starts, offsets)), _span_hashes(data, starts, sizes)


def forget_words() -> None:
    """At the end of a task, as its worker goes on to tasks that need no words."""
    _hashes.clear()


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    values = values ^ (values >> np.uint64(30))
    values = values * _B
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in order; of all words if there are fewer; none without words."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    count = max(1, len(words) - size + 1)
    value = np.full(count, min(len(words), size), np.uint64) * _A
    for shift in range(min(len(words), size)):
        value = mixed(value * _A + hashes[shift : shift + count])
    return value


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
