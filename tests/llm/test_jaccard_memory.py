"""What the tasks of the Jaccard join keep and hand over."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from scholaudit.llm import jaccard_join, words


def texts(rows: int, size: int) -> list[str]:
    rnd = np.random.default_rng(5)
    return [" ".join(f"w{number}" for number in rnd.integers(0, 10**6, size)) for _ in range(rows)]


def points_by_bucket(batches) -> dict[int, bytes]:
    found: dict[int, bytes] = {}
    for batch in batches:
        for bucket, points in zip(batch.column("bucket").to_pylist(), batch.column("points").to_pylist(), strict=True):
            found[bucket] = found.get(bucket, b"") + points
    return found


def regions(rows: list[str], buckets: int) -> list[pa.RecordBatch]:
    sketch = SimpleNamespace(value=np.zeros(1 << jaccard_join.SKETCH_BITS, "<u4"))
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])
    return list(jaccard_join._regions(3, 90, buckets, jaccard_join.HOT, sketch)(iter([batch])))


def test_words_are_forgotten_with_the_task():
    """Workers go on to later stages; half a million words stayed with each of them."""
    rows = texts(50, 200)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(50)), pa.array([0] * 50, pa.int64()), pa.array(rows)], names=["doc_id", "text_hash", "text"]
    )
    measured = list(jaccard_join._measure(3)(iter([batch])))
    assert sum(one.num_rows for one in measured) > 50 and not words._hashes
    assert regions(rows, 4) and not words._hashes
    keys = pa.array([jaccard_join.set_key(jaccard_join.shingle_set(text.encode(), 3)) for text in rows])
    assert words._hashes
    (sets,) = jaccard_join._sets(3)(iter([pa.RecordBatch.from_arrays([keys, pa.array(rows)], names=["key", "text"])]))
    assert sets.num_rows == 50 and not words._hashes


def test_points_leave_in_small_batches():
    rows = texts(400, 3_000)
    batches = regions(rows, 8)
    assert max(batch.column("points").nbytes for batch in batches) <= jaccard_join.SENT_BYTES
    found = points_by_bucket(batches)
    expected = []
    for text in rows:
        hashes = jaccard_join.shingle_set(text.encode(), 3)
        pivots, _ = jaccard_join.windows(hashes, np.zeros(1 << jaccard_join.SKETCH_BITS, "<u4"), 90)
        expected += [(pivot, jaccard_join.set_key(hashes), len(hashes)) for pivot in pivots.tolist()]
    points = {bucket: np.frombuffer(parts, jaccard_join.POINT) for bucket, parts in found.items()}
    assert sorted(row[:3] for own in points.values() for row in own.tolist()) == sorted(expected)
    for bucket, own in points.items():
        assert set((words.mixed(own["shingle"]) % np.uint64(8)).tolist()) == {bucket}
