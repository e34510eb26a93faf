"""What the Arrow tasks of the pipeline hold at a time."""

import tracemalloc

import numpy as np
import pyarrow as pa

from parcelspark.llm import _blocks as B
from parcelspark.llm import _text as T


def _peak_mb(fn) -> float:
    tracemalloc.start()
    try:
        fn()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_hashing_spans_holds_a_bounded_share_of_the_text():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 4_000_000).astype(np.uint8)
    cut = np.unique(rng.integers(0, len(data), 50_000))
    start, end = cut[:-1], cut[1:]
    assert _peak_mb(lambda: T.span_hashes(data, start, end)) < 40
    got = T.span_hashes(data, start, end)
    some = range(0, len(start), 997)
    assert [int(got[i]) for i in some] == [int(T.span_hashes(data, start[i : i + 1], end[i : i + 1])[0]) for i in some]


def test_spans_longer_than_a_step_and_no_spans():
    data = np.arange(3 * T.HASH_BYTES, dtype=np.int64).astype(np.uint8)
    start, end = np.array([0, 5, 2 * T.HASH_BYTES]), np.array([5, 2 * T.HASH_BYTES, 2 * T.HASH_BYTES + 7])
    got = T.span_hashes(data, start, end)
    assert [int(x) for x in got] == [int(T.span_hashes(data[a:b], np.array([0]), np.array([b - a]))[0]) for a, b in zip(start, end, strict=True)]
    assert not len(T.span_hashes(data, start[:0], end[:0]))


def test_functions_of_batches_give_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(B, "give_back", lambda: given.append(1))
    batches = [pa.record_batch({"n": [i]}) for i in range(3)]
    out = list(B.tidy_batches(lambda bs: (b for b in bs))(iter(batches)))
    assert out == batches and len(given) == 4
