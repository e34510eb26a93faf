"""Whole-array word and byte work on Arrow string columns (used inside Spark tasks).

Texts of a batch are one byte buffer with document offsets.  Words, word hashes,
windows and local minima are computed over the buffer at once, never word by
word.  Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
NO_DOC = np.int64(2**63 - 1)  # rank of a null doc_id: after every real id

# Fixed byte classes: words are runs of bytes outside the listed ranges.
SPACE_LUT = np.ones(256, bool)
SPACE_LUT[[0x20, *range(0x09, 0x0E)]] = False  # [^\x20\x09-\x0D]+
ALNUM_LUT = np.ones(256, bool)
ALNUM_LUT[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32  # A-Z


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, so that all bits of a key are usable."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(n, dtype=U) + U(1)) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


def buffer_of(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; offset i and i+1 bound text i."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def ids_of(col) -> np.ndarray:
    """int64 doc ids; a null id becomes NO_DOC."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.int64()), int(NO_DOC)).to_numpy(zero_copy_only=False)


def slices(off: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Document ranges of at most ``most`` bytes (one document at least)."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, side="right")) - 1)
        yield a, b
        a = b


def word_spans(data: np.ndarray, off: np.ndarray, lut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of all words."""
    return mask_spans(lut[data], off)


def mask_spans(m: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of all runs of marked bytes."""
    n = len(m)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    first = m.copy()
    first[1:] &= ~m[:-1]
    at = off[:-1][off[:-1] < n]
    first[at] = m[at]
    last = m.copy()
    last[:-1] &= ~m[1:]
    at = off[1:][off[1:] > 0] - 1
    last[at] = m[at]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(start, off)))


PLACES = 32
HASH_BYTES = 256 << 10  # hashed at a time: the arrays of one step take some fifty times as much


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hash of each (non-empty, ordered, disjoint) byte span."""
    out = np.zeros(len(start), U)
    for a, b in slices(np.concatenate([[0], np.cumsum(end - start)]), HASH_BYTES):
        out[a:b] = _span_hashes(data, start[a:b], end[a:b], seed)
    return out


def _span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    size = end - start
    table, by = multipliers(256, seed * 7919), multipliers(int(size.max()), seed * 104729)
    # bytes at the same place of all spans at once, longest spans first, as far as these are many
    order = np.argsort(-np.minimum(size, PLACES).astype(np.int8), kind="stable")
    left = len(size) - np.cumsum(np.bincount(np.minimum(size, PLACES), minlength=PLACES + 1))  # spans of more than k bytes, up to PLACES
    at, sums = start[order], np.zeros(len(size), U)
    with np.errstate(over="ignore"):
        for k in range(PLACES):
            m = int(left[k])
            if not m:
                break
            sums[:m] += table[data[at[:m] + k]] * by[k]
        long = np.flatnonzero(size[order] > PLACES)
        if len(long):
            more = size[order[long]] - PLACES
            base = np.cumsum(more) - more
            rel = np.arange(int(more.sum()), dtype=np.int64) - np.repeat(base, more) + PLACES
            pos = rel + np.repeat(at[long], more)
            sums[long] += np.add.reduceat(table[data[pos]] * by[rel], base)
        out = np.empty(len(size), U)
        out[order] = sums
        return mix(out + size.astype(U) * U(0x9E3779B97F4A7C15))


def lower(data: np.ndarray) -> np.ndarray:
    return LOWER[data]


class Words:
    """All words of a batch of texts: hash, document, and word offsets per document."""

    def __init__(self, col, lut: np.ndarray = SPACE_LUT, lowercase: bool = False, spans: bool = False, step: int = 2 << 20):
        data, off = buffer_of(col)
        hashes, docs, starts, ends = [], [], [], []
        for a, b in slices(off, step):
            part, o = data[off[a] : off[b]], off[a : b + 1] - off[a]
            part = lower(part) if lowercase else part
            s, e, d = word_spans(part, o, lut)
            hashes.append(span_hashes(part, s, e))
            docs.append((d + a).astype(np.int32))
            if spans:
                starts.append(s + off[a])
                ends.append(e + off[a])
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.data, self.off, self.n_docs = data, off, len(off) - 1
        self.hash, self.doc = join(hashes, U), join(docs, np.int32)
        self.start, self.end = join(starts, np.int64), join(ends, np.int64)
        self.count = np.bincount(self.doc, minlength=self.n_docs).astype(np.int64)
        self.first = np.cumsum(self.count) - self.count  # number of a document's first word

    def grams(self, k: int, seed: int = 3) -> np.ndarray:
        """Hash of the k words from each word on (meaningless where fewer are left in the document)."""
        return gram_hashes(self.hash, k, seed)

    def whole(self, k: int) -> np.ndarray:
        """Whether k words of one document start at each word."""
        ok = np.zeros(len(self.doc), bool)
        if k <= len(ok):
            ok[: len(ok) - k + 1] = self.doc[: len(ok) - k + 1] == self.doc[k - 1 :]
        return ok


def gram_hashes(h: np.ndarray, k: int, seed: int = 3) -> np.ndarray:
    out = np.zeros(len(h), U)
    by = multipliers(k, seed)
    with np.errstate(over="ignore"):
        for t in range(k):
            out[: len(h) - t] += h[t:] * by[t]
        return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i+w]) for each i (shorter at the end)."""
    out, have = x.copy(), 1
    while have < w:
        step = min(have, w - have)
        out[:-step] = np.minimum(out[:-step], out[step:]) if step < len(out) else out[:-step]
        have += step
    return out


def sliding_max_back(x: np.ndarray, w: int) -> np.ndarray:
    """max(x[i-w+1:i+1]) for each i (shorter at the start)."""
    out, have = x.copy(), 1
    while have < w:
        step = min(have, w - have)
        if step < len(out):
            out[step:] = np.maximum(out[step:], out[:-step].copy())
        have += step
    return out


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n positions lie in [s, s + length) of any start (ends beyond n are cut)."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, n), -1)
    return np.cumsum(edge[:-1]) > 0


def in_sorted(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each value in the sorted keys, -1 where absent."""
    if not len(keys):
        return np.full(len(values), -1, np.int64)
    at = np.searchsorted(keys, values)
    at[at == len(keys)] = 0
    return np.where(keys[at] == values, at, -1)
