"""Runs of repeated words, caught online by squares over dyadic blocks.

A run is a stretch of consecutive words with smallest period ``q`` that no neighbouring word
extends, at least ``exponent`` (4 or more) periods and ``min_words`` long.

A *catcher* stands on each completed block of ``b = 2**k`` words that starts at a multiple of
``b`` in its document, and looks for periods from ``b`` to ``2 b - 1``.  Each word appended behind
the block moves its comparison by one: the word at distance ``q`` from the block's start may open a
second copy of what follows that start.  A square is reported where the words from the start have
period ``q`` for three periods; the first block of a run of four periods lies in its first one, so
no run is missed.  A task replays the appends of all its documents together: at each distance all
catchers of a size move at once (a comparison of the words, then of fingerprints of the suffixes).

Squares whose period is a multiple of a smaller one are dropped (one fingerprint comparison for each
prime factor).  The others grow to both sides by comparing ever shorter suffixes and merge: all squares
of a run end in the same (start, period).  Each merged run is then compared word by word.  Words are
told apart by 64-bit hashes, and each document costs ``n log n`` comparisons.

A null or empty text has no words and no runs.  Rows are judged on their own, so repeated ids, null
ids and copies are no special case; a very long text is split nowhere and stays one row of one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.llm import _text as T
from parcelspark.llm.substring_dedup import kept_texts

EXPONENT = 4
MIN_WORDS = 6
STEP_BYTES = 4 << 20
PAIRS = 1 << 20  # comparisons made at once
RUN = "struct<start:long,length:long,period:long>"
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Fingerprints:
    """Fingerprints of all stretches of a sequence of 64-bit words (arithmetic modulo 2**64)."""

    def __init__(self, x: np.ndarray):
        with np.errstate(over="ignore"):
            self.power = np.concatenate([[T.U(1)], np.cumprod(np.full(len(x), T.U(0x9E3779B97F4A7C15)))])
            self.sums = np.concatenate([[T.U(0)], np.cumsum(T.mix(x) * self.power[:-1])])

    def same(self, i: np.ndarray, d: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from i equal the n words from i + d (d > 0)."""
        with np.errstate(over="ignore"):
            return (self.sums[i + n] - self.sums[i]) * self.power[d] == self.sums[i + d + n] - self.sums[i + d]


def prime_factors(most: int) -> np.ndarray:
    """The least prime factor of each number up to ``most``."""
    least = np.arange(most + 1)
    for p in range(2, int(most**0.5) + 1):
        if least[p] == p:
            part = least[p * p :: p]
            part[part == np.arange(p * p, most + 1, p)] = p
    return least


def catch_squares(x: np.ndarray, marks: Fingerprints, first: np.ndarray, count: np.ndarray, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Block starts and periods of which ``exponent - 1`` periods follow, for the catchers of all sizes.

    ``first`` and ``count`` are the first word and the number of words of each document."""
    starts, periods, b = [], [], 1
    need = exponent - 1
    while b * exponent <= count.max(initial=0):
        blocks = np.maximum(count // b - need + 1, 0)  # those with room for three periods
        doc = np.repeat(np.arange(len(count)), blocks)
        s = first[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * b
        end = (first + count)[doc]
        wide = max(1, min(b, PAIRS // max(len(s), 1)))
        for d0 in range(b, 2 * b, wide):
            d = np.arange(d0, min(d0 + wide, 2 * b))
            for at in range(0, len(s), PAIRS):
                o = s[at : at + PAIRS, None]
                room = o + need * d <= end[at : at + PAIRS, None]
                i, j = np.nonzero(room & (x[o] == x[np.where(room, o + d, 0)]))
                i, q = o[i, 0], d[j]
                keep = x[i + q] == x[i + 2 * q]
                i, q = i[keep], q[keep]
                keep = marks.same(i, q, (need - 1) * q)
                starts.append(i[keep])
                periods.append(q[keep])
        b *= 2
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(starts), join(periods)


def primitive(marks: Fingerprints, s: np.ndarray, q: np.ndarray, need: int) -> np.ndarray:
    """Whether the words from s, of period q over ``need`` periods, have no smaller period there."""
    least = prime_factors(int(q.max(initial=1)))
    ok, left = np.ones(len(s), bool), q.copy()
    while (at := np.flatnonzero(ok & (left > 1))).size:
        p = least[left[at]]
        e = q[at] // p
        ok[at] = ~marks.same(s[at], e, need * q[at] - e)
        left[at] //= p
    return ok


def merge_runs(x: np.ndarray, marks: Fingerprints, s: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (start, end, period) of the runs that the squares grow to between the bounds of their documents."""
    left, right = s.copy(), s + (need - 1) * q  # right: the first i whose word may differ from the one at i + q
    step = 1 << max(0, int((high - low).max(initial=1)).bit_length() - 1)
    while step:
        room = left - step >= low
        at = np.flatnonzero(room)
        left[at[marks.same(left[at] - step, q[at], np.full(len(at), step))]] -= step
        at = np.flatnonzero(right + q + step <= high)
        right[at[marks.same(right[at], q[at], np.full(len(at), step))]] += step
        step //= 2
    runs = np.unique(np.stack([left, right + q, q], axis=1), axis=0)
    return runs[:, 0], runs[:, 1], runs[:, 2]


def compared_runs(x: np.ndarray, exponent: int, least: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of one document by comparing every word at every distance."""
    found: dict[int, list[tuple[int, int]]] = {}
    for q in range(1, len(x) // exponent + 1):
        same = np.concatenate([[False], x[:-q] == x[q:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2].tolist(), (edge[1::2] + q).tolist(), strict=True):
            if b - a >= max(least, exponent * q) and not any(q % p == 0 and u <= a and b <= v for p, r in found.items() for u, v in r):
                found.setdefault(q, []).append((a, b))
    return [(a, b, q) for q, r in found.items() for a, b in r]


def find_runs(x: np.ndarray, first: np.ndarray, count: np.ndarray, exponent: int = EXPONENT, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end, period) of all runs, starts and ends as places in ``x``; by document, start and period."""
    marks, need = Fingerprints(x), exponent - 1
    s, q = catch_squares(x, marks, first, count, exponent)
    keep = primitive(marks, s, q, need)
    s, q = s[keep], q[keep]
    has = np.flatnonzero(count)
    doc_of = lambda places: has[np.searchsorted(first[has], places, side="right") - 1]
    doc = doc_of(s)
    start, end, q = merge_runs(x, marks, s, q, first[doc], (first + count)[doc], need)
    keep = end - start >= np.maximum(least, exponent * q)
    start, end, q = start[keep], end[keep], q[keep]
    doc = doc_of(start)
    # word by word: the run has its period and no neighbour extends it
    size = end - start - q
    i = np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)
    wrong = np.bincount(np.repeat(np.arange(len(size)), size), x[i] != x[i + np.repeat(q, size)], len(size)) > 0
    before, behind = start > first[doc], end < (first + count)[doc]
    wrong[before] |= x[start[before] - 1] == x[start[before] - 1 + q[before]]
    wrong[behind] |= x[end[behind]] == x[end[behind] - q[behind]]
    for d in np.unique(doc[wrong]):  # two stretches shared a fingerprint
        other = doc != d
        again = np.array(compared_runs(x[first[d] : first[d] + count[d]], exponent, least), np.int64).reshape(-1, 3)
        start, end, q = (np.concatenate([a[other], b]) for a, b in ((start, again[:, 0] + first[d]), (end, again[:, 1] + first[d]), (q, again[:, 2])))
        doc = np.concatenate([doc[other], np.full(len(again), d)])
    order = np.lexsort((q, start))
    return doc[order], start[order], end[order], q[order]


def _runs(exponent: int, least: int, columns: list[str]):
    def some(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = T.Words(batch.column("text"), T.SPACE_LUT, spans=True)
        doc, start, end, q = find_runs(words.hash, words.first, words.count, exponent, least)
        gone = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(gone, start + q, 1)
        np.add.at(gone, end, -1)
        keep = np.cumsum(gone[:-1]) == 0
        fields = [pa.array(start - words.first[doc]), pa.array(end - start), pa.array(q)]
        runs = pa.StructArray.from_arrays(fields, fields=list(RUN_TYPE))
        edge = np.searchsorted(doc, np.arange(words.n_docs + 1)).astype(np.int32)
        # the strongest: greatest length / period, then the smallest start, then the smallest period
        best = np.lexsort((q, start, -((end - start) / q), doc))
        head = np.full(words.n_docs, -1)
        head[doc[best][::-1]] = best[::-1]
        strongest = runs.take(pa.array(head, mask=head < 0))
        cols = {"n_words": pa.array(words.count), "runs": pa.ListArray.from_arrays(pa.array(edge), runs), "strongest": strongest, "collapsed": kept_texts(words, keep)}
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *cols.values()], names=[*columns, *cols])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in T.slices(T.buffer_of(batch.column("text"))[1], STEP_BYTES):
                yield some(batch.slice(a, b - a))

    return run


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, min_words: int = MIN_WORDS, id_col: str = "doc_id", text: Column | str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, runs`` (by start, then period), ``strongest`` and ``collapsed``, the words
    without those that a run holds behind its first period, joined by one space."""
    if exponent < 4:
        raise ValueError("catchers see runs of four periods or more")
    text = F.col(text) if isinstance(text, str) else text
    given = docs.select(F.col(id_col).alias("doc_id"), text.cast("string").alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string"
    return given.mapInArrow(_runs(exponent, min_words, ["doc_id"]), schema)
