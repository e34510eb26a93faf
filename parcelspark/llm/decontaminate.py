"""Benchmark decontamination by suffix arrays over training shards.

Each task turns its share of the documents into shards of a few megabytes and
builds, per shard, a suffix array of the word positions that can start a match
(positions whose first words also start some benchmark window; no other position
can be found).  Every benchmark suffix is binary-searched in every shard, cut to
``window`` words; neighbouring hits on one diagonal are joined to the longest
verbatim matches with their locations.

The benchmark is the stated query set.  It is broadcast in blocks of at most
``block_bytes`` text, checked; a larger benchmark takes more passes over the rows
of the same task, without a shuffle.

Null or word-less texts and items match nothing.  Repeated document rows are
judged one by one; benchmark rows with the same item_id are one item; a null
item_id is written ``null``.  Empty tables give empty or clean results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm import _text as T
from parcelspark.llm._blocks import tidy_batches

WINDOW = 13
BLOCK_BYTES = 2 << 20
SHARD_BYTES = 4 << 20
MATCH = "array<struct<item_id:string,item_start:int,doc_start:int,length:int>>"


def _suffixes(words: T.Words, at: np.ndarray, length: np.ndarray, window: int) -> np.ndarray:
    """The next ``length`` word hashes of each position as one byte string that sorts like the word sequence."""
    out = np.zeros((len(at), window), ">u8")
    n = len(words.hash)
    for t in range(window):
        ok = (t < length) & (at + t < n)
        ok[ok] = words.doc[at[ok] + t] == words.doc[at[ok]]
        out[ok, t] = words.hash[at[ok] + t]
    return np.ascontiguousarray(out).view(f"S{window * 8}").ravel() if len(at) else np.zeros(0, f"S{window * 8}")


def build_index(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> dict | None:
    """Distinct benchmark windows in suffix order, who holds them, and the words that start them."""
    words = T.Words(pa.array([t for _, t in items], pa.string()), T.ALNUM_LUT, lowercase=True)
    short = (words.count > 0) & (words.count < window)
    at = np.concatenate([np.flatnonzero(words.whole(window)), words.first[short]]).astype(np.int64)
    if not len(at):
        return None
    length = np.concatenate([np.full(len(at) - int(short.sum()), window), words.count[short]]).astype(np.int64)
    start = int(min(3, length.min()))
    keys, which = np.unique(_suffixes(words, at, length, window), return_inverse=True)
    order = np.argsort(which, kind="stable")
    size = np.zeros(len(keys), np.int64)
    size[which] = length
    return {
        "window": window, "keys": keys, "length": size, "start": start,
        "grams": np.unique(words.grams(start)[at]),
        "edge": np.searchsorted(which[order], np.arange(len(keys) + 1)),
        "item": words.doc[at][order].astype(np.int64), "pos": (at - words.first[words.doc[at]])[order],
        "ids": ["null" if i is None else str(i) for i, _ in items],
    }


def search_shard(col, index: dict | None) -> tuple[T.Words, np.ndarray, dict[str, np.ndarray]]:
    """Words of a shard, which of them are hit, and the longest matches as parallel arrays."""
    words = T.Words(col, T.ALNUM_LUT, lowercase=True)
    none = {k: np.zeros(0, np.int64) for k in ("doc", "item", "doc_start", "item_start", "length")}
    if index is None:
        return words, np.zeros(len(words.hash), bool), none
    q, window = index["start"], index["window"]
    can = np.flatnonzero(words.whole(q) & (T.in_sorted(words.grams(q), index["grams"]) >= 0))
    if not len(can):
        return words, np.zeros(len(words.hash), bool), none
    text = _suffixes(words, can, np.full(len(can), window), window)
    order = np.argsort(text, kind="stable")
    array, sorted_text = can[order], text[order]
    lo = np.searchsorted(sorted_text, index["keys"], "left")
    raw = np.zeros((len(index["keys"]), window), ">u8")
    raw[:] = index["keys"].view(">u8").reshape(-1, window)
    raw[np.arange(window)[None, :] >= index["length"][:, None]] = 2**64 - 1  # the end of the range that starts with a shorter window
    hi = np.searchsorted(sorted_text, raw.view(f"S{window * 8}").ravel(), "right")
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return words, np.zeros(len(words.hash), bool), none
    n = (hi - lo)[found]
    key = np.repeat(found, n)
    at = array[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[found], n)]
    edge = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + index["length"][key], -1)
    hit = np.cumsum(edge[:-1]) > 0
    # every holder of a found window, then maximal runs along one diagonal of (item, document)
    k = np.diff(index["edge"])[key]
    own = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k) + np.repeat(index["edge"][key], k)
    at, size = np.repeat(at, k), np.repeat(index["length"][key], k)
    item, ipos = index["item"][own], index["pos"][own]
    order = np.lexsort((at, at - ipos, item))
    at, size, item, ipos = at[order], size[order], item[order], ipos[order]
    doc = words.doc[at].astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1) | (ipos[1:] != ipos[:-1] + 1) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    return words, hit, {"doc": doc[head], "item": item[head], "doc_start": at[head] - words.first[doc[head]], "item_start": ipos[head], "length": at[tail] - at[head] + size[tail]}


def _pass(index: dict | None, names: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, off = T.buffer_of(batch.column(names.index("text")))
            for a, b in T.slices(off, SHARD_BYTES):
                part = batch.slice(a, b - a)
                words, hit, m = search_shard(part.column(names.index("text")), index)
                cols = {n: part.column(i) for i, n in enumerate(names)}
                before = cols["hits"].to_pylist()
                hits = [list(x or []) for x in before]
                items = [set(x or []) for x in cols["items"].to_pylist()]
                matches = [list(x or []) for x in cols["matches"].to_pylist()]
                at = np.flatnonzero(hit)
                for d in np.unique(words.doc[at]):
                    mine = at[words.doc[at] == d] - words.first[d]
                    hits[d] = np.union1d(np.array(hits[d], np.int64), mine).tolist()
                for d, i, ds, s, n in zip(*(m[k].tolist() for k in ("doc", "item", "doc_start", "item_start", "length")), strict=True):
                    items[d].add(index["ids"][i])
                    matches[d].append({"item_id": index["ids"][i], "item_start": s, "doc_start": ds, "length": n})
                cols |= {"n_words": pa.array(words.count, pa.int64()), "hits": pa.array(hits, schema.field("hits").type), "items": pa.array([sorted(x) for x in items], schema.field("items").type), "matches": pa.array(matches, schema.field("matches").type)}
                yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", carry: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items, matches, contaminated`` (and ``text, row`` when ``carry``).

    ``items`` are the distinct ids with a window in the document, sorted as
    strings; ``matches`` the longest verbatim matches (word positions);
    ``contaminated`` when at least one word in twenty is hit.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id_col).cast("string").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    blocks = int(max(1, -(-size // block_bytes)))
    cols = [F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    if carry:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"))
    out = docs.select(*cols, F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<int>)").alias("hits"), F.expr("cast(array() as array<string>)").alias("items"), F.expr(f"cast(array() as {MATCH})").alias("matches"))
    names, schema = out.columns, out.schema
    arrow = to_arrow_schema(schema)
    for g in range(blocks):
        share = items if blocks == 1 else items.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == g)
        index = build_index([(r["id"], r["text"]) for r in share.collect()], window)
        if index is not None or g + 1 == blocks:  # the last pass counts the words in any case
            out = out.mapInArrow(tidy_batches(_deferred(spark.sparkContext.broadcast(index), names, arrow)), schema)
    out = out.withColumn("n_hit", F.size("hits").cast("long"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).drop("hits", *([] if carry else ["text"]))


def _deferred(held, names: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pass(held.value, names, schema)(batches)

    return run
