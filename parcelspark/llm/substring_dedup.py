"""Substring dedup by relative Lempel-Ziv parsing.

Documents lie in hashed blocks; the reference of a document is every document with
a smaller id.  A reference block is indexed by its word windows under *anchors*:
the least hash of the k-word grams in a window, so equal windows have equal
anchors.

1. Blocks send their distinct anchors; buckets answer which occur in two documents
   or more.  All other windows are new.
2. Blocks send each distinct window under a shared anchor once, with its first
   place (document, word).  Buckets keep the first place in the corpus: the index
   of all reference blocks.
3. Each block factors its documents against that index: a factor starts at a
   window found in an earlier document and is extended greedily while the next
   word continues the same reference; windows that straddle the end of a factor
   are looked up as well.  Factors have at least ``window`` words; their words go.

A key reaches its bucket at most once from each block, so a passage that a third
of all documents share makes no hot task.

A null text has no words.  A null id ranks after all others; documents with the
same id do not serve each other as reference.  Ties go to the first word position.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parcelspark.llm import _blocks as B
from parcelspark.llm import _text as T

WINDOW = 13
GRAM = 4
FACTOR = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))
ASK1 = "bucket int, block int, keys binary, many binary"
ANSWER1 = "block int, bucket int, bits binary"
ASK2 = "bucket int, block int, keys binary, docs binary, places binary"
ANSWER2 = "block int, keys binary, docs binary, places binary"


class Block:
    """The windows of a block of documents."""

    def __init__(self, table: pa.Table, window: int, spans: bool = False):
        self.ids = T.ids_of(table.column("doc_id"))
        self.words = T.Words(table.column("text"), T.SPACE_LUT, spans=spans)
        gram = min(GRAM, window)
        least = T.sliding_min(self.words.grams(gram), window - gram + 1)
        self.at = np.flatnonzero(self.words.whole(window))  # first word of each window
        self.anchor = least[self.at]
        self.key = self.words.grams(window, seed=11)[self.at]
        doc = self.words.doc[self.at]
        self.doc = self.ids[doc]
        self.place = (self.at - self.words.first[doc]).astype(np.int32)


def _block_no(table: pa.Table) -> int:
    return table.column("block")[0].as_py()


def _bucket(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> T.U(20)) % T.U(buckets)).astype(np.int64)


def _distinct_anchors(b: Block) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(b.anchor, kind="stable")
    keys, head = np.unique(b.anchor[order], return_index=True)
    if not len(keys):
        return keys, np.zeros(0, bool)
    doc = b.doc[order]
    return keys, np.minimum.reduceat(doc, head) != np.maximum.reduceat(doc, head)


def _ask_anchors(window: int, buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("many", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        keys, many = _distinct_anchors(Block(table, window))
        no = _block_no(table)
        return B.rows(schema, [{"bucket": b, "block": no, **x} for b, x in B.pack({"keys": keys, "many": many.astype(np.uint8)}, _bucket(keys, buckets), buckets)])

    return run


def _answer_anchors(table: pa.Table) -> pa.Table:
    keys, many = B.column(table, "keys", T.U), B.column(table, "many", np.uint8)
    size = np.cumsum([0, *(len(k) for k in keys)])
    _, which, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    n = n + np.bincount(which, np.concatenate(many), len(n))
    shared = (n > 1)[which]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array([np.packbits(shared[a:b]).tobytes() for a, b in zip(size, size[1:], strict=False)], pa.binary())})


def first_places(key: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Index of the first (document, place) of each distinct key, in key order."""
    order = np.lexsort((place, doc, key))
    new = np.ones(len(order), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    return order[new]


def _ask_windows(window: int, buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("places", pa.binary())])

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        b = Block(table, window)
        keys, _ = _distinct_anchors(b)
        bucket = _bucket(keys, buckets)
        shared = np.zeros(len(keys), bool)
        for n, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True):
            at = np.flatnonzero(bucket == n)
            shared[at] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(at)).astype(bool)
        ask = np.flatnonzero(T.in_sorted(b.anchor, keys[shared]) >= 0)
        ask = ask[first_places(b.key[ask], b.doc[ask], b.place[ask])]
        no = _block_no(table)
        return B.rows(schema, [{"bucket": n, "block": no, **x} for n, x in B.pack({"keys": b.key[ask], "docs": b.doc[ask], "places": b.place[ask]}, _bucket(b.anchor[ask], buckets), buckets)])

    return run


def _answer_windows(table: pa.Table) -> pa.Table:
    """First places in the corpus, for the blocks whose own first place is a later document."""
    parts = [B.column(table, n, t) for n, t in (("keys", T.U), ("docs", np.int64), ("places", np.int32))]
    size = np.cumsum([0, *(len(k) for k in parts[0])])
    key, doc, place = (np.concatenate(p) for p in parts)
    first = first_places(key, doc, place)
    first = first[np.searchsorted(key[first], key)]
    earlier = doc[first] < doc
    out = {"block": [], "keys": [], "docs": [], "places": []}
    for no, a, b in zip(table.column("block").to_pylist(), size, size[1:], strict=False):
        at = np.arange(a, b)[earlier[a:b]]
        if len(at):
            ref = first[at]
            order = np.lexsort((place[ref], doc[ref]))  # runs of one reference compress
            out["block"].append(no)
            out["keys"].append(key[at][order].tobytes())
            out["docs"].append(doc[ref][order].tobytes())
            out["places"].append(place[ref][order].tobytes())
    return pa.table({"block": pa.array(out["block"], pa.int32()), **{n: pa.array(out[n], pa.binary()) for n in ("keys", "docs", "places")}})


def parse_factors(b: Block, key: np.ndarray, ref_doc: np.ndarray, ref_place: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Greedy factors of every document of a block against the index of earlier documents.

    ``key, ref_doc, ref_place`` hold what other blocks have first; windows whose
    first document is in this block are found here.
    """
    doc, place = np.full(len(b.key), T.NO_DOC), np.zeros(len(b.key), np.int32)
    if len(b.key):
        first = first_places(b.key, b.doc, b.place)
        first = first[np.searchsorted(b.key[first], b.key)]
        doc, place = b.doc[first], b.place[first]
        order = np.argsort(key, kind="stable")
        at = T.in_sorted(b.key, key[order])
        got = at >= 0
        doc[got], place[got] = ref_doc[order][at[got]], ref_place[order][at[got]]
    hit = np.flatnonzero(doc < b.doc)
    new = np.ones(len(hit), bool)
    new[1:] = (b.at[hit][1:] != b.at[hit][:-1] + 1) | (doc[hit][1:] != doc[hit][:-1]) | (place[hit][1:] != place[hit][:-1] + 1) | (b.words.doc[b.at[hit]][1:] != b.words.doc[b.at[hit]][:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(hit)) - 1 if len(head) else head
    return {"at": b.at[hit[head]], "length": (b.at[hit[tail]] - b.at[hit[head]] + window), "ref_doc": doc[hit[head]], "ref_start": place[hit[head]]}


def kept_texts(words: T.Words, keep: np.ndarray) -> pa.Array:
    """Each document's kept words joined by one space."""
    size = words.end - words.start
    base = np.cumsum(size) - size
    pos = np.arange(int(size.sum())) + np.repeat(words.start - base, size)
    pos = pos[np.repeat(keep, size)]
    out = np.full(len(pos) + int(keep.sum()), 0x20, np.uint8)
    ends = np.cumsum(size[keep] + 1) - 1
    body = np.ones(len(out), bool)
    body[ends] = False
    out[body] = words.data[pos]
    per_doc = np.bincount(words.doc[keep], size[keep] + 1, words.n_docs).astype(np.int64)
    off = np.concatenate([[0], np.cumsum(per_doc)])
    text = out.tobytes()
    return pa.array([text[a : max(a, b - 1)].decode("utf-8", "replace") for a, b in zip(off, off[1:], strict=False)], pa.string())


def _parse(window: int, columns: list[str], keep_text: bool):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        b = Block(table, window, spans=True)
        got = [np.concatenate(x) if (x := B.column(answers, n, t)) else np.zeros(0, t) for n, t in (("keys", T.U), ("docs", np.int64), ("places", np.int32))]
        f = parse_factors(b, *got, window)
        gone = np.zeros(len(b.words.hash) + 1, np.int64)
        np.add.at(gone, f["at"], 1)
        np.add.at(gone, f["at"] + f["length"], -1)
        gone = np.cumsum(gone[:-1]) > 0
        doc = b.words.doc[f["at"]]
        edge = np.searchsorted(doc, np.arange(b.words.n_docs + 1)).astype(np.int32)
        parts = pa.StructArray.from_arrays([pa.array((f["at"] - b.words.first[doc]).astype(np.int32)), pa.array(f["length"].astype(np.int32)), pa.array(f["ref_doc"]), pa.array(f["ref_start"])], names=["start", "length", "ref_doc", "ref_start"])
        cols = {
            "doc_id": table.column("doc_id"), "n_words": pa.array(b.words.count, pa.int64()),
            "n_removed": pa.array(np.bincount(b.words.doc[gone], minlength=b.words.n_docs).astype(np.int64)),
            "factors": pa.ListArray.from_arrays(pa.array(edge), parts), "text": kept_texts(b.words, ~gone),
        }
        if "row" in columns:
            cols["row"] = table.column("row")
        if keep_text:
            cols["original"] = table.column("text")
        return pa.table(cols)

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, keep_text: bool = False, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, factors, text`` (the kept words), ``row`` when ``carry``, ``original`` (the text as it was) when ``keep_text``."""
    blocks = B.n_blocks(docs, text_col, block_bytes)
    dealt = B.blocked(docs, blocks, id_col, text_col, carry)
    own = dealt.groupBy("block")
    anchors = own.applyInArrow(B.tidy(_ask_anchors(window, blocks)), ASK1)
    shared = B.per_bucket(anchors, _answer_anchors, ANSWER1)
    windows = own.cogroup(shared.groupBy("block")).applyInArrow(B.tidy(_ask_windows(window, blocks)), ASK2)
    first = B.per_bucket(windows, _answer_windows, ANSWER2)
    schema = "doc_id long, n_words long, n_removed long, factors array<struct<start:int,length:int,ref_doc:long,ref_start:int>>, text string"
    if carry:
        schema += f", row {dealt.schema['row'].dataType.simpleString()}"
    if keep_text:
        schema += ", original string"
    return own.cogroup(first.groupBy("block")).applyInArrow(B.tidy(_parse(window, dealt.columns, keep_text)), schema)
