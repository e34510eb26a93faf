"""N-gram Jaccard join: size-aware, heavy-light, exact.

A document's set holds the hashes of its distinct word shingles.  Documents with
equal sets form a class; only the class's least id goes on.

* *Small* sets (up to a boundary size) enumerate their subsets of the fixed size
  that a linked pair must share; equal subsets meet.
* *Large* sets deal their shingles into ``H + 1`` parts by hash, where ``H`` is the
  greatest symmetric difference that a linked pair of that size band can have, and
  scan the inverted list of each part's content: two linked sets agree on a
  whole part (pigeonhole).  At lower similarities one part of any ``H // 2 + 1`` differs
  in one shingle at most, and the lists are of three quarters of a part.  A quarter more parts
  than that are made, so that a set can leave out its poorest lists: each set has a level, the greatest that
  ``H // 2 + 1`` of its parts reach in any three of their quarters, and makes no list of fewer shingles (of two linked
  sets, the part that decides for the higher level is listed by both).  Empty and nearly empty
  lists would join sets that have nothing in common, and these groups would grow with the corpus.
  With whole parts, parts of at most two shingles select little; there the key is made of two such parts, or of the parities of all other part sizes, which
  must then differ in every part.
* The boundary is the size up to which enumerating costs less than scanning, from
  the histogram of small sizes.

Before that, blocks ask hash buckets which of their shingles occur in another set (by
24 bits of a hash, so a shingle may pass for shared, never the other way); a set
whose shared shingles cannot reach the threshold has no link and goes no further.

Lists give star edges (least id, member), not pairs; the groups they span contain
all linked pairs.  A group up to ``group_bytes`` is solved exactly in one task: its
sets are compared with one pivot after another, and members once reached are never
compared again.  Larger groups first lose the sets that share too few shingles with
any other of their group, and what stays is grouped anew by other parts; groups
that are still too large lie in chunks: every round compares pivots with
all chunks, until each member outside the largest component has been a pivot.

No words, or a null text: an empty set, linked with nothing.  Fewer words than the
shingle size: one shingle of all words.  Rows without an id link with nothing; rows
that share an id are joined through it.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm import _blocks as B
from parcelspark.llm import _text as T
from parcelspark.llm._components import components

SHINGLE, PERCENT = 3, 90
GROUP_BYTES = 48 << 20
STEP = 4 << 20
LARGEST_SMALL = 30
EXTRA_PARTS = 125  # parts for each 100 that the pigeonhole needs, where lists are of three quarters of a part
SETS = "doc_id long, n long, d1 long, d2 long"


def shingle_sets(col, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle hash) pairs, distinct per document, sorted by document and hash."""
    w = T.Words(col, T.SPACE_LUT, lowercase=True)
    docs, keys = [], []
    at = np.flatnonzero(w.whole(shingle))
    docs.append(w.doc[at])
    keys.append(w.grams(shingle)[at])
    for k in range(1, shingle):
        d = np.flatnonzero(w.count == k)
        docs.append(d)
        keys.append(w.grams(k, seed=31 + k)[w.first[d]])
    doc, key = np.concatenate(docs).astype(np.int64), np.concatenate(keys)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return doc[new], key[new]


def _sums(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, T.U)
    if len(doc):
        at, head = np.unique(doc, return_index=True)
        out[at] = np.add.reduceat(values, head)
    return out


def _set_digests(doc: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(_sums(doc, T.mix(key + T.U(s)), n).view(np.int64) for s in (0x51, 0xA7))


def _digests(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            doc, key = shingle_sets(part.column(1), shingle)
            d1, d2 = _set_digests(doc, key, part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.bincount(doc, minlength=part.num_rows).astype(np.int64)), pa.array(d1), pa.array(d2)], names=["doc_id", "n", "d1", "d2"])

    return run


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, text) in shares of a few megabytes."""
    for batch in batches:
        _, off = T.buffer_of(batch.column(1))
        for a, b in T.slices(off, STEP):
            yield batch.slice(a, b - a)


def overlap_needed(n: int, m: int, percent: int) -> int:
    """Least shared shingles of linked sets of sizes n and m."""
    return -(-percent * (n + m) // (100 + percent))


def largest_partner(n: int, percent: int) -> int:
    return 100 * n // percent


class Scheme:
    """Which keys a set of a given size has."""

    def __init__(self, boundary: int, largest: int, percent: int, seed: int = 0):
        self.boundary, self.largest, self.percent, self.seed = boundary, largest, percent, seed
        # one part for each difference holds (100 + percent) / 2 / (100 - percent) shingles on average; if that is few,
        # little more than half as many parts, of which one has one difference at most, and keys of three of a part's four quarters
        self.quarters = 100 + percent < 16 * (100 - percent)
        self.weak = 2
        self.starts = [boundary + 1]
        while self.starts[-1] <= largest:
            self.starts.append(max(self.starts[-1] + 1, largest_partner(self.starts[-1], percent) + 1))

    def band(self, n: int) -> int:
        return int(np.searchsorted(self.starts, n, side="right")) - 1

    def bound(self, band: int) -> int:
        m = self.starts[band + 1] - 1 if band + 1 < len(self.starts) else largest_partner(self.starts[band], self.percent)
        return difference_bound(m, self.percent)

    def needed(self, band: int) -> int:
        """Of so many parts of two linked sets, one at least differs in no more than one shingle."""
        return self.bound(band) // 2 + 1

    def parts(self, band: int) -> int:
        return -(-EXTRA_PARTS * self.needed(band) // 100) if self.quarters else self.bound(band) + 1

    def subset_sizes(self, n: int) -> list[int]:
        """Sizes of the subsets that a small set enumerates (its own size: the set itself)."""
        if n > self.boundary:
            return []
        low = -(-self.percent * n // 100)
        high = min(largest_partner(n, self.percent), self.boundary)
        return sorted({overlap_needed(n, m, self.percent) for m in range(low, high + 1) if overlap_needed(n, m, self.percent) <= min(n, m)})

    def bands(self, n: int) -> list[int]:
        """Own band of a large set, and bands where it can be the smaller partner."""
        high = min(largest_partner(n, self.percent), self.largest)
        own = [self.band(n)] if n > self.boundary else []
        return sorted({*own, *(self.band(m) for m in range(max(n, self.boundary + 1), high + 1))}) if high > self.boundary else own


def difference_bound(m: int, percent: int) -> int:
    """Greatest symmetric difference of linked sets whose larger has m shingles."""
    return (100 - percent) * 2 * m // (100 + percent)


def choose_boundary(sizes: dict[int, int], percent: int) -> int:
    """Largest set size for which enumerating subsets costs no more than scanning part lists."""
    best = 0
    for n in range(1, LARGEST_SMALL + 1):
        scheme = Scheme(n, n, percent)
        listed = sum(math.comb(n, n - c) for c in scheme.subset_sizes(n))
        parts = difference_bound(n, percent) + 1
        near = sum(v for m, v in sizes.items() if percent * n <= 100 * m and percent * m <= 100 * n)
        scanned = 2 * parts * (1 + near * 2.0 ** -(n / parts))  # postings, and the list each scans
        if listed <= scanned:
            best = n
    return best


@lru_cache(maxsize=64)
def _subsets(n: int, k: int) -> np.ndarray:
    return np.array(list(combinations(range(n), k)), np.int64).reshape(math.comb(n, k), k)


def signature_keys(doc: np.ndarray, key: np.ndarray, n_docs: int, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) pairs: linked sets share a key."""
    size = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(size) - size
    out_doc, out_key = [np.zeros(0, np.int64)], [np.zeros(0, T.U)]
    mixed = T.mix(key + T.U(0x33))
    with np.errstate(over="ignore"):
        for d in np.flatnonzero((size > 0) & (size <= scheme.boundary)):
            own = mixed[first[d] : first[d] + size[d]]
            whole, n = own.sum(dtype=T.U), int(size[d])
            for c in scheme.subset_sizes(n):
                gone = own[_subsets(n, n - c)].sum(axis=1, dtype=T.U)  # what a subset leaves out
                out_key.append(T.mix((whole - gone) ^ T.U(0xC0FFEE + c)))
                out_doc.append(np.full(len(gone), d))
        which: dict[int, list[int]] = {}
        for n in np.unique(size[size > 0]):
            for b in scheme.bands(int(n)):
                which.setdefault(b, []).append(int(n))
        for band, ns in which.items():
            parts = scheme.parts(band)
            mine = np.flatnonzero(np.isin(size, ns) & (size > 0))
            row = np.full(n_docs, -1)
            row[mine] = np.arange(len(mine))
            at = np.flatnonzero(row[doc] >= 0)
            part = (T.mix(key[at] ^ T.U(0x5EED + 2 * scheme.seed)) % T.U(parts)).astype(np.int64)
            cell = row[doc[at]] * parts + part
            if scheme.quarters:
                d, k = _quarter_keys(cell, mixed[at], key[at], len(mine), parts, band, scheme.needed(band), scheme.seed)
                out_doc.append(mine[d])
                out_key.append(k)
                continue
            order = np.argsort(cell, kind="stable")
            cells, head = np.unique(cell[order], return_index=True)
            count, digest = np.zeros(len(mine) * parts, np.int64), np.zeros(len(mine) * parts, T.U)
            count[cells] = np.diff(np.append(head, len(order)))
            digest[cells] = np.add.reduceat(mixed[at][order], head) if len(cells) else 0
            number = np.tile(np.arange(parts, dtype=np.int64), len(mine)).astype(T.U)
            content = T.mix(digest + T.mix(number + T.U(band * 1_000_003 + 1)))
            strong = count > scheme.weak
            out_doc.append(np.repeat(mine, parts)[strong])
            out_key.append(content[strong])
            # weak parts: with one more weak part, or with the parities of all other part sizes
            weak = np.flatnonzero(~strong)
            odd = (count % 2).reshape(len(mine), parts).astype(bool)
            for r, cs in _by_row(weak, parts):
                for c in cs:
                    rest = np.delete(odd[r], c % parts)
                    rest = rest if not len(rest) or not rest[0] else ~rest  # the complement has the same key
                    mark = T.span_hashes(np.packbits(rest), np.zeros(1, np.int64), np.array([(len(rest) + 7) // 8]))[0] if len(rest) else T.U(0)
                    out_doc.append(np.array([mine[r]]))
                    out_key.append(T.mix(content[c : c + 1] ^ mark ^ T.U(0xBEEF)))
                for a, b in combinations(cs, 2):
                    out_doc.append(np.array([mine[r]]))
                    out_key.append(T.mix(content[a : a + 1] * T.U(3) + content[b : b + 1]))
    return np.concatenate(out_doc).astype(np.int64), np.concatenate(out_key)


def _quarter_keys(cell: np.ndarray, mixed: np.ndarray, key: np.ndarray, rows: int, parts: int, band: int, needed: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for parts without one of their quarters (a single difference is in one of them), of as many shingles as the row's level asks."""
    fine = cell * 4 + (T.mix(key ^ T.U(0xFACE + 2 * seed)) % T.U(4)).astype(np.int64)
    order = np.argsort(fine, kind="stable")
    at, head = np.unique(fine[order], return_index=True)
    digest = np.zeros(rows * parts * 4, T.U)
    digest[at] = np.add.reduceat(mixed[order], head) if len(at) else 0
    digest = digest.reshape(-1, 4)
    rest = (digest.sum(axis=1, dtype=T.U)[:, None] - digest).ravel()
    count = np.bincount(fine, minlength=rows * parts * 4).reshape(-1, 4)
    held = count.sum(axis=1)[:, None] - count
    level = -np.partition(-held.min(axis=1).reshape(rows, parts), needed - 1, axis=1)[:, needed - 1]
    number = np.tile(np.arange(parts * 4, dtype=np.int64), rows).astype(T.U)
    row = np.repeat(np.arange(rows), parts * 4)
    listed = held.ravel() >= level[row]
    return row[listed], T.mix(rest + T.mix(number + T.U(band * 1_000_003 + 1)))[listed]


def _by_row(cells: np.ndarray, parts: int):
    rows = cells // parts
    at, head = np.unique(rows, return_index=True)
    for r, a, b in zip(at, head, np.append(head[1:], len(cells)), strict=False):
        yield int(r), [int(c) for c in cells[a:b]]


def _packed_keys(doc: np.ndarray, key: np.ndarray, ids: np.ndarray, scheme: Scheme, buckets: int) -> pa.RecordBatch:
    schema = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary())])
    doc, key = signature_keys(doc, key, len(ids), scheme)
    bucket = ((key >> T.U(13)) % T.U(buckets)).astype(np.int64)
    return pa.RecordBatch.from_pylist([{"bucket": b, **x} for b, x in B.pack({"keys": key, "docs": ids[doc]}, bucket, buckets)], schema=schema)


def _picked(table: pa.Table, ids: np.ndarray) -> pa.Table:
    """The rows of a block that stand for a class."""
    return table.take(pa.array(np.flatnonzero(T.in_sorted(T.ids_of(table.column("doc_id")), np.unique(ids)) >= 0)))


def _codes(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 24 bits of each shingle: enough to tell most apart, and taking two for one only keeps a set in."""
    return (((key >> T.U(40)) % T.U(buckets)).astype(np.int64) << 24) | (key & T.U(0xFFFFFF)).astype(np.int64)


def _ask_common(shingle: int, buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("codes", pa.binary()), ("many", pa.binary())])

    def run(table: pa.Table, picked: pa.Table) -> pa.Table:
        no = table.column("block")[0].as_py()
        _, key = shingle_sets(_picked(table, picked.column("doc_id").to_numpy()).column("text"), shingle)
        codes, n = np.unique(_codes(key, buckets), return_counts=True)
        low = np.ascontiguousarray((codes & 0xFFFFFF).astype("<u4")).view(np.uint8).reshape(-1, 4)[:, :3]
        return B.rows(schema, [{"bucket": b, "block": no, **x} for b, x in B.pack({"codes": low, "many": (n > 1).astype(np.uint8)}, codes >> 24, buckets)])

    return run


def _answer_common(table: pa.Table) -> pa.Table:
    raw = [np.frombuffer(x.as_py(), np.uint8).reshape(-1, 3).astype(np.int64) @ np.array([1, 256, 65536]) for x in table.column("codes")]
    edge = np.cumsum([0, *(len(x) for x in raw)])
    _, which, n = np.unique(np.concatenate(raw), return_inverse=True, return_counts=True)
    n = n + np.bincount(which, np.concatenate(B.column(table, "many", np.uint8)), len(n))
    shared = (n > 1)[which]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array([np.packbits(shared[a:b]).tobytes() for a, b in zip(edge, edge[1:], strict=False)], pa.binary())})


def _linkable(shingle: int, percent: int, buckets: int):
    """Sets of a block of which enough shingles may occur in another set."""
    schema = pa.schema([("doc_id", pa.int64()), ("keys", pa.binary())])

    def run(table: pa.Table, right: pa.Table) -> pa.Table:
        bits = right.filter(pc.is_valid(right.column("bits")))
        table = _picked(table, right.column("doc_id").drop_null().to_numpy())
        doc, key = shingle_sets(table.column("text"), shingle)
        code = _codes(key, buckets)
        codes = np.unique(code)
        shared = np.zeros(len(codes), bool)
        for b, x in zip(bits.column("bucket").to_pylist(), bits.column("bits").to_pylist(), strict=True):
            at = slice(*np.searchsorted(codes, [b << 24, (b + 1) << 24]))
            shared[at] = np.unpackbits(np.frombuffer(x, np.uint8), count=at.stop - at.start).astype(bool)
        n = table.num_rows
        size = np.bincount(doc, minlength=n)
        common = np.bincount(doc, shared[np.searchsorted(codes, code)], n)
        edge = np.cumsum(size) - size
        ids = T.ids_of(table.column("doc_id"))
        keep = np.flatnonzero((size > 0) & (100 * common >= percent * size))
        return pa.table({"doc_id": pa.array(ids[keep]), "keys": pa.array([key[edge[i] : edge[i] + size[i]].tobytes() for i in keep], pa.binary())}, schema=schema)

    return run


def _list_edges(table: pa.Table) -> pa.Table:
    """Each inverted list as a star around its least id."""
    key, doc = np.concatenate(B.column(table, "keys", T.U)), np.concatenate(B.column(table, "docs", np.int64))
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    _, head, which = np.unique(key, return_index=True, return_inverse=True)
    a = doc[head][which]
    pairs = np.unique(np.stack([a[a != doc], doc[a != doc]], axis=1), axis=0)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


class Postings:
    """Inverted index of some sets: a pivot's overlaps are counted over the lists of its own shingles."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(x) for x in sets], np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, T.U)
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], np.repeat(np.arange(len(sets)), self.size)[order]

    def linked(self, pivot: np.ndarray, percent: int) -> np.ndarray:
        """Which of the sets are linked with the pivot set."""
        lo, hi = np.searchsorted(self.flat, pivot, "left"), np.searchsorted(self.flat, pivot, "right")
        n = hi - lo
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        both = np.bincount(self.owner[at], minlength=len(self.size))
        return 100 * both >= percent * (len(pivot) + self.size - both)


def can_link(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Sets that hold enough shingles which occur in another set of the group, until no more drop out."""
    left = np.arange(len(sets))
    while len(left):
        size = np.array([len(sets[i]) for i in left])
        flat, owner = np.concatenate([sets[i] for i in left]), np.repeat(np.arange(len(left)), size)
        _, which, n = np.unique(flat, return_inverse=True, return_counts=True)
        shared = np.bincount(owner, n[which] > 1, len(left))
        ok = 100 * shared >= percent * size
        if ok.all():
            break
        left = left[ok]
    return left


def solve_group(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Component number of each set, by growing components from pivots over what no pivot has reached."""
    out = np.arange(len(sets))
    who = can_link(sets, percent)
    index, left = Postings([sets[i] for i in who]), np.ones(len(who), bool)
    for start in range(len(who)):
        if not left[start]:
            continue
        left[start] = False
        front = [start]
        while front and left.any():
            hit = np.flatnonzero(index.linked(sets[who[front.pop()]], percent) & left)
            left[hit] = False
            out[who[hit]] = who[start]
            front += hit.tolist()
    return out


def _solve(percent: int):
    def run(table: pa.Table) -> pa.Table:
        a, b = [], []
        grp, ids = table.column("grp").to_numpy(), table.column("doc_id").to_numpy()
        keys = B.column(table, "keys", T.U)
        order = np.lexsort((ids, grp))
        head = np.flatnonzero(np.append(True, grp[order][1:] != grp[order][:-1]))
        for s, e in zip(head, np.append(head[1:], len(order)), strict=True):
            own = order[s:e]
            part = solve_group([keys[i] for i in own], percent)
            _, first, which = np.unique(part, return_index=True, return_inverse=True)
            a.append(ids[own][first][which])
            b.append(ids[own])
        return pa.table({"a": pa.array(np.concatenate(a)), "b": pa.array(np.concatenate(b))})

    return run


def _against_pivots(percent: int):
    def run(table: pa.Table, pivots: pa.Table) -> pa.Table:
        ids, keys = table.column("doc_id").to_numpy(), B.column(table, "keys", T.U)
        index = Postings(keys)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, p in zip(pivots.column("doc_id").to_pylist(), B.column(pivots, "keys", T.U), strict=True):
            hit = ids[index.linked(p, percent)]
            a.append(np.full(len(hit), i))
            b.append(hit)
        return pa.table({"a": pa.array(np.concatenate(a)), "b": pa.array(np.concatenate(b))})

    return run


def _hot_groups(rows: DataFrame, sizes: DataFrame, percent: int, group_bytes: int, pivots: int = 64) -> DataFrame:
    """Links that span the components of groups too large for one task; ``rows(grp, doc_id, keys)``, ``sizes(grp, bytes)``."""
    spark = rows.sparkSession
    base = f"{B.checkpoint_dir(spark)}/hot-{uuid.uuid4().hex}"
    chunks = F.ceil(F.col("bytes") / F.lit(group_bytes)).cast("int")
    rows.join(sizes, "grp").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), chunks).cast("int")).drop("bytes").write.parquet(f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    schema = "a long, b long"
    found = spark.createDataFrame([], schema)
    done = spark.createDataFrame([], "doc_id long")
    step = 0
    while True:
        # components so far; members outside the largest of their group that were no pivot yet
        label = rows.select("grp", "doc_id").join(components(found).withColumnRenamed("node", "doc_id"), "doc_id", "left").select("grp", "doc_id", F.coalesce("component", "doc_id").alias("component"))
        label.write.parquet(f"{base}/label-{step}")
        label = spark.read.parquet(f"{base}/label-{step}")
        weight = label.groupBy("grp", "component").count()
        top = weight.groupBy("grp").agg(F.max_by("component", F.struct("count", "component")).alias("top"))
        rest = label.join(top, "grp").withColumn("out", F.col("component") != F.col("top")).join(done, "doc_id", "left_anti")
        open_groups = rest.where("out").select("grp").distinct()
        # the pivots of a round: from outside the largest component first, and some of its members, which gather the rest
        rank = F.pmod(F.xxhash64("doc_id", F.lit(step)), F.lit(1 << 30)) / float(1 << 30)
        share = rest.join(open_groups, "grp").groupBy("grp", "out").agg((F.lit(float(pivots * 2**step)) / F.count("*")).alias("share"))
        chosen = rest.join(share, ["grp", "out"]).where(rank < F.col("share")).select("grp", "doc_id")
        chosen.write.parquet(f"{base}/pivots-{step}")
        chosen = spark.read.parquet(f"{base}/pivots-{step}")
        if open_groups.isEmpty():
            break
        sets = spark.read.parquet(f"{base}/rows")  # read anew: columns of its own beside those of rows
        held = sets.join(chosen, ["grp", "doc_id"]).select("grp", "doc_id", "keys")
        copies = held.join(sets.select("grp", "chunk").distinct(), "grp")
        links = rows.groupBy("grp", "chunk").cogroup(copies.groupBy("grp", "chunk")).applyInArrow(B.tidy(_against_pivots(percent)), schema)
        links.where("a <> b").write.parquet(f"{base}/links-{step}")
        found = found.union(spark.read.parquet(f"{base}/links-{step}"))
        done = done.union(chosen.select("doc_id"))
        step += 1
    return found


def _as_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in range(0, batch.num_rows, 500):
            part = batch.slice(s, 500)
            blobs = [x.as_py() for x in part.column(2)]
            edge = np.cumsum([0, *(len(x) // 8 for x in blobs)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(pa.array(edge), pa.array(np.frombuffer(b"".join(blobs), np.int64)))], names=["grp", "doc_id", "shingles"])


def _ask_lists(scheme: Scheme, buckets: int):

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 1000):
                part = batch.slice(s, 1000)
                sets = B.column(part, "keys", T.U)
                doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
                yield _packed_keys(doc, np.concatenate(sets), T.ids_of(part.column("doc_id")), scheme, buckets)

    return run


def _split_large(rows: DataFrame, scheme: Scheme, percent: int, buckets: int) -> DataFrame:
    """Large groups without the sets that share too little with all others, grouped anew by other parts; ``grp, doc_id, keys``."""
    spark = rows.sparkSession
    base = f"{B.checkpoint_dir(spark)}/large-{uuid.uuid4().hex}"
    each = rows.mapInArrow(B.tidy_batches(_as_numbers), "grp long, doc_id long, shingles array<long>").select("grp", "doc_id", F.explode("shingles").alias("s"))
    common = each.groupBy("grp", "s").agg(F.count("*").alias("n")).where("n > 1").select("grp", "s")
    shared = each.join(common, ["grp", "s"]).groupBy("grp", "doc_id").agg(F.count("*").alias("shared"))
    kept = rows.join(shared, ["grp", "doc_id"]).where(100 * F.col("shared") >= percent * (F.octet_length("keys") / 8)).drop("shared")
    kept.write.parquet(f"{base}/kept")
    kept = spark.read.parquet(f"{base}/kept")
    lists = kept.mapInArrow(B.tidy_batches(_ask_lists(scheme, buckets)), "bucket int, keys binary, docs binary")
    again = components(B.per_bucket(lists, _list_edges, "a long, b long"))
    return kept.join(again, F.col("doc_id") == F.col("node")).select(F.col("component").alias("grp"), "doc_id", "keys")


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = B.BLOCK_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, class_id`` (least id with the same set), ``component_id``."""
    spark = docs.sparkSession
    base = f"{B.checkpoint_dir(spark)}/jaccard-{uuid.uuid4().hex}"
    blocks = B.n_blocks(docs, text_col, block_bytes)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts.mapInArrow(B.tidy_batches(_digests(shingle)), SETS).write.parquet(f"{base}/sets")
    sets = spark.read.parquet(f"{base}/sets")
    real = sets.where("n > 0 AND doc_id IS NOT NULL")
    classes = real.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("class_id"))
    small = {r["n"]: r["count"] for r in classes.where(F.col("n") <= 2 * LARGEST_SMALL).groupBy("n").count().collect()}
    largest = classes.agg(F.max("n").alias("n")).first()["n"] or 0
    boundary = choose_boundary(small, percent)
    # a linked set shares most of its shingles: sets that cannot are left out before any lists are made
    block_of = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(blocks)).cast("int").alias("block")
    picked = classes.select(F.col("class_id").alias("doc_id")).select("doc_id", block_of)
    own = B.blocked(docs, blocks, id_col, text_col).groupBy("block")
    asked = own.cogroup(picked.groupBy("block")).applyInArrow(B.tidy(_ask_common(shingle, blocks)), "bucket int, block int, codes binary, many binary")
    answers = B.per_bucket(asked, _answer_common, "block int, bucket int, bits binary")
    right = answers.unionByName(picked, allowMissingColumns=True)
    own.cogroup(right.groupBy("block")).applyInArrow(B.tidy(_linkable(shingle, percent, blocks)), "doc_id long, keys binary").write.parquet(f"{base}/linkable")
    B.release(spark)
    linkable = spark.read.parquet(f"{base}/linkable")
    lists = linkable.mapInArrow(B.tidy_batches(_ask_lists(Scheme(boundary, largest, percent), blocks)), "bucket int, keys binary, docs binary")
    groups = components(B.per_bucket(lists, _list_edges, "a long, b long"))
    groups.select(F.col("node").alias("doc_id"), F.col("component").alias("grp")).write.parquet(f"{base}/groups")
    B.release(spark)
    sent = linkable.join(spark.read.parquet(f"{base}/groups"), "doc_id").select("grp", "doc_id", "keys")
    sent.write.parquet(f"{base}/sent")
    sent = spark.read.parquet(f"{base}/sent")
    sizes = sent.groupBy("grp").agg(F.sum(F.octet_length("keys")).alias("bytes"))
    total = sizes.agg(F.sum("bytes").alias("n"), F.max("bytes").alias("most")).first()

    def within(rows: DataFrame, weights: DataFrame) -> DataFrame:
        light = rows.join(weights.where(F.col("bytes") <= group_bytes).select("grp"), "grp")
        shares = F.lit(4 * math.ceil(max(1, total["n"] or 0) / group_bytes))
        return light.withColumn("share", F.pmod(F.xxhash64("grp"), shares)).groupBy("share").applyInArrow(B.tidy(_solve(percent)), "a long, b long")

    links = within(sent, sizes)
    if (total["most"] or 0) > group_bytes:
        large = sent.join(sizes.where(F.col("bytes") > group_bytes).select("grp"), "grp")
        _split_large(large, Scheme(boundary, largest, percent, seed=1), percent, blocks).write.parquet(f"{base}/split")
        split = spark.read.parquet(f"{base}/split")
        weights = split.groupBy("grp").agg(F.sum(F.octet_length("keys")).alias("bytes"))
        links = links.union(within(split, weights))
        still = weights.where(F.col("bytes") > group_bytes)
        if not still.isEmpty():
            links = links.union(_hot_groups(split, still, percent, group_bytes))
    # rows that share an id but not a set are joined through the id
    named = real.join(classes, ["n", "d1", "d2"])
    repeated = named.groupBy("doc_id").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high")).where("low <> high").select("doc_id")
    through = named.join(repeated, "doc_id").select(F.col("class_id").alias("a"), F.col("doc_id").alias("b"))
    final = components(links.union(through))
    named = sets.join(classes, ["n", "d1", "d2"], "left").join(final.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
    known = F.col("doc_id").isNotNull()
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(known, F.coalesce("class_id", "doc_id")).alias("class_id"), F.when(known, F.coalesce("component", "class_id", "doc_id")).alias("component_id"))
