"""Exact substring dedup by sampled enhanced suffix arrays and their common-prefix interval trees.

Every window of ``window`` bytes has an anchor: the leftmost least hash of the
``GRAM``-byte strings in it.  Equal windows have equal anchors, so only suffixes
that start at anchors are sorted, about one in eighty-five.

1. Blocks send the hashes of their anchors; buckets answer which occur twice or more.
2. Blocks send, for each repeated anchor, the bytes of the windows that it anchors
   (equal neighbourhoods of a block once).  A bucket sorts the suffixes at its
   anchors, has the common prefixes of neighbours, and stack-scans them to the
   interval tree.  For each interval the members are ordered by what stands to their
   left: an interval whose members differ there is a maximal repeat group, and each
   member's longest left match with any other, joined to the common prefix, covers
   bytes when both together reach ``window``.
3. Blocks remove the covered bytes.

Anchors with more than ``hot`` occurrences (a passage in a third of all documents has
such ones at its edges) are not gathered: their windows are sent as 128-bit hashes,
each once from a block, dealt by the hash.

A null text is empty.  Matches never cross documents; rows are separate documents
even if they share an id.  Texts shorter than ``window`` keep all bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from parcelspark.llm import _blocks as B
from parcelspark.llm import _text as T

WINDOW = 200
GRAM = 32
HOT = 8192
STEP = 1 << 20
ASK1 = "bucket int, block int, keys binary, counts binary"
ANSWER1 = "block int, bucket int, shared binary, hot binary"
ASK2 = "bucket int, block int, keys binary, places binary, lefts binary, runs binary, bytes binary, hashes binary, starts binary, spans binary"
ASK2_TYPES = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), *[(n, pa.binary()) for n in ("keys", "places", "lefts", "runs", "bytes", "hashes", "starts", "spans")]])
ANSWER2 = "block int, spans binary"


def string_hashes(data: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each position on (fewer positions than bytes), by doubling."""
    by = T.multipliers(64, seed)
    part, have, out, done = T.multipliers(256, seed * 31 + 7)[data], 1, None, 0
    with np.errstate(over="ignore"):
        while True:
            if length & have:
                if out is None:
                    out = part.copy()
                else:
                    n = len(part) - done
                    out = out[:n] * by[32 + have.bit_length()] + part[done:]
                done += have
            if done == length:
                return T.mix(out)
            part = part[: len(part) - have] * by[have.bit_length()] + part[have:]
            have *= 2


def ordered(table: pa.Table) -> pa.Table:
    """A block's rows in an order that does not depend on the exchange."""
    return table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")])) if table.num_rows > 1 else table


class Anchors:
    """Runs of windows of a block with one anchor each: first window, last window, anchor position and hash."""

    def __init__(self, table: pa.Table, window: int):
        self.data, self.off = T.buffer_of(table.column("text"))
        n, gram = len(self.data), min(GRAM, window)
        width = window - gram + 1
        valid = np.zeros(n + 1, bool)
        for a, b in zip(self.off, self.off[1:], strict=False):
            if b - a >= window:
                valid[a : b - window + 1] = True
        first, last, at, key = [], [], [], []
        for s in range(0, n, STEP):
            e = min(n, s + STEP)
            if not valid[s:e].any():
                continue
            g = string_hashes(self.data[s : min(n, e + window)], gram, 5)
            val, pos, have = g, np.arange(len(g), dtype=np.int32), 1
            while have < width:  # leftmost least hash of ``width`` strings
                step = min(have, width - have)
                if len(val) <= step:
                    val, pos = val[:0], pos[:0]
                    break
                right = val[step:] < val[:-step]
                pos = np.where(right, pos[step:], pos[:-step])
                val = np.where(right, val[step:], val[:-step])
                have += step
            j = np.flatnonzero(valid[s:e][: len(pos)])
            p = pos[j]
            new = np.ones(len(j), bool)
            new[1:] = (j[1:] != j[:-1] + 1) | (p[1:] != p[:-1])
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(j)) - 1 if len(head) else head
            first.append(j[head] + s)
            last.append(j[tail] + s)
            at.append(p[head].astype(np.int64) + s)
            key.append(g[p[head]])
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.first, self.last, self.at, self.key = join(first, np.int64), join(last, np.int64), join(at, np.int64), join(key, T.U)
        # a run that a step boundary cut in two is one run
        if len(self.at):
            new = np.ones(len(self.at), bool)
            new[1:] = (self.at[1:] != self.at[:-1]) | (self.first[1:] != self.last[:-1] + 1)
            head = np.flatnonzero(new)
            self.last = self.last[np.append(head[1:], len(new)) - 1]
            self.first, self.at, self.key = self.first[head], self.at[head], self.key[head]


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> T.U(21)) % T.U(buckets)).astype(np.int64)


def _ask_anchors(window: int, buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        a = Anchors(ordered(table), window)
        keys, counts = np.unique(a.key, return_counts=True)
        no = table.column("block")[0].as_py()
        return B.rows(schema, [{"bucket": b, "block": no, **x} for b, x in B.pack({"keys": keys, "counts": counts.astype(np.int32)}, _bucket(keys, buckets), buckets)])

    return run


def _answer_anchors(hot: int):
    def run(table: pa.Table) -> pa.Table:
        keys, counts = B.column(table, "keys", T.U), B.column(table, "counts", np.int32)
        edge = np.cumsum([0, *(len(k) for k in keys)])
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(which, np.concatenate(counts))[which]
        bits = lambda x: pa.array([np.packbits(x[a:b]).tobytes() for a, b in zip(edge, edge[1:], strict=False)], pa.binary())
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "shared": bits((n > 1) & (n <= hot)), "hot": bits(n > hot)})

    return run


def _expand(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)


def _window_hashes(a: Anchors, at: np.ndarray, window: int) -> np.ndarray:
    """Two 64-bit hashes of the windows at the given sorted positions."""
    out = np.zeros((len(at), 2), T.U)
    for s in range(0, len(a.data), STEP):
        i, j = np.searchsorted(at, [s, s + STEP])
        if j > i:
            part = a.data[s : s + STEP + window]
            for c, seed in enumerate((17, 23)):
                out[i:j, c] = string_hashes(part, window, seed)[at[i:j] - s]
    return out


def _ask_neighbourhoods(window: int, buckets: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        a = Anchors(ordered(table), window)
        no = table.column("block")[0].as_py()
        keys = np.unique(a.key)
        bucket = _bucket(keys, buckets)
        marks = {n: np.zeros(len(keys), bool) for n in ("shared", "hot")}
        for r in answers.to_pylist():
            at = np.flatnonzero(bucket == r["bucket"])
            for n, m in marks.items():
                m[at] = np.unpackbits(np.frombuffer(r[n], np.uint8), count=len(at)).astype(bool)
        which = np.searchsorted(keys, a.key)
        found, local = [], []
        near = np.flatnonzero(marks["shared"][which]) if len(keys) else np.zeros(0, np.int64)
        if len(near):
            # both end windows cover the neighbourhood, so their hashes tell equal ones
            ends = _window_hashes(a, np.unique(np.concatenate([a.first[near], a.last[near]])), window)
            places = np.unique(np.concatenate([a.first[near], a.last[near]]))
            head, tail = (ends[np.searchsorted(places, x[near])] for x in (a.first, a.last))
            same = np.column_stack([head, tail, (a.at - a.first)[near].astype(T.U), (a.last - a.first)[near].astype(T.U)])
            _, rep, group, n = np.unique(same, axis=0, return_index=True, return_inverse=True, return_counts=True)
            twice = near[n[group.ravel()] > 1]
            local.append(np.column_stack([a.first[twice], a.last[twice] + window]))
            near = near[np.sort(rep)]
            run_size, key = a.last[near] - a.first[near], a.key[near]
            b = _bucket(key, buckets)
            order = np.argsort(b, kind="stable")
            near, run_size, key, b = near[order], run_size[order], key[order], b[order]
            edge = np.searchsorted(b, np.arange(buckets + 1))
            for n in np.flatnonzero(np.diff(edge)):
                s = slice(edge[n], edge[n + 1])
                text = a.data[_expand(a.first[near[s]], run_size[s] + window)]
                found.append({"bucket": int(n), "block": no, "keys": key[s].tobytes(), "places": a.first[near[s]].astype(np.int32).tobytes(), "lefts": (a.at - a.first)[near[s]].astype(np.int32).tobytes(), "runs": run_size[s].astype(np.int32).tobytes(), "bytes": text.tobytes(), "hashes": b"", "starts": b"", "spans": b""})
        hot = np.flatnonzero(marks["hot"][which]) if len(keys) else np.zeros(0, np.int64)
        if len(hot):
            at = _expand(a.first[hot], a.last[hot] - a.first[hot] + 1)
            h = _window_hashes(a, at, window)
            _, rep, group, n = np.unique(h, axis=0, return_index=True, return_inverse=True, return_counts=True)
            twice = at[n[group.ravel()] > 1]
            local.append(np.column_stack([twice, twice + window]))
            at, h = at[rep], h[rep]
            b = _bucket(h[:, 0], buckets)
            for n, x in B.pack({"hashes": h, "starts": at.astype(np.int32)}, b, buckets):
                found.append({"bucket": n, "block": no, **{k: b"" for k in ("keys", "places", "lefts", "runs", "bytes", "spans")}, **x})
        if local and len(spans := np.concatenate(local)):
            found.append({"bucket": no % buckets, "block": no, **{k: b"" for k in ("keys", "places", "lefts", "runs", "bytes", "hashes", "starts")}, "spans": _joined(spans).astype(np.int32).tobytes()})
        return B.rows(ASK2_TYPES, found)

    return run


def _joined(spans: np.ndarray) -> np.ndarray:
    """Overlapping or touching spans as one, sorted."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    head = np.flatnonzero(new)
    return np.column_stack([spans[head, 0], reach[np.append(head[1:], len(spans)) - 1]])


def lcp_intervals(lcp: np.ndarray) -> list[tuple[int, int, int]]:
    """The interval tree of sorted suffixes, deepest first: (common prefix, first, last); ``lcp[i]`` is that of suffixes i and i + 1."""
    out, stack = [], [(0, 0)]
    for i, depth in enumerate([*lcp.tolist(), 0]):
        left = i
        while stack[-1][0] > depth:
            top, left = stack.pop()
            out.append((top, left, i))
        if stack[-1][0] < depth:
            stack.append((depth, left))
    return out


class SuffixArray:
    """Suffixes at anchors, sorted, with the common prefixes of neighbours; the left contexts for comparisons."""

    def __init__(self, keys: np.ndarray, lefts: np.ndarray, runs: np.ndarray, text: np.ndarray, window: int):
        size = runs + window
        base = np.cumsum(size) - size
        self.left, self.right = lefts, size - lefts
        n, wide = len(keys), int(self.left.max()) if len(keys) else 0
        rows = np.zeros((n, 8 + window + 2), np.uint8)
        rows[:, :8] = keys.astype(">u8").view(np.uint8).reshape(n, 8)
        body = np.zeros((n, window), np.uint8)
        body[np.arange(window)[None, :] < self.right[:, None]] = text[_expand(base + lefts, self.right)]
        rows[:, 8 : 8 + window] = body
        rows[:, -2:] = self.right.astype(">u2").view(np.uint8).reshape(n, 2)
        self.before = np.zeros((n, wide + 2), np.uint8)  # nearest byte first
        mask = np.arange(wide)[None, :] < self.left[:, None]
        back = np.repeat(base + lefts - 1, self.left) - (np.arange(int(self.left.sum())) - np.repeat(np.cumsum(self.left) - self.left, self.left))
        self.before[:, :wide][mask] = text[back]
        self.before[:, wide:] = self.left.astype(">u2").view(np.uint8).reshape(n, 2)
        self.order = np.argsort(rows.view(f"S{rows.shape[1]}").ravel(), kind="stable")
        rows = rows[self.order]
        differ = rows[1:, : 8 + window] != rows[:-1, : 8 + window]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), 8 + window) - 8
        r = self.right[self.order]
        self.lcp = np.where(common < 0, 0, np.minimum(common, np.minimum(r[1:], r[:-1])))

    def left_common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        wide = self.before.shape[1] - 2
        differ = self.before[x, :wide] != self.before[y, :wide]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), wide) if wide else np.zeros(len(x), np.int64)
        return np.minimum(common, np.minimum(self.left[x], self.left[y]))

    def cover(self, window: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, np.ndarray]]]:
        """For each suffix the covered bytes as (suffix, from, to) around its anchor, and the maximal repeat groups (common prefix, common left, members)."""
        who, lo, hi, groups = [], [], [], []
        # groups of suffixes with one anchor; pairs, the common case, all at once
        edge = np.concatenate([[0], np.flatnonzero(self.lcp == 0) + 1, [len(self.order)]])
        size = np.diff(edge)
        p = edge[:-1][size == 2]
        x, y = self.order[p], self.order[p + 1] if len(p) else self.order[p]
        r, left = self.lcp[p], self.left_common(x, y)
        ok = r + left >= window
        for z in (x, y):
            who.append(z[ok])
            lo.append(left[ok])
            hi.append(r[ok])
        groups += [(int(a), int(b), np.array([c, d])) for a, b, c, d in zip(r[ok], left[ok], x[ok], y[ok], strict=True)]
        for a, b in zip(edge[:-1][size > 2], edge[1:][size > 2], strict=True):
            done = np.zeros(b - a, bool)
            for depth, i, j in lcp_intervals(self.lcp[a : b - 1]):
                if done[i : j + 1].all():
                    continue
                mine = self.order[a + i : a + j + 1]
                by_left = np.argsort(self.before[mine].view(f"S{self.before.shape[1]}").ravel(), kind="stable")
                common = self.left_common(mine[by_left[:-1]], mine[by_left[1:]])
                best = np.zeros(len(mine), np.int64)
                best[by_left] = np.maximum(np.append(common, 0), np.append(0, common))
                ok = best + depth >= window
                if ok.any():
                    who.append(mine[ok])
                    lo.append(best[ok])
                    hi.append(np.full(int(ok.sum()), depth))
                    done[i : j + 1] |= (best == self.left[mine]) & (depth == self.right[mine])
                    if common.min() + depth >= window and len(np.unique(self._byte_before(mine, int(common.min())))) > 1:
                        groups.append((depth, int(common.min()), mine))
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        return join(who), np.column_stack([join(lo), join(hi)]), groups

    def _byte_before(self, who: np.ndarray, common: int) -> np.ndarray:
        """What stands left of the members' common left context (-1: the end of the neighbourhood)."""
        wide = self.before.shape[1] - 2
        if common >= wide:
            return np.full(len(who), -1)
        return np.where(self.left[who] > common, self.before[who, common].astype(np.int64), -1 - np.arange(len(who)))


def _answer_neighbourhoods(window: int):
    def run(table: pa.Table) -> pa.Table:
        blocks = np.array(table.column("block").to_pylist())
        out: dict[int, list[np.ndarray]] = {}

        def add(block: np.ndarray, spans: np.ndarray) -> None:
            for b in np.unique(block):
                out.setdefault(int(b), []).append(spans[block == b])

        keys = B.column(table, "keys", T.U)
        if sum(map(len, keys)):
            owner = np.repeat(blocks, [len(k) for k in keys])
            key = np.concatenate(keys)
            place, left, size = (np.concatenate(B.column(table, n, np.int32)).astype(np.int64) for n in ("places", "lefts", "runs"))
            text = np.concatenate(B.column(table, "bytes", np.uint8))
            # equal neighbourhoods of different blocks: covered in full; one of them goes on
            base = np.cumsum(size + window) - (size + window)
            digest = [T.span_hashes(text, base, base + size + window, seed) for seed in (41, 43)]
            _, rep, group, n = np.unique(np.column_stack([key, *digest, left.astype(T.U), size.astype(T.U)]), axis=0, return_index=True, return_inverse=True, return_counts=True)
            same = n[group.ravel()] > 1
            add(owner[same], np.column_stack([place, place + size + window])[same])
            rep = np.sort(rep)
            sa = SuffixArray(key[rep], left[rep], size[rep], text[_expand(base[rep], size[rep] + window)], window)
            who, reach, _ = sa.cover(window)
            at = (place + left)[rep][who]
            add(owner[rep][who], np.column_stack([at - reach[:, 0], at + reach[:, 1]]))
        hashes = B.column(table, "hashes", T.U)
        if sum(map(len, hashes)):
            owner = np.repeat(blocks, [len(h) // 2 for h in hashes])
            _, group, n = np.unique(np.concatenate(hashes).reshape(-1, 2), axis=0, return_inverse=True, return_counts=True)
            start = np.concatenate(B.column(table, "starts", np.int32)).astype(np.int64)
            same = n[group.ravel()] > 1
            add(owner[same], np.column_stack([start, start + window])[same])
        for b, x in zip(blocks, B.column(table, "spans", np.int32), strict=True):
            if len(x):
                out.setdefault(int(b), []).append(x.reshape(-1, 2))
        return pa.table({"block": pa.array(list(out), pa.int32()), "spans": pa.array([_joined(np.concatenate(s)).astype(np.int32).tobytes() for s in out.values()], pa.binary())})

    return run


def _remove(columns: list[str]):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = ordered(table)
        data, off = T.buffer_of(table.column("text"))
        gone = np.zeros(len(data) + 1, bool)
        for x in B.column(answers, "spans", np.int32):
            for a, b in x.reshape(-1, 2):
                gone[a:b] = True
        docs = {"n_bytes": np.diff(off), "n_removed": [], "n_spans": [], "kept": []}
        for a, b in zip(off, off[1:], strict=False):
            g = gone[a:b]
            docs["n_removed"].append(int(g.sum()))
            docs["n_spans"].append(int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()))
            docs["kept"].append(data[a:b][~g].tobytes())
        cols = {"doc_id": table.column("doc_id"), "n_bytes": pa.array(docs["n_bytes"], pa.int64()), "n_removed": pa.array(docs["n_removed"], pa.int64()), "n_spans": pa.array(docs["n_spans"], pa.int64()), "kept": pa.array(docs["kept"], pa.binary())}
        if "row" in columns:
            cols["row"] = table.column("row")
        return pa.table(cols)

    return run


def suffix_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, block_bytes: int = B.BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (remaining bytes; and ``row`` when ``carry``)."""
    blocks = B.n_blocks(docs, text_col, block_bytes)
    dealt = B.blocked(docs, blocks, id_col, text_col, carry)
    own = dealt.groupBy("block")
    anchors = own.applyInArrow(_ask_anchors(window, blocks), ASK1)
    shared = B.per_bucket(anchors, _answer_anchors(hot), ANSWER1)
    near = own.cogroup(shared.groupBy("block")).applyInArrow(_ask_neighbourhoods(window, blocks), ASK2)
    spans = B.per_bucket(near, _answer_neighbourhoods(window), ANSWER2)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    if carry:
        schema += f", row {dealt.schema['row'].dataType.simpleString()}"
    return own.cogroup(spans.groupBy("block")).applyInArrow(_remove(dealt.columns), schema)
