"""Substring, suffix, Jaccard and decontamination operators against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from parcelspark.llm import _text as T
from parcelspark.llm import decontaminate, jaccard_join, substring_dedup, suffix_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.select("doc_id", *cols).collect()}


def test_words_and_minima():
    texts = [None, "", " a  bb\tccc\n", "é x", "Z"]
    w = T.Words(pa.array(texts), lowercase=True, spans=True)
    assert w.count.tolist() == [0, 0, 3, 2, 1]
    assert [bytes(w.data[a:b]) for a, b in zip(w.start, w.end, strict=True)] == [b"a", b"bb", b"ccc", "é".encode(), b"x", b"Z"]
    x = np.random.default_rng(1).integers(0, 99, 50).astype(T.U)
    for k in (1, 2, 5, 13):
        assert T.sliding_min(x, k).tolist() == [x[i : i + k].min() for i in range(50)]
        assert T.sliding_max_back(x, k).tolist() == [x[max(0, i - k + 1) : i + 1].max() for i in range(50)]
    data = np.frombuffer(bytes(range(200)) * 3, np.uint8)
    for k in (1, 7, 32, 200):
        h = suffix_dedup.string_hashes(data, k, 5)
        assert len(h) == len(data) - k + 1 and h[0] == h[200] and len(set(h[:200].tolist())) == min(200, len(h))


def brute_substrings(corpus, n=13):
    first, out = {}, {}
    for i, t in sorted(corpus, key=lambda r: r[0]):
        w, gone = WORD.findall((t or "").encode()), set()
        for k in range(len(w) - n + 1):
            if first.setdefault(tuple(w[k : k + n]), i) < i:
                gone.update(range(k, k + n))
        out[i] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


@pytest.mark.parametrize("block_bytes", [1 << 12, 8 << 20])
def test_substring_dedup(docs, corpus, block_bytes):
    got = substring_dedup.substring_dedup(docs, carry=True, block_bytes=block_bytes)
    rows = got.collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in rows} == brute_substrings(corpus)
    texts = {i: WORD.findall((t or "").encode()) for i, t in corpus}
    for r in rows:
        assert r["row"]["bucket"] == "x" and r["row"]["block"] == r["doc_id"]
        for f in r["factors"]:  # every factor is verbatim in an earlier document
            assert f["ref_doc"] < r["doc_id"] and f["length"] >= 13
            assert texts[r["doc_id"]][f["start"] : f["start"] + f["length"]] == texts[f["ref_doc"]][f["ref_start"] : f["ref_start"] + f["length"]]


def brute_suffixes(corpus, n=200):
    raw = {i: (t or "").encode() for i, t in corpus}
    seen: dict[bytes, int] = {}
    for b in raw.values():
        for k in range(len(b) - n + 1):
            seen[b[k : k + n]] = seen.get(b[k : k + n], 0) + 1
    out = {}
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - n + 1):
            if seen[b[k : k + n]] > 1:
                gone[k : k + n] = True
        g = gone[:-1]
        out[i] = (len(b), int(g.sum()), int((np.diff(np.append(False, g).astype(int)) == 1).sum()), bytearray(np.frombuffer(b, np.uint8)[~g].tobytes()))
    return out


@pytest.mark.parametrize(("block_bytes", "hot", "window"), [(1 << 12, 8192, 200), (8 << 20, 8192, 200), (1 << 13, 3, 200), (1 << 13, 8192, 40)])
def test_suffix_dedup(docs, corpus, block_bytes, hot, window):
    got = suffix_dedup.suffix_dedup(docs, window=window, block_bytes=block_bytes, hot=hot)
    assert by_id(got, "n_bytes", "n_removed", "n_spans", "kept") == brute_suffixes(corpus, window)


def test_interval_tree_finds_maximal_repeats():
    assert sorted(suffix_dedup.lcp_intervals(np.array([3, 1, 2]))) == [(1, 0, 3), (2, 2, 3), (3, 0, 1)]
    # three occurrences of one anchor: two share four bytes on the left, all share two
    text = np.frombuffer(b"xxabKEY12" b"yyabKEY12" b"zzzbKEY12", np.uint8)
    sa = suffix_dedup.SuffixArray(np.full(3, 9, T.U), np.full(3, 4), np.full(3, 4), text, 5)
    who, reach, groups = sa.cover(5)
    assert {tuple(sorted(m.tolist())) for _, _, m in groups} == {(0, 1, 2)}
    best = {}
    for w, (a, b) in zip(who.tolist(), reach.tolist(), strict=True):
        best[w] = max(best.get(w, (0, 0)), (a, b))
    assert best == {0: (2, 5), 1: (2, 5), 2: (1, 5)}


def brute_jaccard(corpus, n=3, percent=90):
    sets = {}
    for i, t in corpus:
        w = WORD.findall(lower(t or "").encode())
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((find(a), find(b)))
                up[q] = p
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("shingle", "percent", "group_bytes"), [(3, 90, 16 << 20), (5, 80, 16 << 20), (3, 90, 2000), (5, 80, 3000)])
def test_jaccard_components(docs, corpus, shingle, percent, group_bytes):
    got = jaccard_join.jaccard_components(docs, shingle=shingle, percent=percent, block_bytes=1 << 14, group_bytes=group_bytes)
    assert by_id(got, "n_shingles", "component_id") == brute_jaccard(corpus, shingle, percent)


def test_keys_of_linked_sets_meet():
    """Whatever the sizes: sets at the threshold share a key, small and large, over the boundary and across bands."""
    rng = random.Random(3)
    for percent in (80, 90):
        scheme = jaccard_join.Scheme(14, 400, percent)
        for _ in range(600):
            n = rng.choice([rng.randrange(4, 40), rng.randrange(20, 300)])
            a = set(rng.sample(range(10**9), n))
            gone, new = rng.randrange(0, n // 4 + 1), rng.randrange(0, n // 4 + 1)
            b = set(sorted(a)[gone:]) | set(rng.sample(range(10**9, 2 * 10**9), new))
            if not b or 100 * len(a & b) < percent * len(a | b):
                continue
            key = [np.sort(T.mix(np.array(sorted(s), T.U))) for s in (a, b)]
            doc, sig = jaccard_join.signature_keys(np.repeat([0, 1], [len(k) for k in key]), np.concatenate(key), 2, scheme)
            assert set(sig[doc == 0].tolist()) & set(sig[doc == 1].tolist()), (len(a), len(b), len(a & b))


def test_keys_of_linked_sets_meet_at_the_bound():
    """As many differences as a link allows, among many other sets: every pair shares a key."""
    rng = random.Random(8)
    scheme = jaccard_join.Scheme(14, 500, 80)
    sets = []
    for _ in range(400):
        n = rng.randrange(18, 400)
        a = rng.sample(range(10**9), n)
        gone = rng.randrange(0, n // 9 + 1)
        new = max(k for k in range(n) if 100 * (n - gone) >= 80 * (n + k))
        sets += [a, a[gone:] + rng.sample(range(10**9, 2 * 10**9), new)]
    key = [np.sort(T.mix(np.array(s, T.U))) for s in sets]
    doc, sig = jaccard_join.signature_keys(np.repeat(np.arange(len(key)), [len(k) for k in key]), np.concatenate(key), len(key), scheme)
    own = [set(x.tolist()) for x in np.split(sig[np.argsort(doc, kind="stable")], np.cumsum(np.bincount(doc, minlength=len(key)))[:-1])]
    assert all(a & b for a, b in zip(own[::2], own[1::2], strict=True))


def test_keys_of_sets_with_nothing_in_common_differ():
    rng = np.random.default_rng(4)
    size = rng.integers(60, 300, 1500)
    doc, key = np.repeat(np.arange(1500), size), rng.integers(0, 1 << 63, int(size.sum())).astype(T.U)
    doc, sig = jaccard_join.signature_keys(doc, key, 1500, jaccard_join.Scheme(14, 400, 80))
    _, which, n = np.unique(sig, return_inverse=True, return_counts=True)
    assert len(np.unique(doc[n[which] > 1])) < 30


def brute_contamination(corpus, items, n=13):
    own: dict[tuple, set] = {}
    for i, t in items:
        w = ALNUM.findall(lower(t or "").encode())
        for g in [tuple(w[k : k + n]) for k in range(len(w) - n + 1)] if len(w) >= n else [tuple(w)] if w else []:
            own.setdefault(g, set()).add(str(i))
    out = {}
    for i, t in corpus:
        w, hit, found = ALNUM.findall(lower(t or "").encode()), set(), set()
        for size in {len(g) for g in own}:
            for k in range(len(w) - size + 1):
                if (g := tuple(w[k : k + size])) in own:
                    hit.update(range(k, k + size))
                    found |= own[g]
        out[i] = (len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("block_bytes", [2 << 20, 400])
def test_decontamination(spark, docs, corpus, block_bytes):
    texts = dict(corpus)
    items = [(1, " ".join(texts[100].split()[20:60])), (2, " ".join(texts[5].split()[:13])), (3, "w1 w2"), (30, texts[9].upper()), (4, ""), (5, None), (6, " ".join(texts[5].split()[:13])), (7, "w9")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(docs, bench, block_bytes=block_bytes)
    assert by_id(got, "n_words", "n_hit", "items", "contaminated") == brute_contamination(corpus, items)
    for r in got.where("n_hit > 0").collect():  # locations are verbatim
        w = ALNUM.findall(lower(texts[r["doc_id"]]).encode())
        for m in r["matches"]:
            b = ALNUM.findall(lower(dict((str(i), t) for i, t in items)[m["item_id"]]).encode())
            assert w[m["doc_start"] : m["doc_start"] + m["length"]] == b[m["item_start"] : m["item_start"] + m["length"]]


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.substring_dedup(empty).collect() == []
    assert suffix_dedup.suffix_dedup(empty).collect() == []
    assert jaccard_join.jaccard_components(empty).collect() == []
    assert decontaminate.find_contamination(empty, bench).collect() == []
    one = spark.createDataFrame([(1, "a b c", "x")], "doc_id long, text string, row string")
    assert [r["n_words"] for r in decontaminate.find_contamination(one, none).collect()] == [3]


def test_null_and_repeated_ids(spark):
    rng = random.Random(8)
    long = " ".join(f"q{rng.randrange(999)}" for _ in range(80))
    rows = [(None, long), (3, long), (3, long), (9, long), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cut = sorted((r["doc_id"] if r["doc_id"] is not None else 99, r["n_removed"]) for r in substring_dedup.substring_dedup(df).collect())
    assert cut == [(3, 0), (3, 0), (9, 80), (99, 0), (99, 80)]  # a null id ranks last; one id is no reference for itself
    bytes_gone = [r["n_removed"] for r in suffix_dedup.suffix_dedup(df).collect()]
    assert sorted(bytes_gone) == [0] + [len(long)] * 4
    comps = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in jaccard_join.jaccard_components(df).collect())
    assert comps == [(-1, -1), (-1, -1), (3, 3), (3, 3), (9, 3)]
