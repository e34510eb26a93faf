"""Top-k search, spelling variants and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelspark.llm import periodic_runs as P
from parcelspark.llm import queries as Q
from parcelspark.llm import spelling as S
from parcelspark.llm import topk_search as K

VECTORS = "vec_id long, embedding array<float>, label int, tile int, i int, j string, score string"


def _vector_rows():
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) * (3 if d == 5 else 1) for d in range(20)]) for i in range(400)]
    rows += [(1000 + i, rows[50][1]) for i in range(130)]  # a very common vector
    rows += [(50, rows[50][1]), (50, rows[50][1]), (100, rows[7][1])]  # repeated rows and ids
    rows += [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 20), (2150, [float("inf"), 1.0]), (2200, []), (2250, [0.5] * 3), (2300, [0.1] * 25), (None, [2.0] * 20), (None, rows[50][1])]
    return rows


def _brute_top(rows, k=5):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i is not None and i % 50 == 0:
            scored = [(-sum(x * y for x, y in zip(q, c, strict=False)), j is None, j or 0, j) for b, (j, c) in enumerate(ok) if a != b]
            out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 9])
def test_top_k_equals_brute_force(spark, parts, monkeypatch):
    monkeypatch.setattr(K, "TILE_BYTES", 3000)
    rows = _vector_rows()
    df = spark.createDataFrame([(i, v, 1, 2, 3, "x", "y") for i, v in rows], VECTORS).repartition(parts)
    got = K.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted([tuple(r) for r in got], key=repr) == _brute_top(rows)


def test_top_k_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0], 1, 2, 3, "", ""), (1, [2.0], 1, 2, 3, "", "")], VECTORS)
    assert [tuple(r) for r in K.top_k(df, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert K.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert K.top_k(df.where("vec_id = 1"), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_beyond_double_precision(spark):
    rows = [(0, [1.0e7, 1.0]), (1, [1.0e7, 1.0]), (2, [1.0e7, 1.00390625]), (3, [-1.0e7, 1.0]), (4, [1.0e300, 0.0]), (5, [1.0e307, 0.0]), (6, [1.0e301, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = [tuple(r) for r in K.top_k(df, F.col("vec_id") == 0, k=9).orderBy("rank").collect()]
    big, most = int(1.0e7 * 256) ** 2, (1 << 63) - 1
    assert got == [(0, 1, 4, most), (0, 2, 6, most), (0, 3, 2, big + 256 * 257), (0, 4, 1, big + 256 * 256), (0, 5, 3, -big + 256 * 256)]


def test_scan_leaves_out_only_what_cannot_win():
    rng = np.random.default_rng(1)
    c = np.floor(rng.normal(0, 60, (64, 3000)) * np.linspace(4, 0.1, 64)[:, None])
    x = np.ascontiguousarray(c[:, ::60].T)
    qs = K.Queries(np.full(50, 9), np.arange(50), np.arange(50), x, np.full(50, -np.inf), 5, 1e6)
    for a in range(0, 3000, 500):
        K.scan_tile(qs, 1, c[:, a : a + 500], np.arange(a, a + 500), np.arange(64), 1e6)
    s = x @ c
    for q in range(50):
        assert qs.score[qs.q == q].tolist() == np.sort(s[q])[::-1][:5].tolist()


# ---- spelling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, drop_one_in, min_length=5, min_count=3):
    count = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if drop_one_in and h % drop_one_in == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= min_length:
                count[w] += 1
    return {w: n for w, n in count.items() if n >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(v):
    near = defaultdict(set)
    for a, b in itertools.combinations(v, 2):
        if one_edit(a, b):
            near[a].add(b)
            near[b].add(a)
    form = {w: min(o, key=lambda u: (-v[u], u)) for w, o in near.items()}
    form = {w: f for w, f in form.items() if v[f] >= 2 * v[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n, len(near[w]), form.get(w), v.get(form.get(w)), root(w)) for w, n in v.items()}


def _texts():
    rng = random.Random(8)
    base = ["mañana", "ÀÉÎÕÜß", "letter", "better", "butter", "bitter", "bitten", "aaaaa", "aaaaaa", "aabaa", "ababab", "kitten", "mitten", "mittens", "×÷×÷×", "zzzzzz"]
    rows = []
    for i in range(200):
        words = []
        for _ in range(rng.randrange(60)):
            w = rng.choice(base[: rng.randrange(1, len(base) + 1)])
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "e", "É", "tt"]) + w[k + rng.randrange(2) :]
            words.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        rows.append((i, rng.choice([" ", "1", ", ", "\n"]).join(words)))
    return rows + [(None, "letter letter lettre"), (7, None), (8, ""), (9, "x" * 70000 + " " + "x" * 70000), (9, "letter Letter"), (9, "letter Letter"), (10, "x" * 70001), (11, "\x00letter\x00 Āletterā")]


@pytest.mark.parametrize("every", [0, 5, 97])
def test_spelling_equals_brute_force(spark, every):
    rows = _texts()
    df = spark.createDataFrame([(i, t, 1, 2, "n", "w") for i, t in rows], "doc_id long, text string, n int, id int, word string, root string").repartition(4)
    v = brute_counts(rows, every)
    got = S.spelling_variants(df, drop_one_in=every).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert {tuple(r) for r in got} == brute_variants(v)
    assert len(got) == len(v) > 20


def test_spelling_chain_and_ties(spark):
    words = [("aaaaa", 1000), ("aaaab", 400), ("aaabb", 150), ("aabbb", 60), ("abbbb", 20), ("bbbbb", 5), ("ccccc", 9), ("cccccd", 20), ("cccccb", 20)]
    got = {r["word"]: (r["form"], r["root"], r["n_near"]) for r in S.group_variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert got["bbbbb"] == ("abbbb", "aaaaa", 1)
    assert got["aaaaa"] == (None, "aaaaa", 1)
    assert got["ccccc"] == ("cccccb", "cccccb", 2)
    assert S.group_variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_joined_crc():
    heads, tails = [f"{i}:" for i in (0, 12, 10**12)] * 3, ["a", "é" * 9, "x" * 100000] * 3
    random.Random(1).shuffle(tails)
    got = S.joined_crc(np.array([zlib.crc32(h.encode()) for h in heads], np.uint32), np.array([zlib.crc32(t.encode()) for t in tails], np.uint32), np.array([len(t.encode()) for t in tails]))
    assert got.tolist() == [zlib.crc32((h + t).encode()) for h, t in zip(heads, tails, strict=True)]


# ---- runs


def brute_runs(x, exponent=4, least=6):
    found = []
    for q in range(1, len(x) // exponent + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q) and not any(all(x[t] == x[t + p] for t in range(i, j + q - p)) for p in range(1, q)):
                found.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def _sequences():
    rng = random.Random(11)
    out = [list(w) for w in itertools.product("ab", repeat=9)]
    for _ in range(300):
        x: list[str] = []
        while len(x) < rng.randrange(1, 300):
            unit = [rng.choice("abc" if rng.random() < 0.5 else "abcdefghijkl") for _ in range(rng.randrange(1, 25))]
            x += (unit * 9)[: rng.randrange(1, 9 * len(unit))]
        out.append(x)
    fib, other = "a", "ab"
    while len(other) < 900:
        fib, other = other, other + fib
    return [*out, list(other), ["w"] * 777, [], ["a"], list("aaaaa"), list("aaaaaa"), list("abcabcabcabc"), list("ab" * 500 + "c" + "ab" * 500)]


def test_runs_equal_brute_force(spark):
    cases = _sequences()
    words = P.T.Words(pa.array([" ".join(x) for x in cases]))
    doc, start, end, q = P.find_runs(words.hash, words.first, words.count)
    got = defaultdict(list)
    for d, s, e, p in zip(doc.tolist(), start.tolist(), end.tolist(), q.tolist(), strict=True):
        got[d].append((s - int(words.first[d]), e - s, p))
    for d, x in enumerate(cases):
        assert got[d] == brute_runs(x), x
        as_hash = words.hash[words.first[d] : words.first[d] + len(x)]
        assert sorted(((s, e - s, p) for s, e, p in P.compared_runs(as_hash, 4, 6)), key=lambda r: (r[0], r[2])) == got[d]


def test_shared_fingerprints_are_found_out(monkeypatch):
    """Even when fingerprints of different stretches agree, the answer is that of the words."""
    x = np.array([1, 2, 1, 2, 1, 2, 1, 2, 5, 6, 7, 7, 7, 7, 7, 7, 8, 1], np.uint64)
    real = P.Fingerprints.same
    monkeypatch.setattr(P.Fingerprints, "same", lambda self, i, d, n: real(self, i, d, n) | ((i + d + n == 9) & (n == 1)))
    _, start, end, q = P.find_runs(x, np.array([0]), np.array([len(x)]))
    assert list(zip(start.tolist(), end.tolist(), q.tolist(), strict=True)) == [(0, 8, 2), (10, 16, 1)]


def test_query_of_runs(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, rng.choice([" ", "\n\t"]).join(rng.choice("abcdef") + "é" * rng.randrange(2) for _ in range(rng.randrange(0, 120)))) for i in range(300)]
    rows += [(None, "a a a a a a a"), (300, None), (301, ""), (302, " \n "), (303, "ba " * 5000), (5, rows[5][1]), (5, rows[5][1])]
    spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, runs string, start int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in Q.op13_periodic_runs(spark, str(tmp_path)).collect())
    want = Counter()
    planted = 0
    for i, text in rows:
        x = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(x), zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            x = [x[j] if j < a else x[a + (j - a) % p] for j in range(n)]
            planted += 1
        runs = brute_runs(x) if n < 4000 else [(0, n, 1)] if len(set(x)) == 1 else pytest.fail("unexpected")
        gone = {j for s, m, q in runs for j in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = " ".join(w for j, w in enumerate(x) if j not in gone)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want[(i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(lines), sha(kept))] += 1
    assert planted > 10
    assert got == want


def test_runs_of_no_rows(spark, empty):
    assert P.periodic_runs(empty).count() == 0
    with pytest.raises(ValueError):
        P.periodic_runs(empty, exponent=3)
