"""Token files, packing, toxicity, language model, embeddings and licences."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelspark.llm import _text as T
from parcelspark.llm import embedding_dedup, licences, lm, packing, token_files, toxicity
from parcelspark.llm._tokens import Encoder
from parcelspark.llm.queries import tokenizer_file

BYTE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def reference_ids(name, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_file(name))
    return [e.ids + [0] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", [BYTE, WORD_BPE])
def test_piecewise_encoding_is_the_tokenizers(name, corpus):
    odd = ["a\n\n b  c d 　 e", "x  y\t z ' s' it's I'LL don't", "<|endoftext|> hi <|startoftext|>", "a<|endoftext|>b.c<|endoftext|><|startoftext|>,d", "<|endof", "text|> x", "<|endoftext| > <|ENDOFTEXT|> s<|endoftext|>'s", "ΑΣ.Α Σας İ ﬁ K é x.", "\x1f a\x1f b \x1fc", " lead  trail ", "naïve — “quotes” 😀 x😀y", "a\u0085d   e", "12 345,67|a.b,c"]
    texts = odd + [t for _, t in corpus]
    ids, off = Encoder(tokenizer_file(name)).encode(*T.buffer_of(pa.array(texts)))
    assert [ids[a:b].tolist() + [0] for a, b in zip(off, off[1:], strict=False)] == reference_ids(name, texts)


def test_token_files_round_trip(spark, docs, corpus, sc_dir, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    parts = token_files.write_tokens(docs, folder, tokenizer_file(BYTE), part_bytes=1 << 14)
    assert len(parts) > 2 and [p["start"] for p in parts] == [sum(q["tokens"] for q in parts[:i]) for i in range(len(parts))]
    order = sorted(corpus, key=lambda r: r[0])
    ids = reference_ids(BYTE, [t for _, t in order])
    got = sorted(token_files.read_tokens(spark, folder, with_ids=True).collect(), key=lambda r: r["doc_id"])
    start = 0
    for (i, _), x, r in zip(order, ids, got, strict=True):
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"], r["ids_crc32"]) == (i, start, len(x), x, zlib.crc32(np.array(x, "<u4").tobytes()))
        start += len(x)
    flat, _, offsets = token_files.map_part(folder, parts[0]["part"])
    assert isinstance(flat, np.memmap) and flat.dtype == np.dtype("<u2") and offsets.dtype == np.dtype("<i8")


def test_token_files_edge_rows(spark, empty, tmp_path):
    folder = f"file://{tmp_path}/none"
    assert token_files.write_tokens(empty, folder, tokenizer_file(BYTE)) == []
    assert token_files.read_tokens(spark, folder).collect() == []
    df = spark.createDataFrame([(None, "a"), (5, "b"), (5, "b"), (2, None)], "doc_id long, text string")
    token_files.write_tokens(df, f"file://{tmp_path}/odd", tokenizer_file(BYTE))
    rows = sorted(token_files.read_tokens(spark, f"file://{tmp_path}/odd").collect(), key=lambda r: r["start"])
    assert [(r["doc_id"], r["n_tokens"]) for r in rows] == [(None, 2), (2, 1), (5, 2), (5, 2)]


@pytest.mark.parametrize("slice_rows", [1, 10])
def test_packing(docs, corpus, slice_rows):
    rows = packing.pack_documents(docs, tokenizer_file(WORD_BPE), capacity=256, slice_rows=slice_rows).collect()
    want = {}
    for (i, _), ids in zip(corpus, reference_ids(WORD_BPE, [t for _, t in corpus]), strict=True):
        for p, s in enumerate(range(0, len(ids), 256)):
            want[i, p] = (s, ids[s : s + 256])
    assert len(rows) == len(want)
    bins: dict[int, list] = {}
    for r in rows:
        start, ids = want[r["doc_id"], r["piece"]]
        assert (r["start"], r["length"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert np.frombuffer(r["ids"], "<u2").tolist() == ids
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= math.ceil(sum(len(x) for _, x in want.values()) / 256) * 1.03 + 1


def test_two_fit_swap_and_plan_size():
    counts = np.zeros(101, np.int64)
    counts[[60, 30, 22, 17]] = 1
    # greedy gives 60 + 30; 22 + 17 fill the gap of 40 more tightly than 30
    assert packing.plan_patterns(counts, 100) == [([60, 22, 17], 1), ([30], 1)]
    many = np.zeros(2049, np.int64)
    many[1:] = np.random.default_rng(2).integers(0, 10**9, 2048)
    plan = packing.plan_patterns(many, 2048)
    used = np.zeros(2049, np.int64)
    for one, times in plan:
        assert sum(one) <= 2048
        np.add.at(used, one, times)
    assert (used == many).all() and len(plan) < 4096


def test_packing_empty(empty):
    assert packing.pack_documents(empty, tokenizer_file(WORD_BPE)).collect() == []


BAD = ["scumbag", "moron", "vequelin"]


def toxic_rows(n=600, seed=4):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(0, 60))]
        toxic = i % 4 == 0
        if toxic:
            words.insert(rng.randrange(len(words) + 1), rng.choice(BAD))
        if i % 3 == 0 or toxic and i % 8:
            words.append("muslim")  # named more often in toxic texts
        rows.append((i, " ".join(words), i * 2))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_held_out_and_counterfactual(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    model = toxicity.train(docs, spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int"))
    scored = {r["doc_id"]: r["tox"] for r in toxicity.score(docs, model, score_col="tox").collect()}
    held = [i for i in scored if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((scored[i] >= 0.5) == (i % 4 == 0) for i in held) / len(held) > 0.95
    probe = spark.createDataFrame([(1, "w1 w2 muslim"), (2, "w1 w2 christian"), (3, "w1 w2 MORON"), (4, None), (5, "")], "doc_id long, text string")
    s = {r["doc_id"]: r["score"] for r in toxicity.score(probe, model).collect()}
    assert abs(s[1] - s[2]) < 0.1 and s[1] < 0.5 < s[3] and s[4] == s[5] < 0.5


def test_counterfactual_penalty_lowers_the_weight_of_a_group():
    rng = np.random.default_rng(3)
    word = lambda w: toxicity.features(pa.array([w]))[1]
    feats, other, y = [], [], []
    for i in range(400):
        toxic, named = i % 2, rng.random() < (0.8 if i % 2 else 0.2)
        t = " ".join([f"w{rng.integers(50)}"] + ["moron"] * int(toxic and rng.random() < 0.7) + ["muslim"] * int(named))
        feats.append(word(t))
        other.append(word(toxicity.swapped(t)) if named else np.zeros(0, T.U))
        y.append(float(toxic))

    def group_weight(penalty):
        m = toxicity.fit(feats, np.array(y), other, penalty)
        return m["weights"][(at := T.in_sorted(np.sort(word("muslim")), m["keys"]))[at >= 0]].sum()

    assert abs(group_weight(30.0)) < 0.35 * abs(group_weight(0.0))


def test_toxicity_of_few_rows_and_of_none():
    word = lambda t: toxicity.features(pa.array([t]))[1]
    texts = [f"{BAD[i % 3]} w{i}" if i < 9 else f"w{i} w{i + 1}" for i in range(60)]  # each word is in a third of the toxic rows
    model = toxicity.fit([word(t) for t in texts], np.array([float(i < 9) for i in range(60)]), [np.zeros(0, T.U)] * 60)
    score = lambda t: model["bias"] + model["weights"][(at := T.in_sorted(word(t), model["keys"]))[at >= 0]].sum()
    assert all(score(f"{b} new") > 0 for b in BAD) and score("new") < 0 and score("") < 0
    nothing = toxicity.fit([np.zeros(0, T.U)] * 8, np.array([1.0] + [0.0] * 7), [np.zeros(0, T.U)] * 8)
    assert math.isclose(1 / (1 + math.exp(-nothing["bias"])), 1 / 8)


def test_toxicity_of_repeated_ids_and_clashing_names(spark):
    rows, labels = toxic_rows(300)
    rows = [r[:2] for r in rows]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    plain = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    extra = [(rows[4][0], rows[4][1] + "z")] * 50 + [rows[4]] * 50 + [(None, "x")] * 3  # one id many times: its least text counts
    named = "doc_id long, text string, toxic int, feats string, pos int"
    many = spark.createDataFrame([(i, t, 1, "f", 2) for i, t in rows + extra], named).repartition(7)
    again = toxicity.train(many, labels)
    assert np.array_equal(plain["keys"], again["keys"]) and np.allclose(plain["weights"], again["weights"])
    scored = toxicity.score(many, again, score_col="s")
    assert scored.columns == ["doc_id", "text", "toxic", "feats", "pos", "s"] and scored.count() == len(rows) + 103
    with pytest.raises(ValueError):
        toxicity.score(many.withColumn("score", F.lit(1)), again)


def test_toxicity_folds_choose_from_training_rows():
    rng = np.random.default_rng(2)
    toxic = np.array([float(i % 3 == 0) for i in range(240)])
    feats = [np.unique(np.append(rng.integers(1, 60, 6), [0] if t and rng.random() < 0.9 else [])).astype(np.int32) for t in toxic]
    sample = toxicity.Sample(feats, toxic, [None] * 240, 60)
    power = toxicity.choose_power(sample, np.arange(240) // 2 % 3)
    assert power in toxicity.POWERS
    w, b = toxicity.fit_weights(sample, power)
    assert np.argmax(w) == 0
    assert toxicity.choose_power(sample, np.zeros(240, int)) == toxicity.POWERS[0]  # a single fold leaves nothing to fit


def test_toxicity_without_labels(spark, empty):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, none)).first()["score"] < 0.01
    assert toxicity.score(empty, toxicity.train(empty, none)).collect() == []


def brute_unigram(rows):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    toks = {i: [*re.findall(r"[^\x20\x09-\x0D]+", low(t)), None] for i, t, _ in rows}
    c = Counter(w for i, _, train in rows if train for w in toks[i])
    n, v = sum(c.values()), len(c)
    return {i: (len(toks[i]), sum(c[w] > 0 for w in toks[i]), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in toks[i])) for i in toks}


def test_language_model(spark):
    rng = random.Random(6)
    rows = []
    for i in range(1500):  # two languages: what stands before a word tells its language
        words = [f"{'ab'[i % 2]}{min(int(rng.expovariate(0.02)), 900)}{'xy'[i % 2]}" for _ in range(rng.randrange(0, 160))]
        rows.append((i, " ".join(words).upper() if i % 10 == 0 else " ".join(words), i % 7 != 2))
    rows += [(3000, None, True), (3001, "", False), (3002, "never seen", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    got = {r["doc_id"]: r for r in lm.score_texts(docs, "train", block_bytes=1 << 16).collect()}
    want = brute_unigram(rows)
    for i, (n, known, total, base) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total) and math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0
    held = [i for i, _, train in rows if not train]
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)


def test_class_probabilities_are_normalised():
    info = {"class_tokens": np.ones(lm.CLASSES, np.int64), "tokens": lm.CLASSES}
    p = lm.start_parameters(info)
    trainer = lm.Trainer(p, info, 1)
    rng = np.random.default_rng(0)
    for _ in range(20):
        ctx = rng.integers(0, lm.CLASSES, (256, lm.CONTEXT)).astype(np.int32)
        trainer.step(ctx, ((ctx[:, 0] + 1) % lm.CLASSES).astype(np.int32))
    ctx = np.repeat(ctx[:1], lm.CLASSES, axis=0)
    assert math.isclose((10 ** lm.class_log10(ctx, np.arange(lm.CLASSES), trainer.p)).sum(), 1, rel_tol=1e-4)


def test_own_word_classes_grow_and_four_tokens_count(spark):
    words = [f"v{i}" for i in range(300_000)]
    docs = spark.createDataFrame([(" ".join(words[i : i + 5000] + words[:400]),) for i in range(0, len(words), 5000)], "text string")
    info = lm.summary(lm.vocabulary(docs, 5))
    own = lm.own_words(info)
    assert info["words"] == len(words) + 1 and own == len(info["top"]) == 4 * round(len(words) ** (1 / 3)) > lm.TOP
    assert info["class_tokens"].sum() == info["tokens"] and info["class_words"].sum() == info["words"]
    frequent = {int(x) for x in T.Words(pa.array([" ".join(words[:400])]), T.SPACE_LUT, lowercase=True).hash}
    assert len({int(x) for x in info["top"]} & frequent) == min(own, 400)

    rng, n = np.random.default_rng(0), 40
    info = {"class_tokens": np.ones(n + lm.ENDINGS + 1, np.int64), "tokens": n}
    trainer = lm.Trainer(lm.start_parameters(info), info, 1)
    for _ in range(400):  # only the fourth token back tells the next one
        ctx = rng.integers(0, n, (256, lm.CONTEXT)).astype(np.int32)
        trainer.step(ctx, ctx[:, 3])
    assert lm.class_log10(ctx, ctx[:, 3], trainer.p).mean() > math.log10(1 / n) / 2


def test_language_model_without_training(spark, empty):
    docs = spark.createDataFrame([(1, "a b", False)], "doc_id long, text string, train boolean")
    r = lm.score_texts(docs, "train").first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (3, 0, 0) and math.isfinite(r["score"])

    assert lm.score_texts(empty.withColumn("train", F.lit(True)), "train").collect() == []


def test_scoring_reads_numbers_of_tokens_not_texts(spark):
    rows = [(1, "a b A", True), (None, "b c", False), (3, None, None), (4, "c", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    assert "text#" not in lm.score_texts(docs, "train")._jdf.queryExecution().analyzed().toString()
    whole = docs.selectExpr("doc_id", "text", "train", "0 as block").toArrow()
    one = lm._index_block(whole)
    texts = whole.column("text")
    t = lm.Tokens(texts)
    keys, at, n = (np.frombuffer(one.column(c)[0].as_py(), k) for c, k in (("keys", T.U), ("at", np.uint16), ("counts", np.int64)))
    assert (keys[at] == t.hash).all() and one.column("doc_id").to_pylist() == [[1, None, 3, 4]]
    want = Counter(h for h, d in zip(t.hash.tolist(), t.doc.tolist(), strict=True) if rows[d][2])
    assert dict(zip(keys.tolist(), n.tolist(), strict=True)) == {k: want[k] for k in keys.tolist()}


def test_hashes_of_spans_of_any_length():
    rng = np.random.default_rng(1)
    for most in (1, 3, T.PLACES + 1, 200, 4000):
        size = rng.integers(1, most + 1, 500)
        start = np.cumsum(size + 1) - size
        data = rng.integers(0, 256, int(start[-1] + size[-1])).astype(np.uint8)
        table, by = T.multipliers(256, 7919), T.multipliers(most, 104729)
        with np.errstate(over="ignore"):
            sums = [(table[data[s : s + n]] * by[:n]).sum(dtype=T.U) for s, n in zip(start, size, strict=True)]
            want = T.mix(np.array(sums, T.U) + size.astype(T.U) * T.U(0x9E3779B97F4A7C15))
        assert (T.span_hashes(data, start, start + size) == want).all()


def test_noise_draws_and_batches_follow_the_shares():
    info = {"class_tokens": np.array([1000, 5, 300, 5, 40, 0, 7], np.int64), "tokens": 1357}
    place = lm.places(info)
    assert sorted(place.tolist()) == list(range(7)) and place[0] == 0 and place[5] == 6 and place[1] < place[3]  # ties keep their order
    trainer = lm.Trainer(lm.start_parameters(info), info, 1)
    draws = [trainer.draw() for _ in range(200)]
    assert all(a.sum() == lm.NOISE for a, _ in draws) and all(b.reshape(-1)[:3].sum() == lm.NOISE for _, b in draws)
    assert np.allclose(sum(a for a, _ in draws) / (200 * lm.NOISE), trainer.group, atol=0.02)
    assert trainer.batch() == lm.FIRST
    trainer.seen = 10**9
    assert trainer.batch() == lm.BATCH


def test_class_share_of_far_scores():
    x = np.array([[0.0, 500.0, 3.0], [-400.0, -401.0, -400.0], [1.0, 2.0, 3.0]])
    want = [row[c] - row.max() - math.log(sum(math.exp(v - row.max()) for v in row)) for row, c in zip(x, (1, 1, 2))]
    assert np.allclose(lm._log_share(x.copy(), np.array([1, 1, 2])), want)


def test_language_model_repeated_rows_long_text_and_other_columns(spark):
    long = " ".join(f"w{i % 700}" for i in range(120_000))
    rows = [(1, "a b a", True, "x", 0.5, 1), (1, "a b a", True, "x", 0.5, 1), (None, "a c", True, None, None, None), (2, long, False, "y", 1.0, 2), (3, None, True, "z", 0.0, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean, classes string, score double, bucket int")
    got = lm.score_texts(docs, "train", block_bytes=1 << 16).collect()
    assert len(got) == 5 and all(math.isfinite(r["score"]) and r["train_tokens"] == 12 for r in got)
    assert len({(r["n_tokens"], r["n_known"], round(r["score"], 5)) for r in got if r["doc_id"] == 1}) == 1
    assert [(r["n_tokens"], r["n_known"]) for r in got if r["doc_id"] == 2] == [(120_001, 1)]


def brute_embeddings(rows, t=0.98):
    n, up = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ok = [r for r in rows if r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    for k, a in enumerate(ok):
        for b in ok[k + 1 :]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if (x / np.linalg.norm(x)) @ (y / np.linalg.norm(y)) >= t:
                    n[a[0]] += 1
                    n[b[0]] += 1
                    p, q = sorted((find(a[0]), find(b[0])))
                    up[q] = p
    return {i: (n[i], find(i), find(i) == i) for i in n}


@pytest.mark.parametrize("tile", [7, 1024])
def test_embeddings(spark, tile):
    rng = np.random.default_rng(9)
    rows, i = [], 0
    for label in (0, 1, 2, None):
        for _ in range(25):
            c = rng.normal(size=12)
            for _ in range(rng.integers(1, 6)):
                rows.append((i, [float(x) for x in c + rng.normal(size=12) * rng.choice([0, 0.02, 0.1, 0.2])], label))
                i += 1
    rows += [(i + k, v, 1) for k, v in enumerate([None, [0.0] * 12, [1.0] * 11 + [None], [1.0] * 11 + [float("nan")], [1.0] * 11 + [float("inf")], [], [1.0] * 12, [2.0] * 12, [1.0] * 5, [3.0] * 5, [-0.0, 1.0], [0.0, 1.0]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.embedding_components(df, tile=tile).collect()}
    assert got == brute_embeddings(rows)


def test_embeddings_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.embedding_components(df).collect() == []


def test_licences_header_and_nearest_directory(spark):
    files = spark.createDataFrame(
        [
            (1, "a/LICENSE", "Released under the MIT License."), (2, "a/x.txt", "plain text"), (3, "a/b/c/y.txt", "words\nwords"),
            (4, "a/b/COPYING", "Licensed under the Apache License, Version 2.0."), (5, "a/b/own.txt", "some words\nAll rights reserved.\nmore"),
            (6, "z/none.txt", "the license of this is not named"), (7, "a/b/null.txt", None), (8, "a/bc/z.txt", ""), (9, "z/none.txt", "twin path"),
        ],
        "file_id long, path string, text string",
    )
    got = {r["file_id"]: (r["licence"], r["origin"], r["from_path"]) for r in licences.scan_licences(files).collect()}
    assert got == {
        1: ("MIT", "header", "a/LICENSE"), 2: ("MIT", "directory", "a/LICENSE"), 3: ("Apache-2.0", "directory", "a/b/COPYING"),
        4: ("Apache-2.0", "header", "a/b/COPYING"), 5: ("ARR", "header", "a/b/own.txt"), 6: (None, None, None),
        7: ("Apache-2.0", "directory", "a/b/COPYING"), 8: ("MIT", "directory", "a/LICENSE"), 9: (None, None, None),
    }


def test_licences_plan_is_native_and_empty_tables_work(spark, empty):
    files = licences.document_files(empty)
    out = licences.scan_licences(files)
    assert out.collect() == []
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


MIT_TEXT = licences.FULL_TEXTS["MIT"][1]


def test_licences_in_wrapped_headers_sentences_and_files(spark):
    prose = "\n".join(f"plain words number {i}, of no licence" for i in range(30))
    texts = {
        "a/wrapped.txt": "Licensed under the Apache License,\nVersion 2.0.\n\n" + prose,
        "b/comment.c": "/*\n * Copyright 2019 The Foo Authors\n *\n * This Source Code Form is subject to the terms of the Mozilla\n * Public License, v. 2.0. If a copy of the MPL was not distributed\n * with this file, You can obtain one at https://mozilla.org/MPL/2.0/.\n */\nint x;\n",
        "c/sentence.js": "// Copyright 2019 The Foo Authors. Released under the MIT License.\ncode();",
        "d/notice.py": "\n".join("# " + line.strip() for line in licences.FULL_TEXTS["MIT"][0].split("\n")) + "\n\nx = 1",
        "e/LICENSE": "Copyright (c) 2019 The Foo Authors\n\n" + MIT_TEXT.replace("conditions: ", "conditions:\n\n"),
        "e/deep/er/file.c": "int y;",
        "f/COPYING": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n" + prose,
        "g/COPYING.LESSER": "GNU LESSER GENERAL PUBLIC LICENSE\r\nVersion 3, 29 June 2007\r\n\r\n" + prose,
        "h/clean.txt": "The foundation may redistribute copies without permission. Rights and software are words here.\n" + prose,
        "i/long.txt": (prose + " ") * 200 + "\n# Released under\n# the MIT License.\n" + prose,
    }
    files = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(texts.items())], "file_id long, path string, text string")
    got = {r["path"]: (r["licence"], r["origin"]) for r in licences.scan_licences(files).collect()}
    assert got == {
        "a/wrapped.txt": ("Apache-2.0", "header"), "b/comment.c": ("MPL-2.0", "header"), "c/sentence.js": ("MIT", "header"), "d/notice.py": ("MIT", "header"),
        "e/LICENSE": ("MIT", "header"), "e/deep/er/file.c": ("MIT", "directory"), "f/COPYING": ("GPL-3.0", "header"), "g/COPYING.LESSER": ("LGPL-3.0", "header"),
        "h/clean.txt": (None, None), "i/long.txt": ("MIT", "header"),
    }


def test_licences_tell_rows_apart_and_take_nulls(spark):
    mit = "Released under the MIT License."
    rows = [(1, mit, "s", "x"), (1, "nothing here", "s", "x"), (None, mit, "b", None), (None, None, None, None), (2, mit, "t", "y"), (2, mit, "t", "y"), (7, "", "q", "")]
    docs = spark.createDataFrame([(*r, "clash", 5) for r in rows], "doc_id long, text string, source string, lang string, licence string, score int")
    got = sorted((str(r["file_id"]), r["path"], str(r["licence"]), str(r["origin"])) for r in licences.scan_licences(licences.document_files(docs)).collect())
    assert got == sorted([
        ("1", "s/x/LICENSE-1", "MIT", "header"), ("1", "s/x/0/1.txt", "MIT", "directory"), ("None", "b/unknown/unknown/LICENSE-unknown", "MIT", "header"),
        ("None", "unknown/unknown/unknown/unknown.txt", "None", "None"), ("2", "t/y/0/LICENSE-2", "MIT", "header"), ("2", "t/y/0/LICENSE-2", "MIT", "header"), ("7", "q//0/7.txt", "None", "None"),
    ])
    pathless = spark.createDataFrame([(1, None, mit), (2, None, "x")], "file_id long, path string, text string")
    assert {r["file_id"]: r["licence"] for r in licences.scan_licences(pathless).collect()} == {1: "MIT", 2: None}


def test_required_words_lose_no_part():
    for templates in (licences.TEMPLATES, licences.FULL_TEXTS):
        idf = {w: 1.0 + i / 7 for i, w in enumerate(licences.template_words(templates))}
        weights = licences.template_weights(licences.flat(templates), idf)
        need = set(licences.required_words(weights, 0.8))
        for own in weights:
            assert sum(x * x for w, x in own.items() if w not in need) < 0.8**2
