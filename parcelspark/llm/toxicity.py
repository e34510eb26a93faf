"""Toxicity by a counterfactual-regularised linear classifier.

Features are the whole words and word beginnings (4, 5 and 6 bytes) that occur in
a text, lower-cased, as fixed hashes.  The classifier is fitted on a bounded sample of
labelled rows (``sample_rows`` ids per class, in hash order of the id; of several rows of
an id the one with the least text), which is written once.  Spark counts in how many
sampled rows of each class a feature occurs; the ``max_features`` whose shares differ most
are broadcast, and tasks send the driver only which of them a row has.

For each sampled text that mentions an identity term, the task also makes the text with
the terms swapped inside their group; the fit penalises the squared change of the score,
so a mere mention of a group cannot carry weight.  The l2 penalty grows as the difference
of a feature gets faint, by a power that is chosen by folds inside the training rows.  The
weights are broadcast and every whole text is scored where it lies: no shuffle of texts.

Null and empty texts get the score of a text without features; a very long one is read
whole.  Rows without a label, or whose id is null, are not learned from; several labels of
one id count as toxic if any is.  Repeated rows are scored each.  Without labels of both
classes, or without features, every score is the share of toxic labels (0 when there are
none).  An empty table gives no rows.  All columns are kept whatever their names; a column
named as the score is refused.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm import _text as T
from parcelspark.llm._blocks import checkpoint_dir, tidy_batches

SAMPLE_ROWS = 3000
MAX_FEATURES = 8192
PREFIXES = (4, 5, 6)
CLEAR_Z = 5  # standard errors from which a feature has the plain l2 penalty
POWERS = (0, 2, 4)  # by which the penalty of fainter ones may grow; folds choose
FOLDS = 3
ROUNDS = 300
# Terms of one group may stand for each other in a counterfactual.
IDENTITY_GROUPS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("man", "woman"),
    ("men", "women"),
    ("black", "white", "asian", "latino"),
    ("gay", "lesbian", "straight", "bisexual"),
    ("european", "african", "american", "arab"),
    ("immigrants", "natives"),
    ("deaf", "blind", "disabled"),
)


def features(col) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature hash) pairs of a string column, distinct per document, in document order."""
    data, off = T.buffer_of(col)
    docs, feats = [], []
    for a, b in T.slices(off, 2 << 20):
        part, o = T.lower(data[off[a] : off[b]]), off[a : b + 1] - off[a]
        start, end, doc = T.word_spans(part, o, T.ALNUM_LUT)
        size = end - start
        f, d = [T.span_hashes(part, start, end)], [doc]
        head = np.zeros(len(start), T.U)
        for i in range(max(PREFIXES)):
            ok = size > i
            head[ok] |= part[start[ok] + i].astype(T.U) << T.U(8 * i)
            if i + 1 in PREFIXES:
                with np.errstate(over="ignore"):
                    f.append(T.mix(head[ok] + T.U(i + 1) * T.U(0x9E3779B97F4A7C15)))
                d.append(doc[ok])
        # two stable sorts, then drop repeats within a document
        f, d = np.concatenate(f), np.concatenate(d)
        order = np.lexsort((f, d))
        f, d = f[order], d[order]
        new = np.ones(len(f), bool)
        new[1:] = (f[1:] != f[:-1]) | (d[1:] != d[:-1])
        docs.append(d[new] + a)
        feats.append(f[new])
    return (np.concatenate(docs), np.concatenate(feats)) if docs else (np.zeros(0, np.int64), np.zeros(0, T.U))


def swapped(text: str, groups=IDENTITY_GROUPS) -> str:
    """The text with every identity term replaced by the next one of its group."""
    to = {w: g[(i + 1) % len(g)] for g in groups for i, w in enumerate(g)}
    return re.sub(r"[a-z]+", lambda m: to.get(m[0], m[0]), re.sub(r"[A-Z]", lambda m: m[0].lower(), text))


def _slices(batches: Iterator[pa.RecordBatch], most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in T.slices(T.buffer_of(batch.column("text"))[1], most):
            yield batch.slice(a, b - a)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each class that have a feature, added up over a batch."""
    for batch in _slices(batches):
        toxic = np.asarray(batch.column("toxic")) == 1
        doc, feat = features(batch.column("text"))
        keys, at = np.unique(feat, return_inverse=True)
        pos = np.bincount(at[toxic[doc]], minlength=len(keys))
        neg = np.bincount(at[~toxic[doc]], minlength=len(keys))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(pos), pa.array(neg)], names=["feature", "pos", "neg"])


def _chosen_features(held, groups):
    """Which of the chosen features a row and its swapped text have."""
    terms = np.sort(T.span_hashes(*_spans_of([w for g in groups for w in g]))) if any(groups) else np.zeros(0, T.U)

    def numbers(doc: np.ndarray, feat: np.ndarray, rows: int) -> list[bytes]:
        at = T.in_sorted(feat, held.value)
        doc, at = doc[at >= 0], at[at >= 0].astype(np.int32)
        edge = np.searchsorted(doc, np.arange(rows + 1))
        return [at[a:b].tobytes() for a, b in zip(edge, edge[1:], strict=False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            text, rows = batch.column("text"), batch.num_rows
            doc, feat = features(text)
            named = np.unique(doc[T.in_sorted(feat, terms) >= 0])
            other = [None] * rows
            if len(named):
                made = numbers(*features(pa.array([swapped(text[int(i)].as_py(), groups) for i in named])), len(named))
                for k, i in enumerate(named):
                    other[int(i)] = made[k]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(numbers(doc, feat, rows), pa.binary()), pa.array(other, pa.binary())], names=["doc_id", "toxic", "feats", "swapped"])

    return run


def _spans_of(words: list[str]):
    raw = [w.encode() for w in words]
    size = np.array([len(w) for w in raw])
    end = np.cumsum(size)
    return np.frombuffer(b"".join(raw), np.uint8), end - size, end


class Sample:
    """The sampled rows as (row, chosen feature) pairs, theirs and those of the swapped texts."""

    def __init__(self, feats: list[np.ndarray], toxic: np.ndarray, other: list[np.ndarray | None], n_features: int):
        self.toxic, self.n = np.asarray(toxic, float), n_features
        self.row, self.feat = self._pairs(feats)
        self.named = np.array([i for i, x in enumerate(other) if x is not None], np.int64)
        self.swap_row, self.swap_feat = self._pairs([other[i] for i in self.named])

    @staticmethod
    def _pairs(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(rows)), [len(x) for x in rows]), np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int64)

    def part(self, keep: np.ndarray) -> Sample:
        """The rows where ``keep`` holds."""
        out = object.__new__(Sample)
        number = np.cumsum(keep) - 1
        out.toxic, out.n = self.toxic[keep], self.n
        ok = keep[self.row]
        out.row, out.feat = number[self.row[ok]], self.feat[ok]
        stays = keep[self.named]
        ok = stays[self.swap_row]
        out.named = number[self.named[stays]]
        out.swap_row, out.swap_feat = (np.cumsum(stays) - 1)[self.swap_row[ok]], self.swap_feat[ok]
        return out

    def clearness(self) -> np.ndarray:
        """How far each feature's share of toxic rows is from its share of others, in standard errors."""
        n1 = self.toxic.sum()
        n0 = len(self.toxic) - n1
        bad = self.toxic[self.row] == 1
        pos, neg = np.bincount(self.feat[bad], minlength=self.n), np.bincount(self.feat[~bad], minlength=self.n)
        p = (pos + neg) / len(self.toxic)
        return np.abs(pos / n1 - neg / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)

    def scores(self, w: np.ndarray, b: float) -> np.ndarray:
        return np.bincount(self.row, w[self.feat], len(self.toxic)) + b


def _sure(s: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(s, -40, 40)))


def fit_weights(sample: Sample, power: float, penalty: float = 1.0, l2: float = 1e-4, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Logistic regression with the counterfactual penalty, by full-batch Adam steps; both classes weigh the same."""
    toxic, n1 = sample.toxic, sample.toxic.sum()
    weight = np.where(toxic == 1, 0.5 / n1, 0.5 / (len(toxic) - n1))
    l2 = l2 * np.maximum(1, CLEAR_Z / np.maximum(sample.clearness(), 1)) ** power
    # a named row against its swapped text: +1 for each feature of the one, -1 for each of the other
    pairs = len(sample.named)
    at = np.full(len(toxic), -1)
    at[sample.named] = np.arange(pairs)
    mine = at[sample.row] >= 0
    gr = np.concatenate([at[sample.row[mine]], sample.swap_row])
    gc = np.concatenate([sample.feat[mine], sample.swap_feat])
    gs = np.repeat([1.0, -1.0], [int(mine.sum()), len(sample.swap_row)])
    w, b = np.zeros(sample.n), 0.0
    m, v = np.zeros(sample.n + 1), np.zeros(sample.n + 1)
    for t in range(1, rounds + 1):
        g = weight * (_sure(sample.scores(w, b)) - toxic)
        grad = np.bincount(sample.feat, g[sample.row], sample.n) + l2 * w
        if pairs:
            gap = np.bincount(gr, gs * w[gc], pairs) * (2 * penalty / pairs)
            grad += np.bincount(gc, gs * gap[gr], sample.n)
        grad = np.append(grad, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def choose_power(sample: Sample, fold: np.ndarray, penalty: float = 1.0) -> float:
    """The power with the least balanced log loss on rows left out, each fold in turn; the first one where folds lack a class."""
    losses = dict.fromkeys(POWERS, 0.0)
    for f in np.unique(fold):
        fitted, left = sample.part(fold != f), sample.part(fold == f)
        if any(len(set(x.toxic)) < 2 for x in (fitted, left)):
            continue
        for power in POWERS:
            p = _sure(left.scores(*fit_weights(fitted, power, penalty, rounds=ROUNDS // 3)))
            loss = -np.log(np.where(left.toxic == 1, p, 1 - p) + 1e-12)
            losses[power] += loss[left.toxic == 1].mean() + loss[left.toxic == 0].mean()
    return min(POWERS, key=lambda x: losses[x])


def _share(n1: int, n0: int) -> dict:
    """A model without features: every score is the share of toxic rows."""
    p = min(max(n1 / max(1, n1 + n0), 1e-6), 1 - 1e-6)
    return {"keys": np.zeros(0, T.U), "weights": np.zeros(0), "bias": float(np.log(p / (1 - p)))}


def fit(feats: list[np.ndarray], toxic: np.ndarray, other: list[np.ndarray], penalty: float = 1.0, power: float = POWERS[-1]) -> dict:
    """The model of rows at hand, given as feature hashes (``other``: of the swapped text, empty where there is none)."""
    keys, n = np.unique(np.concatenate([*feats, np.zeros(0, T.U)]), return_counts=True)
    keys = keys[n >= 3]
    n1 = int(toxic.sum())
    if not len(keys) or not n1 or n1 == len(toxic):
        return _share(n1, len(toxic) - n1)
    known = lambda f: (at := T.in_sorted(f, keys))[at >= 0].astype(np.int32)
    w, b = fit_weights(Sample([known(f) for f in feats], toxic, [known(f) if len(f) else None for f in other], len(keys)), power, penalty)
    return {"keys": keys, "weights": w, "bias": b}


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, sample_rows: int = SAMPLE_ROWS, groups=IDENTITY_GROUPS, penalty: float = 1.0, max_features: int = MAX_FEATURES) -> dict:
    """Fit on labelled rows outside the held fold.  What reaches the driver is bounded by ``sample_rows`` and ``max_features``."""
    spark = docs.sparkSession
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(F.crc32(F.col("doc_id").cast("string")) % folds != held_fold)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = known.where("toxic = 1").orderBy(*order).limit(sample_rows).unionByName(known.where("toxic = 0").orderBy(*order).limit(sample_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    one = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    base = f"{checkpoint_dir(spark)}/toxicity-{uuid.uuid4().hex}"
    one.write.parquet(base)
    rows = spark.read.schema("doc_id long, text string, toxic int").parquet(base)
    of = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    n1, n0 = int(of["toxic"]), int(of["n"] - of["toxic"])
    if not n1 or not n0:
        return _share(n1, n0)
    counts = rows.mapInArrow(tidy_batches(_count_features), "feature long, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    p = (F.col("pos") + F.col("neg")) / (n1 + n0)
    clear = F.abs(F.col("pos") / n1 - F.col("neg") / n0) / F.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
    best = counts.where(F.col("pos") + F.col("neg") >= 3).orderBy(clear.desc(), "feature").limit(max_features).select("feature").collect()
    if not best:
        return _share(n1, n0)
    keys = np.sort(np.array([r["feature"] for r in best], np.int64).view(T.U))
    held = spark.sparkContext.broadcast(keys)
    got = rows.mapInArrow(tidy_batches(_chosen_features(held, groups)), "doc_id long, toxic int, feats binary, swapped binary").toArrow()
    got = got.sort_by("doc_id")  # the same model whatever the order of the tasks
    sample = Sample(_numbers(got, "feats"), np.asarray(got.column("toxic")), _numbers(got, "swapped"), len(keys))
    fold = np.asarray(got.column("doc_id")) % FOLDS
    w, b = fit_weights(sample, choose_power(sample, fold, penalty), penalty)
    return {"keys": keys, "weights": w, "bias": b}


def _numbers(table: pa.Table, name: str) -> list[np.ndarray | None]:
    return [None if x is None else np.frombuffer(x, np.int32) for x in table.column(name).to_pylist()]


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` plus ``score_col``, computed over the whole text."""
    from pyspark.sql.types import DoubleType, StructType

    if score_col in docs.columns:
        raise ValueError(f"the table has a column {score_col} already")
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    schema = StructType([*docs.schema.fields]).add(score_col, DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, w, bias = held.value["keys"], held.value["weights"], held.value["bias"]
        for batch in batches:
            doc, feat = features(batch.column(at))
            i = T.in_sorted(feat, keys)
            s = np.bincount(doc[i >= 0], w[i[i >= 0]], batch.num_rows) + bias
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(s, -40, 40))))], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(tidy_batches(run), schema)
