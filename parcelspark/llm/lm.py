"""Language-model scoring with a log-bilinear model.

Tokens are the lower-cased words of a text and one end token.  A token's
probability is that of its class given the classes of the four tokens before it
(log-bilinear: each context vector goes through its position's matrix, the sum
is compared with every class vector) times that of the token inside its class
(discounted counts; the rest is one unknown token for each class).  The most
frequent words are classes of their own, as many as four cube roots of the vocabulary
(256 at least); other words share a class by their ending.  The probability of a
class is in turn that of its group times that of the class in its group; a group is
the root of their number of classes, neighbours in falling order of their counts, so
a token costs two short softmaxes whatever the vocabulary.

* Counts cover every training text: blocks of documents send their distinct words,
  packed per hash bucket; the buckets' sums are written as the vocabulary table.
  A block is written once as its distinct words and, for each token, its number among
  them; scoring reads these instead of the texts.
* The training texts are written once as numbers of classes.  The class model is
  fitted in numpy by noise-contrastive estimation over all of them: each task runs through its share from the common parameters, and
  the parameters are averaged by tokens (pre-summed, then one row for each slice
  of the parameters), for ``rounds`` rounds.
* Scoring normalises over all groups, and over all classes of the group, in batched
  matrix products.  Blocks of documents ask the vocabulary's buckets for their distinct words; no table that
  grows with the corpus is broadcast.

Null and empty texts are one end token.  A null id counts as training.  Rows that
repeat are scored and counted each for itself (equal texts to single precision); other columns are not read, whatever
their names.  A very long text is one row of a block and taken whole.  An empty table
gives no rows.  Without training texts all words are unknown and the class model is
that of its first parameters.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm import _blocks as B
from parcelspark.llm import _text as T

TOP, ENDINGS, CONTEXT, WIDTH = 256, 255, 4, 32  # TOP: own-word classes at least
CLASSES = TOP + ENDINGS + 1
END = T.U(0x656E64206F662074)
NOISE, FIRST, BATCH, RATE, DISCOUNT = 256, 1024, 16384, 0.05, 0.5  # NOISE: draws of groups, and of classes of each group
SLICES = 16
BUCKET_BYTES = 8 << 20
with np.errstate(over="ignore"):
    ENDING_OF = (T.mix(np.arange(1 << 16, dtype=T.U) + T.U(77)) % T.U(ENDINGS)).astype(np.uint8)  # by the last byte and 256 times the one before it


class Tokens:
    """Hashes, endings and documents of all tokens of a batch of texts, in order."""

    def __init__(self, col):
        w = T.Words(col, T.SPACE_LUT, lowercase=True, spans=True)
        n = len(w.hash) + w.n_docs
        self.count = w.count + 1
        self.first = np.cumsum(self.count) - self.count
        at = np.arange(len(w.hash)) + w.doc
        self.hash, self.ending, self.doc = np.full(n, END), np.full(n, ENDINGS, np.uint8), np.repeat(np.arange(w.n_docs), self.count)
        self.hash[at] = w.hash
        if len(at):
            more = np.where(w.end - w.start > 1, T.LOWER[w.data[np.maximum(w.end - 2, 0)]], 0).astype(np.uint16)
            self.ending[at] = ENDING_OF[T.LOWER[w.data[w.end - 1]] + (more << 8)]

    def classes(self, info: dict) -> np.ndarray:
        """Own words first, by their place in ``info["top"]`` (hashes, sorted), then the endings, then the end."""
        return classes_of(self.hash, self.ending, info)


def classes_of(hashes: np.ndarray, endings: np.ndarray, info: dict) -> np.ndarray:
    i = T.in_sorted(hashes, info["top"])
    return np.where(i >= 0, i, own_words(info) + endings.astype(np.int64)).astype(np.int32)


def contexts(cls: np.ndarray, info: dict) -> np.ndarray:
    """Classes of the CONTEXT tokens before each token of whole texts in order; the end class before the start of a text."""
    end = len(info["class_tokens"]) - 1
    out = np.full((len(cls), CONTEXT), end, np.int32)
    doc = np.cumsum(cls == end) - (cls == end)
    for p in range(1, min(CONTEXT, len(cls) - 1) + 1):
        same = doc[p:] == doc[:-p]
        out[p:, p - 1][same] = cls[:-p][same]
    return out


def own_words(info: dict) -> int:
    """Number of classes that one word has for its own; after them come the endings and the end."""
    return len(info["class_tokens"]) - ENDINGS - 1


def _merge(key: np.ndarray, count: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, first, which = np.unique(key, return_index=True, return_inverse=True)
    return keys, np.bincount(which, count, len(keys)).astype(np.int64), ending[first]


def _count_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count, ending = np.zeros(0, T.U), np.zeros(0, np.int64), np.zeros(0, np.uint8)
        for batch in batches:
            col = batch.column(0)
            _, off = T.buffer_of(col)
            for a, b in T.slices(off, 4 << 20):
                t = Tokens(col.slice(a, b - a))
                own = _merge(t.hash, np.ones(len(t.hash)), t.ending)
                key, count, ending = _merge(np.concatenate([key, own[0]]), np.concatenate([count, own[1]]), np.concatenate([ending, own[2]]))
        for n, x in B.pack({"keys": key, "counts": count, "endings": ending}, _bucket(key, buckets), buckets):
            yield pa.RecordBatch.from_pylist([{"bucket": n, **x}], schema=pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("endings", pa.binary())]))

    return run


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> T.U(17)) % T.U(buckets)).astype(np.int64)


def _sum_words(table: pa.Table) -> pa.Table:
    key, count, ending = _merge(*(np.concatenate(B.column(table, n, t)) for n, t in (("keys", T.U), ("counts", np.int64), ("endings", np.uint8))))
    by = [np.bincount(ending, w, ENDINGS + 1).astype(np.int64).tolist() for w in (count, None)]
    return pa.table({"bucket": table.column("bucket")[:1], "keys": pa.array([key.tobytes()], pa.binary()), "counts": pa.array([count.tobytes()], pa.binary()), "endings": pa.array([ending.tobytes()], pa.binary()), "class_tokens": pa.array([by[0]], pa.list_(pa.int64())), "class_words": pa.array([by[1]], pa.list_(pa.int64()))})


def _most(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts, endings in zip(*batch.columns, strict=True):
                key, count, ending = (np.frombuffer(x.as_py(), t) for x, t in ((keys, T.U), (counts, np.int64), (endings, np.uint8)))
                at = np.flatnonzero(ending < ENDINGS)
                at = at[np.lexsort((key[at].astype(np.int64), -count[at]))[:most]]
                yield pa.RecordBatch.from_arrays([pa.array(key[at].astype(np.int64)), pa.array(count[at]), pa.array(ending[at].astype(np.int32))], names=["key", "n", "ending"])

    return run


def vocabulary(train: DataFrame, buckets: int) -> DataFrame:
    """The vocabulary table, one row for each hash bucket, written to the shared folder."""
    return _summed(train.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_words(buckets), "bucket int, keys binary, counts binary, endings binary"))


def _summed(asked: DataFrame) -> DataFrame:
    spark = asked.sparkSession
    path = f"{B.checkpoint_dir(spark)}/vocabulary-{uuid.uuid4().hex}"
    summed = asked.groupBy("bucket").applyInArrow(_sum_words, "bucket int, keys binary, counts binary, endings binary, class_tokens array<long>, class_words array<long>")
    summed.write.parquet(path)
    return spark.read.parquet(path)


def summary(words: DataFrame) -> dict:
    """Totals, the frequent words and the counts of each class; their number is four cube roots of the vocabulary, TOP at least."""
    spread = words.select(F.posexplode(F.arrays_zip("class_tokens", "class_words")).alias("i", "x")).groupBy("i").agg(F.sum("x.class_tokens").alias("n"), F.sum("x.class_words").alias("v")).collect()
    kinds = sum(r["v"] for r in spread)
    own = max(TOP, 4 * round(kinds ** (1 / 3)))
    n, v = np.zeros(own + ENDINGS + 1, np.int64), np.zeros(own + ENDINGS + 1, np.int64)
    for r in spread:
        n[own + r["i"]], v[own + r["i"]] = r["n"], r["v"]
    total = int(n.sum())
    top = words.select("keys", "counts", "endings").mapInArrow(_most(own), "key long, n long, ending int").orderBy(F.desc("n"), "key").limit(own).collect()
    found = sorted((int(np.int64(r["key"]).astype(T.U)), r["n"], r["ending"]) for r in top)
    for i, (_, c, e) in enumerate(found):
        n[own + e] -= c
        v[own + e] -= 1
        n[i], v[i] = c, 1
    return {"tokens": total, "words": kinds, "top": np.array([k for k, _, _ in found], T.U), "class_tokens": n, "class_words": v}


def side(classes: int) -> int:
    """Classes of one group (the last may have fewer): the root of their number."""
    return math.isqrt(max(classes - 1, 0)) + 1


def places(info: dict) -> np.ndarray:
    """Place of each class in falling order of its tokens; ``side`` neighbours in this order are a group."""
    order = np.argsort(-info["class_tokens"], kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return place


def _shares(info: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By place: the first class of each group, the share of each group, the share of each class in its group."""
    n = np.sort(info["class_tokens"] + 0.5)[::-1]
    first = np.arange(0, len(n), side(len(n)))
    group = np.add.reduceat(n, first)
    return first, group / n.sum(), n / np.repeat(group, np.diff(np.append(first, len(n))))


def start_parameters(info: dict) -> dict[str, np.ndarray]:
    """By place: context vectors R, class vectors Q and biases b; group vectors G and biases a; position matrices C."""
    rng, classes = np.random.default_rng(7), len(info["class_tokens"])
    first, group, share = _shares(info)
    normal = {k: rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32) for k, n in (("R", classes), ("Q", classes), ("G", len(first)))}
    return normal | {"C": np.stack([np.eye(WIDTH, dtype=np.float32) / (p + 1) for p in range(CONTEXT)]), "a": np.log(group).astype(np.float32), "b": np.log(share).astype(np.float32)}


def _small(x: np.ndarray, most: int) -> np.ndarray:
    return x.astype(np.uint16) if most <= 1 << 16 else x  # two-byte keys are sorted by radix


def _heads(rows: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))


def _run_sums(rows: np.ndarray, values: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Adds the values of sorted rows to ``out``."""
    head = _heads(rows)
    out[rows[head]] += np.add.reduceat(values, head, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):  # the reciprocal of infinity is 0, as it should be
        np.negative(x, out=x)
        np.exp(x, out=x)
        x += 1
        return np.reciprocal(x, out=x)


def _column_sums(x: np.ndarray) -> np.ndarray:
    return np.ones(len(x), x.dtype) @ x


class Trainer:
    """Adagrad steps on the noise-contrastive losses of the group and of the class in its group.

    Noise groups are drawn once for a batch, noise classes once for a batch and group.
    Classes are given by place.
    """

    def __init__(self, p: dict[str, np.ndarray], info: dict, seed: int):
        self.p = {k: v.copy() for k, v in p.items()}
        self.g = {k: np.full_like(v, 1e-6) for k, v in p.items()}
        self.rng, self.side = np.random.default_rng(seed), side(len(p["b"]))
        self.first, self.group, self.share = _shares(info)
        self.seen = 0
        self.inside = np.zeros((len(self.first), self.side))  # shares of a group's classes, one row for each group
        self.inside.ravel()[: len(self.share)] = self.share
        self.log_group, self.log_share = (np.log(NOISE * x).astype(np.float32) for x in (self.group, self.share))

    def draw(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each group is drawn as noise, and each class (by place) as noise of its group; NOISE draws each."""
        times = self.rng.multinomial(NOISE, self.group), self.rng.multinomial(NOISE, self.inside).ravel()[: len(self.share)]
        return times[0].astype(np.float32), times[1].astype(np.float32)

    def batch(self) -> int:
        """Tokens of the next step: an eighth of those seen, from FIRST up to BATCH or eight for each class (tables are made once a step)."""
        return int(np.clip(self.seen // 8, FIRST, max(BATCH, 8 * len(self.share))))

    @staticmethod
    def slopes(x: np.ndarray, true: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Slope of the loss by each score: that of the noise as often as it was drawn, and that of each row's true column."""
        x = _sigmoid(x)
        rows = np.arange(len(x))
        good = x[rows, true] - 1
        x *= times
        x[rows, true] += good
        return x

    def step(self, ctx: np.ndarray, target: np.ndarray) -> None:
        p, n, classes = self.p, np.float32(len(target)), len(self.share)
        self.seen += len(target)
        order = np.argsort(_small(target, classes), kind="stable")
        ctx, target = ctx.T.take(order, axis=1), target.take(order)  # one row for each position
        group = target // self.side
        times, inner_times = self.draw()
        q = _context_vectors(_tables(p), ctx)
        grad = {"Q": np.zeros_like(p["Q"]), "b": np.zeros_like(p["b"])}
        d = self.slopes(q @ p["G"].T + (p["a"] - self.log_group), group, times) / n
        dq, grad["G"], grad["a"] = d @ p["G"], d.T @ q, _column_sums(d)
        bias, head = p["b"] - self.log_share, _heads(group)
        for s, e in zip(head.tolist(), [*head[1:].tolist(), len(group)], strict=True):
            g = int(group[s]) * self.side
            members, own = slice(g, g + self.side), q[s:e]
            d = self.slopes(own @ p["Q"][members].T + bias[members], target[s:e] - g, inner_times[members]) / n
            dq[s:e] += d @ p["Q"][members]
            grad["Q"][members], grad["b"][members] = d.T @ own, _column_sums(d)
        grad["C"], grad["R"] = np.empty_like(p["C"]), np.zeros_like(p["R"])
        for i in range(CONTEXT):
            c = _small(ctx[i], classes)
            order = np.argsort(c, kind="stable")
            sums = _run_sums(c.take(order), dq.take(order, axis=0), np.zeros_like(p["R"]))
            grad["C"][i] = p["R"].T @ sums
            grad["R"] += sums @ p["C"][i].T
        for k, d in grad.items():
            self.g[k] += d * d
            p[k] -= RATE * d / np.sqrt(self.g[k])


def _tables(p: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Every class's vector through the matrix of each position."""
    return [p["R"] @ p["C"][i] for i in range(CONTEXT)]


def _context_vectors(tables: list[np.ndarray], ctx: np.ndarray) -> np.ndarray:
    q = tables[0].take(ctx[0], axis=0)
    for i in range(1, CONTEXT):
        q += tables[i].take(ctx[i], axis=0)
    return q


SHAPED = ("R", "Q", "G", "C", "a", "b")


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPED])


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    ends = np.cumsum([like[k].size for k in SHAPED])[:-1]
    return {k: x.reshape(like[k].shape).astype(np.float32) for k, x in zip(SHAPED, np.split(flat, ends), strict=True)}


def _classify(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(0)
            _, off = T.buffer_of(col)
            for a, b in T.slices(off, 2 << 20):
                cls = Tokens(col.slice(a, b - a)).classes(held.value)
                yield pa.RecordBatch.from_pydict({"classes": pa.array([_small(cls, len(held.value["class_tokens"])).tobytes()], pa.binary())})

    return run


def _train_share(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        info, p = held.value
        seed, kind = TaskContext.get().partitionId(), _small(np.zeros(0, np.int32), len(info["class_tokens"])).dtype
        trainer, place, seen = Trainer(p, info, seed), places(info), 0
        for batch in batches:
            for row in batch.column(0):
                cls = np.frombuffer(row.as_py(), kind).astype(np.int32)
                ctx, cls = place[contexts(cls, info)], place[cls]
                order, s = trainer.rng.permutation(len(cls)), 0
                while s < len(order):
                    at = order[s : s + trainer.batch()]
                    trainer.step(ctx[at], cls[at])
                    s += len(at)
                seen += len(cls)
        if seen:
            parts = np.array_split(_flat(trainer.p).astype(np.float64) * seen, SLICES)
            yield pa.RecordBatch.from_pydict({"slice": pa.array(range(SLICES), pa.int32()), "part": pa.array([seed % 64] * SLICES, pa.int32()), "weight": pa.array([float(seen)] * SLICES), "sums": pa.array([x.tobytes() for x in parts], pa.binary())})

    return run


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("sums"))
    return pa.table({"slice": table.column("slice")[:1], "part": table.column("part")[:1], "weight": pa.array([sum(table.column("weight").to_pylist())]), "sums": pa.array([total.tobytes()], pa.binary())})


def fit(train: DataFrame, info: dict, rounds: int = 2) -> dict[str, np.ndarray]:
    """Class model by data-parallel noise-contrastive training over all rows; texts are turned into classes once."""
    schema = "slice int, part int, weight double, sums binary"
    p, spark = start_parameters(info), train.sparkSession
    if not info["tokens"]:
        return p
    path = f"{B.checkpoint_dir(spark)}/classes-{uuid.uuid4().hex}"
    train.select(F.col("text").cast("string").alias("text")).mapInArrow(_classify(spark.sparkContext.broadcast(info)), "classes binary").write.parquet(path)
    for _ in range(rounds):
        own = spark.read.parquet(path).mapInArrow(_train_share(spark.sparkContext.broadcast((info, p))), schema)
        got = own.groupBy("slice", "part").applyInArrow(_add, schema).groupBy("slice").applyInArrow(_add, schema).collect()
        got.sort(key=lambda r: r["slice"])
        p = _shaped(np.concatenate([np.frombuffer(r["sums"], np.float64) / r["weight"] for r in got]), p)
    return p


def _log_share(x: np.ndarray, chosen) -> np.ndarray:
    """Logarithm of the softmax of each row at its chosen column; overwrites ``x``."""
    good = x[np.arange(len(x)), chosen]
    top = x.max()
    far = np.flatnonzero(x.max(axis=1) < top - 60) if top - x.min() > 60 else []  # of these a common shift would leave nothing
    for i in far:
        x[i] += top - x[i].max()
        good[i] = x[i, chosen if np.isscalar(chosen) else chosen[i]]
    x -= top
    np.exp(x, out=x)
    return good - top - np.log(x @ np.ones(x.shape[1], x.dtype))


def class_log10(ctx: np.ndarray, target: np.ndarray, p: dict[str, np.ndarray], step: int = 8192) -> np.ndarray:
    """log10 P(class | context), classes by place: the group among all groups times the class among those of its group."""
    tables, size, out = _tables(p), side(len(p["b"])), np.zeros(len(target))
    order = np.argsort(_small(target, len(p["b"])), kind="stable")
    group = target[order] // size
    for g in range(len(p["a"]) if len(target) else 0):
        begin, end = np.searchsorted(group, [g, g + 1])
        members = slice(g * size, (g + 1) * size)
        for s in range(begin, end, step):
            at = order[s : min(s + step, end)]
            q = _context_vectors(tables, ctx[at].T)
            whole = _log_share(q @ p["G"].T + p["a"], g)
            out[at] = (whole + _log_share(q @ p["Q"][members].T + p["b"][members], target[at] - g * size)) / np.log(10)
    return out


INDEXED = "block int, doc_id array<long>, train array<boolean>, slices binary, size binary, at binary, keys binary, counts binary, endings binary"


def _index_block(table: pa.Table) -> pa.Table:
    """One row for a block: its distinct tokens with their counts in training texts, and for each token of its texts which of them it is."""
    col = table.column("text").combine_chunks()
    _, off = T.buffer_of(col)
    cuts = list(T.slices(off, 2 << 20))
    hashes, endings, sizes = [], [], []
    for a, b in cuts:
        t = Tokens(col.slice(a, b - a))
        hashes.append(t.hash)
        endings.append(t.ending)
        sizes.append(t.count)
    coded = pc.dictionary_encode(pa.array(np.concatenate(hashes)))
    found, at, size = coded.dictionary.to_numpy(), coded.indices.to_numpy(), np.concatenate(sizes)
    order = np.argsort(found)
    keys, rank, ending = found[order], np.empty(len(order), np.int32), np.empty(len(order), np.uint8)
    rank[order] = np.arange(len(order), dtype=np.int32)
    at = rank[at]
    ending[at] = np.concatenate(endings)
    learnt = np.repeat(table.column("train").combine_chunks().fill_null(False).to_numpy(zero_copy_only=False), size)
    count = np.bincount(at[learnt], minlength=len(keys)).astype(np.int64)
    blobs = {"slices": np.array([b - a for a, b in cuts], np.int64), "size": size.astype(np.int64), "at": at.astype(np.uint16 if len(keys) <= 1 << 16 else np.uint32), "keys": keys, "counts": count, "endings": ending}
    lists = {n: pa.array([table.column(n).to_pylist()], pa.list_(t)) for n, t in (("doc_id", pa.int64()), ("train", pa.bool_()))}
    return pa.table({"block": table.column("block")[:1], **lists, **{n: pa.array([x.tobytes()], pa.binary()) for n, x in blobs.items()}})


def _block_counts(buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("endings", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, count, ending in zip(B.column(batch, "keys", T.U), B.column(batch, "counts", np.int64), B.column(batch, "endings", np.uint8), strict=True):
                w = np.flatnonzero(count)
                yield pa.RecordBatch.from_pylist([{"bucket": n, **x} for n, x in B.pack({"keys": key[w], "counts": count[w], "endings": ending[w]}, _bucket(key[w], buckets), buckets)], schema=schema)

    return run


def _ask_words(buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, keys in zip(batch.column("block").to_pylist(), B.column(batch, "keys", T.U), strict=True):
                yield pa.RecordBatch.from_pylist([{"bucket": n, "block": no, **x} for n, x in B.pack({"keys": keys}, _bucket(keys, buckets), buckets)], schema=schema)

    return run


def _answer_words(table: pa.Table, words: pa.Table) -> pa.Table:
    keys, counts = (np.concatenate(x) if (x := B.column(words, n, t)) else np.zeros(0, t) for n, t in (("keys", T.U), ("counts", np.int64)))
    out = []
    for x in B.column(table, "keys", T.U):
        at = T.in_sorted(x, keys)
        out.append((np.where(at >= 0, counts[at], 0) if len(counts) else np.zeros(len(x), np.int64)).astype(np.int64))
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "counts": pa.array([x.tobytes() for x in out], pa.binary())})


def _score_block(held, buckets: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        info, p = held.value
        slices, size, keys, endings = (B.column(table, n, t)[0] for n, t in (("slices", np.int64), ("size", np.int64), ("keys", T.U), ("endings", np.uint8)))
        at = B.column(table, "at", np.uint16 if len(keys) <= 1 << 16 else np.uint32)[0]
        bucket, c = _bucket(keys, buckets), np.zeros(len(keys), np.int64)
        order = np.argsort(bucket, kind="stable")
        edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for n, x in zip(answers.column("bucket").to_pylist(), B.column(answers, "counts", np.int64), strict=True):
            c[order[edge[n] : edge[n + 1]]] = x
        n, v, place = info["class_tokens"].astype(float), info["class_words"], places(info)
        # of each distinct token: its class, and its probability within the class
        cls = classes_of(keys, endings, info)
        # within the class: counts less a discount; what that leaves is the unknown token's
        inside = np.where(c > 0, c - DISCOUNT, DISCOUNT * v[cls]) / np.maximum(n[cls], 1)
        # a frequent word and the end are their whole class; a class without known words is all unknown
        inside = np.log10(np.where((cls < own_words(info)) | (cls == len(n) - 1) | (v[cls] == 0), 1.0, inside))
        plain, seen = np.log10(c + 1.0), (c > 0).astype(np.int64)
        base, score, known = [], [], []
        docs = np.cumsum([0, *slices])
        tokens = np.concatenate([[0], np.cumsum(size)])
        for a, b in zip(docs[:-1], docs[1:], strict=True):
            t = at[tokens[a] : tokens[b]]
            first, own = tokens[a:b] - tokens[a], cls[t]
            whole = class_log10(place[contexts(own, info)], place[own], p) + inside[t]
            base.append(np.add.reduceat(plain[t], first) - size[a:b] * np.log10(info["tokens"] + info["words"] + 1))
            score.append(np.add.reduceat(whole, first))
            known.append(np.add.reduceat(seen[t], first))
        doc_id, train = (table.column(n).combine_chunks().flatten() for n in ("doc_id", "train"))
        return pa.table({"doc_id": doc_id, "train": train, "n_tokens": pa.array(size, pa.int64()), "n_known": pa.array(np.concatenate(known), pa.int64()), "train_tokens": pa.array(np.full(len(size), info["tokens"]), pa.int64()), "base_score": pa.array(np.concatenate(base)), "score": pa.array(np.concatenate(score))})

    return run


def score_texts(docs: DataFrame, train_col: str, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, train, n_tokens, n_known, train_tokens, base_score, score`` (log10); learns where ``train_col`` is true."""
    blocks = B.n_blocks(docs, text_col, block_bytes)
    spark = docs.sparkSession
    path = f"{B.checkpoint_dir(spark)}/indexed-{uuid.uuid4().hex}"
    B.blocked(docs, blocks, id_col, text_col, extra={"train": F.col(train_col)}).groupBy("block").applyInArrow(B.tidy(_index_block), INDEXED).write.parquet(path)
    indexed = spark.read.parquet(path)
    words = _summed(indexed.select("keys", "counts", "endings").mapInArrow(B.tidy_batches(_block_counts(blocks)), "bucket int, keys binary, counts binary, endings binary"))
    info = summary(words)
    train = docs.where(F.col(train_col)).select(F.col(text_col).alias("text"))
    held = spark.sparkContext.broadcast((info, fit(train, info, rounds)))
    asked = indexed.select("block", "keys").mapInArrow(B.tidy_batches(_ask_words(blocks)), "bucket int, block int, keys binary")
    answers = asked.groupBy("bucket").cogroup(words.select("bucket", "keys", "counts").groupBy("bucket")).applyInArrow(_answer_words, "block int, bucket int, counts binary")
    told = indexed.select("block", "doc_id", "train", "slices", "size", "at", "keys", "endings").groupBy("block")
    return told.cogroup(answers.groupBy("block")).applyInArrow(_score_block(held, blocks), "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
