"""Best-two-fit packing of documents into fixed-length sequences.

Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the
driver.  The plan works on lengths with their counts: fill a bin greedily with
the longest pieces that fit, then try to replace the bin's smallest piece with two
unpacked pieces that fit the widened gap more tightly; the bin found is repeated
as often as its lengths allow.  So the plan is a short list of bin patterns
whatever the number of documents.  Pieces are numbered inside each length (counts
per length and hash slice, prefix sums, then ranks inside a slice, so a frequent
length is never one task) and take the pattern slot of their number.

Null texts are empty documents (only the end id).  Repeated or null doc ids are
separate documents; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm import _text as T
from parcelspark.llm._blocks import checkpoint_dir, tidy_batches

CAPACITY = 2048
SLICE_ROWS = 500
ENCODE_BYTES = 1 << 20  # of text encoded at a time


def plan_patterns(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Bin patterns ``(lengths in a bin, repeats)`` that use up ``counts[length]`` pieces of each length."""
    left = np.array(counts, np.int64)
    out: list[tuple[list[int], int]] = []
    while True:
        have = np.flatnonzero(left)
        have = have[have > 0]
        if not len(have):
            return out
        one, room = [], capacity
        spare = left.copy()
        longest = int(have[-1])
        while longest:  # greedily: the longest piece that fits
            one.append(longest)
            spare[longest] -= 1
            room -= longest
            fit = np.flatnonzero(spare[: room + 1])
            longest = int(fit[-1]) if len(fit) else 0
        if room and len(one) > 1:  # swap the smallest for two that leave less room
            small = one[-1]
            gap = room + small
            can = np.flatnonzero(spare[: gap + 1])
            can = can[can > 0]
            best = (0, 0)
            if len(can):
                # for each first length the longest second one that still fits
                second = can[np.maximum(np.searchsorted(can, gap - can, side="right") - 1, 0)]
                ok = (can + second <= gap) & ((second != can) | (spare[can] > 1))
                if (~ok).any():  # one piece only of that length: the next shorter one
                    prev = np.where(np.searchsorted(can, second) > 0, can[np.maximum(np.searchsorted(can, second) - 1, 0)], gap + 1)
                    second = np.where(ok, second, prev)
                    ok = (can + second <= gap) & ((second != can) | (spare[can] > 1))
                if ok.any():
                    i = int(np.argmax(np.where(ok, can + second, -1)))
                    best = (int(can[i]), int(second[i]))
            if sum(best) > small:
                one = [*one[:-1], *sorted(best, reverse=True)]
        size, n = np.unique(one, return_counts=True)
        times = int((left[size] // n).min())
        left[size] -= n * times
        out.append((one, times))


def tokenize_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids: ``doc_id, piece, start, length, ids`` (little-endian, ids as narrow as the vocabulary allows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from parcelspark.llm._tokens import encoder

        enc = encoder(tokenizer)
        for batch in batches:
            data, off = T.buffer_of(batch.column(1))
            for a, b in T.slices(off, ENCODE_BYTES):
                ids, o = enc.encode(data[off[a] : off[b]], off[a : b + 1] - off[a])
                rows: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids": [], "ids_crc32": []}
                for k, doc in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                    own = np.append(ids[o[k] : o[k + 1]], enc.dtype.type(end_id))
                    for p, s in enumerate(range(0, len(own), capacity)):
                        x = own[s : s + capacity]
                        for c, v in zip(rows.values(), (doc, p, s, len(x), x.tobytes(), zlib.crc32(x.astype("<u4"))), strict=True):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(rows["doc_id"], pa.int64()), pa.array(rows["piece"], pa.int32()), pa.array(rows["start"], pa.int64()), pa.array(rows["length"], pa.int64()), pa.array(rows["ids"], pa.binary()), pa.array(rows["ids_crc32"], pa.int64())], names=list(rows))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy_batches(run), "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset``."""
    spark = docs.sparkSession
    path = f"{checkpoint_dir(spark)}/pack-{uuid.uuid4().hex}"
    # written once: the pieces are numbered in a second pass, and encoding is the dear part
    tokenize_pieces(docs, tokenizer, capacity, end_id, id_col, text_col).write.option("compression", "zstd").parquet(path)
    pieces = spark.read.parquet(path)
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["count"]
    patterns = plan_patterns(counts, capacity)
    # slots of each length, pattern by pattern: (length, first number, uses in a bin, first bin, offsets in the bin)
    slots, used, bins = [], np.zeros(capacity + 1, np.int64), 0
    for one, times in patterns:
        at = np.cumsum([0, *one[:-1]])
        for size in sorted(set(one)):
            places = [int(o) for o, n in zip(at, one, strict=True) if n == size]
            slots.append((size, int(used[size]), len(places), bins, places))
            used[size] += len(places) * times
        bins += times
    # every pattern but the last of a length uses it up or ends another length: the list is bounded by the capacity, not by the rows
    first = {}
    for size, start, per, bin0, places in slots:
        first.setdefault(size, []).append((start, per, bin0, places))
    held = spark.sparkContext.broadcast({k: ([s[0] for s in v], v) for k, v in first.items()})
    # slices by each length's own count: rare lengths have one, so the table of sums shrinks with them; at most ``capacity`` lengths
    cut = [{"length": int(n), "slices": int(-(-int(counts[n]) // slice_rows))} for n in np.flatnonzero(counts)]
    slices = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(cut)), "array<struct<length long, slices int>>")).alias("s")).select("s.*")
    keyed = pieces.join(F.broadcast(slices), "length").withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("slices")).cast("int"))
    sums = keyed.groupBy("length", "slice").count()
    # prefix sums in two levels: within a thousand slices, and over the thousands of a length
    sums = sums.withColumn("thousand", F.floor(F.col("slice") / 1000))
    ahead = lambda keys, by: F.sum("count").over(Window.partitionBy(*keys).orderBy(by)) - F.col("count")
    above = sums.groupBy("length", "thousand").agg(F.sum("count").alias("count")).select("length", "thousand", ahead(["length"], "thousand").alias("above"))
    within = sums.select("length", "thousand", "slice", ahead(["length", "thousand"], "slice").alias("within"))
    before = within.join(above, ["length", "thousand"]).select("length", "slice", (F.col("above") + F.col("within")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = keyed.withColumn("rank", rank).join(before, ["length", "slice"]).select("doc_id", "piece", "start", "length", "ids", "ids_crc32", (F.col("rank") - 1 + F.col("before")).cast("long").alias("number"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            seq, off = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for n in np.unique(size):  # at most ``capacity`` lengths
                at = np.flatnonzero(size == n)
                starts, own = held.value[n.item()]
                which = np.searchsorted(starts, number[at], side="right") - 1
                for k in np.unique(which):
                    rows = at[which == k]
                    start, per, bin0, places = own[k]
                    seq[rows] = bin0 + (number[rows] - start) // per
                    off[rows] = np.array(places, np.int64)[(number[rows] - start) % per]
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(seq, pa.int64()), pa.array(off, pa.int64())], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(tidy_batches(place), "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, sequence_id long, offset long")
