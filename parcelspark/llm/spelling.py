"""Spelling variants by permuterm rotations.

Words are counted over all texts; then every word, marked with a terminator, is written in all
its rotations.  The rotation behind a character of the word ends in that character, so all words
that differ from it in this one place share the rotation's prefix, and the word without it is that
prefix itself.  Rotations are sorted by those prefixes and scanned group by group: a group holds
the words that fit with one character in the skipped place (at most as many as the alphabet has)
and the word that fits without.  A group sends each member the number of its near words and the
best of them, never the pairs, so the scan stays linear in the rotations.

A character that equals the one before it is skipped by replacement only: taking either out gives
the same word, which counts once.

Chains of forms are followed by pointer doubling over written tables.  Each form has at least
``ratio`` times the count of its word, so chains end and their length is the logarithm of the count.

Null texts have no words; a null id is written as the empty text before the colon; repeated rows
count as often as they occur.  Ties go to the smaller word in code-point order.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm import _blocks as B
from parcelspark.llm import _text as T

MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
END = "$"  # no word holds it
STEP_BYTES = 4 << 20


# ---- CRC-32 of "<id>:<word>" for all occurrences at once

CRC_POLYNOMIAL = 0xEDB88320  # fixed value: the reflected polynomial of CRC-32


def _apply(columns: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits (the images of single bits) on each value."""
    out = np.zeros(len(values), np.uint32)
    for bit in range(32):
        out ^= np.where((values >> np.uint32(bit)) & np.uint32(1), columns[bit], np.uint32(0)).astype(np.uint32)
    return out


@lru_cache(maxsize=64)
def _zero_bytes(power: int) -> np.ndarray:
    """What 2**power zero bytes do to a CRC."""
    if power:
        half = _zero_bytes(power - 1)
        return _apply(half, half)
    columns = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(8):
        columns = np.where(columns & np.uint32(1), (columns >> np.uint32(1)) ^ np.uint32(CRC_POLYNOMIAL), columns >> np.uint32(1)).astype(np.uint32)
    return columns


@lru_cache(maxsize=4096)
def _shift(length: int) -> np.ndarray:
    """Tables, one for each byte of a CRC, of what ``length`` more bytes do to it."""
    columns, power = np.uint32(1) << np.arange(32, dtype=np.uint32), 0
    while length >> power:
        if length >> power & 1:
            columns = _apply(_zero_bytes(power), columns)
        power += 1
    byte = np.arange(256, dtype=np.uint32)
    return np.stack([_apply(columns, byte << np.uint32(8 * k)) for k in range(4)])


def joined_crc(heads: np.ndarray, tails: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each head followed by its tail, from the CRCs of both and the tails' lengths in bytes."""
    kinds, kind = np.unique(lengths, return_inverse=True)
    tables = np.stack([_shift(int(n)) for n in kinds]) if len(kinds) else np.zeros((0, 4, 256), np.uint32)
    out = tails.astype(np.uint32)
    for k in range(4):
        out = out ^ tables[kind, k, (heads >> np.uint32(8 * k)) & np.uint32(255)]
    return out


# ---- words and their counts


def letters(data: np.ndarray) -> np.ndarray:
    """Bytes of A-Z, a-z and U+00C0 to U+00FF (in UTF-8 the byte C3 and the one behind it)."""
    low = data | np.uint8(0x20)
    ok = (low >= 0x61) & (low <= 0x7A)
    two = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0xBF))
    ok[two] = ok[two + 1] = True
    return ok


def _spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    off = np.concatenate([[0], np.cumsum(size)])
    pos = np.arange(int(off[-1])) + np.repeat(start - off[:-1], size)
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data[pos].tobytes())])


def slice_counts(ids: list[str], data: np.ndarray, off: np.ndarray, min_length: int, drop_one_in: int) -> Counter:
    """Words of at least ``min_length`` code points and their counts in a slice of texts."""
    data = T.lower(data)
    start, end, doc = T.mask_spans(letters(data), off)
    found = _spans(data, start, end).dictionary_encode()
    code, words = np.asarray(found.indices), found.dictionary
    points = np.asarray(pc.utf8_length(words)).astype(np.int64)
    text = words.to_pylist()
    out: Counter = Counter()
    left = np.ones(len(code), bool)
    if drop_one_in:
        heads = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
        tails = np.array([zlib.crc32(w.encode()) for w in text], np.uint32)
        h = joined_crc(heads[doc], tails[code], (end - start))
        left = h % np.uint32(drop_one_in) != 0
        changed = Counter(zip(code[~left].tolist(), (h[~left].astype(np.int64) % points[code[~left]]).tolist(), strict=True))
        for (c, at), n in changed.items():
            if points[c] > min_length:
                out[text[c][:at] + text[c][at + 1 :]] += n
    many = np.bincount(code[left], minlength=len(words))
    for c in np.flatnonzero((many > 0) & (points >= min_length)):
        out[text[c]] += int(many[c])
    return out


def _counts(min_length: int, drop_one_in: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = T.buffer_of(batch.column("text"))
            ids = batch.column("id").to_pylist()
            for a, b in T.slices(off, STEP_BYTES):
                got = slice_counts(ids[a:b], data[off[a] : off[b]], off[a : b + 1] - off[a], min_length, drop_one_in)
                yield pa.RecordBatch.from_pydict({"word": pa.array(list(got), pa.string()), "n": pa.array(list(got.values()), pa.int64())})

    return run


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop_one_in: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: lower-cased (A-Z) runs of letters.  With ``drop_one_in`` m, an occurrence whose CRC-32 h of
    ``<id>:<word>`` is a multiple of m loses its code point number h modulo its length, as a typing error would."""
    given = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = given.mapInArrow(_counts(min_length, drop_one_in), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- near words


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, word, n, skipped, head``: each word under the prefix of each of its rotations, and as a whole rotation.

    ``skipped`` is true where the word's character behind the prefix is left out; ``head`` where it differs from the one before it."""
    i = F.col("i")
    turned = words.withColumn("i", F.explode(F.sequence(F.lit(0), F.length("word"))))  # i characters stand in front
    behind = F.concat(F.expr("substring(word, i + 1)"), F.lit(END), F.expr("substring(word, 1, i)"))
    short = F.concat(F.expr("substring(word, i + 1)"), F.lit(END), F.expr("substring(word, 1, i - 1)"))
    fields = [F.col("word"), F.col("n")]
    whole = F.struct(behind.alias("prefix"), *fields, F.lit(False).alias("skipped"), F.lit(False).alias("head"))
    head = (i == 1) | (F.expr("substring(word, i, 1)") != F.expr("substring(word, i - 1, 1)"))
    cut = F.struct(short.alias("prefix"), *fields, F.lit(True).alias("skipped"), head.alias("head"))
    return turned.select(F.inline(F.when(i > 0, F.array(whole, cut)).otherwise(F.array(whole))))


def scan_groups(turned: DataFrame) -> DataFrame:
    """``word, near, best`` for each member of each group of two or more: its near words there and the best of them.

    ``best`` is (-n, word), so the least one has the largest count and then the smallest word."""
    key = F.struct((-F.col("n")).alias("o"), F.col("word").alias("w"), F.col("head").alias("h"))
    groups = turned.groupBy("prefix").agg(
        F.sort_array(F.collect_list(F.when(F.col("skipped"), key))).alias("m"),  # at most one for each letter
        F.max(F.when(~F.col("skipped"), key)).alias("f"),  # the one word that is the prefix
    )
    groups = groups.where((F.size("m") > 1) | ((F.size("m") == 1) & F.col("f").isNotNull()))
    bare = lambda s: F.struct(s["o"].alias("o"), s["w"].alias("w"))
    full = F.col("f")
    others = lambda x, j: F.struct(
        x["w"].alias("word"),
        (F.size("m") - 1 + F.when(x["h"] & full.isNotNull(), 1).otherwise(0)).cast("long").alias("near"),
        F.least(F.when(F.size("m") > 1, bare(F.get("m", F.when(j == 0, 1).otherwise(0)))), F.when(x["h"] & full.isNotNull(), bare(full))).alias("best"),
    )
    heads = F.filter("m", lambda x: x["h"])
    own = F.struct(full["w"].alias("word"), F.size(heads).cast("long").alias("near"), F.when(F.size(heads) > 0, bare(F.get(heads, F.lit(0)))).alias("best"))
    sent = F.concat(F.transform("m", others), F.when(full.isNotNull(), F.array(own)).otherwise(F.array().cast("array<struct<word:string,near:bigint,best:struct<o:bigint,w:string>>>")))
    return groups.select(F.inline(sent)).where("near > 0")


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for each row of ``words(word, n)``, whose words differ."""
    spark = words.sparkSession
    base = f"{B.checkpoint_dir(spark)}/spelling-{uuid.uuid4().hex}"
    words.select("word", "n").write.parquet(f"{base}/words")
    words = spark.read.parquet(f"{base}/words")
    near = scan_groups(rotations(words)).withColumn("n", F.lit(None).cast("long"))
    alone = words.select("word", F.lit(0).cast("long").alias("near"), F.lit(None).cast("struct<o:bigint,w:string>").alias("best"), "n")
    found = near.unionByName(alone).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    follows = -F.col("best.o") >= ratio * F.col("n")
    found.select("word", "n", "n_near", F.when(follows, F.col("best.w")).alias("form"), F.when(follows, -F.col("best.o")).alias("form_n")).write.parquet(f"{base}/near")
    found = spark.read.parquet(f"{base}/near")
    # pointer doubling: after step s a word points 2**s forms ahead, or to its root
    jumps, step = found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), 0
    while True:
        jumps.write.parquet(f"{base}/roots-{step}")
        jumps = spark.read.parquet(f"{base}/roots-{step}")
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if jumps.join(ahead, "root", "left_semi").isEmpty():
            break
        jumps, step = jumps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), step + 1
    return found.join(jumps, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, drop_one_in: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return group_variants(count_words(docs, min_length, min_count, drop_one_in, id_col, text_col), ratio)
