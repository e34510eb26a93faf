"""Documents in hashed blocks that ask hashed buckets about their keys.

A *block* holds a bounded number of text bytes (documents are dealt by a hash of
their id), so a block's distinct keys can be found in one task.  Each block
sends every distinct key once, packed per *bucket* of the key space; a bucket
sees each key at most once from each block, however many documents hold it, so
no key, source or group of copies makes a hot task.  Buckets answer the blocks.
Text is exchanged once: every pass uses the same exchange.
"""

from __future__ import annotations

import ctypes
import gc
import inspect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20


def checkpoint_dir(spark) -> str:
    """The shared folder that the session names; an error when there is none."""
    where = spark.conf.get("spark.checkpoint.dir", None) or (spark.sparkContext.getCheckpointDir() or None)
    if not where:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(where)
    return where


def n_blocks(docs: DataFrame, text_col: str, block_bytes: int) -> int:
    """Blocks in proportion to the text bytes."""
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    return int(max(1, -(-total // block_bytes)))


def blocked(docs: DataFrame, blocks: int, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, text, block``, the ``extra`` columns (and rest of the row as ``row`` when ``carry``)."""
    cols = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    if carry:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"))
    cols += [c.alias(n) for n, c in (extra or {}).items()]
    # a null id is spread by its text, so that many of them fill many blocks
    spread = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.col(text_col)))
    return docs.select(*cols, F.pmod(spread, F.lit(blocks)).cast("int").alias("block"))


def pack(arrays: dict[str, np.ndarray], bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, dict[str, bytes]]]:
    """Each bucket's share of parallel arrays, in their order, as bytes."""
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
    arrays = {k: v[order] for k, v in arrays.items()}
    for b in np.flatnonzero(np.diff(edge)):
        yield int(b), {k: v[edge[b] : edge[b + 1]].tobytes() for k, v in arrays.items()}


def rows(schema: pa.Schema, found: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(found, schema=schema)


def tidy(fn: Callable) -> Callable:
    """``fn``, after which the worker gives the memory that it has freed back to the system.

    Workers serve many tasks; without this, what a block's arrays took stays with each of them."""

    def run(*tables):
        out = fn(*tables)
        give_back()
        return out

    # Spark looks at the number of arguments (a group, or both sides of a cogroup)
    return (lambda left, right: run(left, right)) if len(inspect.signature(fn).parameters) == 2 else (lambda table: run(table))


def tidy_batches(fn: Callable) -> Callable:
    """:func:`tidy` for a function of batches: memory goes back after each batch that comes out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(batches):
            yield out
            del out
            give_back()
        give_back()

    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def per_bucket(asked: DataFrame, answer: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return asked.groupBy("bucket").applyInArrow(tidy(answer), schema)


def column(table: pa.Table, name: str, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), dtype) for x in table.column(name)]


def release(spark) -> None:
    """Let Spark delete the shuffle files of finished jobs: it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
