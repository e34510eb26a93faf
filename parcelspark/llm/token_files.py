"""Token-ID files: flat little-endian unsigned integers plus 64-bit document offsets.

Documents are range-partitioned by id, so that part files in order hold ascending
ids.  A task writes ``part-N.bin`` (ids, 2 bytes each if the vocabulary fits,
else 4) and ``part-N.idx`` (header, doc ids, offsets), each under a name of its
attempt and then moved, so a retried or speculative task leaves the same files.
Only one row per part reaches the driver; bases are the prefix sums of the parts'
token counts and stand in ``manifest.json``.  Readers map the files into memory
(or read them where the store has no local path).

A null text is an empty document; every document ends with ``end_id``.  Null ids
come first, repeated ids stay separate documents (ordered by a hash of the text),
an empty table gives a manifest without parts.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm import _text as T
from parcelspark.llm._blocks import n_blocks

MAGIC = b"TOKIDX01"
PART_BYTES = 16 << 20
NULL_ID = -(2**63)


def _store(uri: str):
    """(file system, path) of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def _put(store, path: str, data) -> None:
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(temp) as f:
        f.write(data)
    store.move(temp, path)


def _write_part(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from parcelspark.llm._tokens import encoder

        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        store, base = _store(folder)
        docs, sizes, total = [], [], 0
        temp = f"{base}/part-{part:06d}.bin.{uuid.uuid4().hex}.tmp"
        out = store.open_output_stream(temp)
        with out:
            for batch in batches:
                data, off = T.buffer_of(batch.column(1))
                docs.append(np.array([NULL_ID if x is None else x for x in batch.column(0).to_pylist()], "<i8"))
                for a, b in T.slices(off, 4 << 20):
                    ids, o = enc.encode(data[off[a] : off[b]], off[a : b + 1] - off[a])
                    n = np.diff(o) + 1
                    flat = np.full(len(ids) + len(n), end_id, enc.dtype)
                    keep = np.ones(len(flat), bool)
                    keep[np.cumsum(n) - 1] = False
                    flat[keep] = ids
                    out.write(flat.tobytes())
                    sizes.append(n)
                    total += len(flat)
        if not docs:
            store.delete_file(temp)
            return
        store.move(temp, f"{base}/part-{part:06d}.bin")
        docs, offsets = np.concatenate(docs), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype("<i8")
        head = np.array([enc.dtype.itemsize, len(docs)], "<i8")
        _put(store, f"{base}/part-{part:06d}.idx", MAGIC + head.tobytes() + docs.tobytes() + offsets.tobytes())
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "docs": pa.array([len(docs)], pa.int64()), "tokens": pa.array([total], pa.int64())})

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES) -> list[dict]:
    """Encode every text, write the files into ``folder`` (shared by all executors) and return the manifest's parts."""
    store, base = _store(folder)
    store.create_dir(base, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = n_blocks(rows, "text", part_bytes)
    # the hash of the text spreads one id that many rows share
    key = [F.col("doc_id"), F.xxhash64("text")]
    made = rows.repartitionByRange(parts, *key).sortWithinPartitions(*key).mapInArrow(_write_part(folder, tokenizer, end_id), "part int, docs long, tokens long").collect()
    found, start = [], 0
    for r in sorted(made, key=lambda r: r["part"]):
        found.append({"part": r["part"], "docs": r["docs"], "tokens": r["tokens"], "start": start})
        start += r["tokens"]
    _put(store, f"{base}/manifest.json", json.dumps({"parts": found}).encode())
    return found


def map_part(folder: str, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, doc ids, offsets) of one part; the ids are mapped, not read, where the store is local."""
    from pyarrow import fs

    store, base = _store(folder)
    with store.open_input_stream(f"{base}/part-{part:06d}.idx") as f:
        raw = f.read()
    if raw[:8] != MAGIC:
        raise ValueError(f"part {part} in {folder}: not an index file")
    width, n = np.frombuffer(raw, "<i8", 2, 8)
    docs, offsets = np.frombuffer(raw, "<i8", n, 24), np.frombuffer(raw, "<i8", n + 1, 24 + 8 * n)
    name = f"{base}/part-{part:06d}.bin"
    if isinstance(store, fs.LocalFileSystem):
        ids = np.memmap(name, f"<u{width}", "r") if offsets[-1] else np.zeros(0, f"<u{width}")
    else:
        with store.open_input_stream(name) as f:
            ids = np.frombuffer(f.read(), f"<u{width}")
    return ids, docs, offsets


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document, from the files."""
    store, base = _store(folder)
    with store.open_input_stream(f"{base}/manifest.json") as f:
        parts = json.loads(f.read())["parts"]
    listed = spark.createDataFrame([(p["part"], p["start"]) for p in parts], "part int, start long").repartition(max(1, len(parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, docs, off = map_part(folder, part)
                for a in range(0, len(docs), 2000):
                    b = min(len(docs), a + 2000)
                    each = [ids[i:j].astype("<u4") for i, j in zip(off[a:b], off[a + 1 : b + 1], strict=True)]
                    cols = {"doc_id": pa.array(docs[a:b], mask=docs[a:b] == NULL_ID), "start": pa.array(off[a:b] + start), "n_tokens": pa.array(np.diff(off[a : b + 1])), "ids_crc32": pa.array([zlib.crc32(x) for x in each], pa.int64())}
                    if with_ids:
                        cols["ids"] = pa.array([x.astype(np.int64) for x in each], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(cols)

    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
