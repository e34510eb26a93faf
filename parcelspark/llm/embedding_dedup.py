"""Embedding near-duplicates by PCA-ordered tiled comparison.

Equal vectors of a label are one row with a count.  Unit vectors are rotated to
the principal axes of all vectors (a rotation keeps every product), sorted by
label and first axis, and cut into tiles.  Linked vectors are at most
``sqrt(2 - 2 t)`` apart, so only tiles of a label whose ranges on the first axis come
that close are compared; they find each other by bins of that axis.  A pair of tiles accumulates products over leading axes
first; a pair of vectors goes on only while its sum so far plus the product of
the rest norms can still reach the threshold.  What is left is checked in double
precision on the vectors themselves.

A pair of tiles returns link counts and a spanning forest of its links, never
all links.  The comparison within a label is quadratic where the first axis does
not separate it; labels are dealt as tiles, so none is one task.

Null labels, null or zero vectors, and vectors with null or non-finite parts link
with nothing.  Vectors of different lengths are not compared.  Rows that share a
``vec_id`` count as rows; the id joins them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm import _blocks as B
from parcelspark.llm._components import components

THRESHOLD = 0.98
BINS = 8  # of the first axis, to the distance at which tiles are too far apart to link
TILE = 1024
LEADING = (8, 24)
SLACK = 1e-9


def _matrix(col, dim: int) -> np.ndarray:
    return np.asarray(col.combine_chunks().flatten() if isinstance(col, pa.ChunkedArray) else col.flatten(), np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    dims = np.asarray(batch.column("dim"))
    for d in np.unique(dims):
        yield int(d), np.flatnonzero(dims == d)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for d, at in _by_dim(batch):
            u = unit(_matrix(batch.column("embedding").take(pa.array(at)), d))
            sums[d] = sums.get(d, 0) + u.T @ u
    part = TaskContext.get().partitionId() % 64
    for d, m in sums.items():
        yield pa.RecordBatch.from_pydict({"dim": pa.array([d], pa.int32()), "part": pa.array([part], pa.int32()), "m": pa.array([m.tobytes()], pa.binary())})


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("m"))
    return pa.table({"dim": table.column("dim")[:1], "part": table.column("part")[:1], "m": pa.array([total.tobytes()], pa.binary())})


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length an orthogonal basis, strongest axis first (one small matrix per length reaches the driver)."""
    schema = "dim int, part int, m binary"
    own = vectors.select("dim", "embedding").mapInArrow(_moments, schema)
    got = own.groupBy("dim", "part").applyInArrow(_add, schema).groupBy("dim").applyInArrow(_add, schema).collect()
    return {r["dim"]: np.linalg.eigh(np.frombuffer(r["m"], np.float64).reshape(r["dim"], r["dim"]))[1][:, ::-1] for r in got}


def _first_axis(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            axis = np.zeros(batch.num_rows)
            for d, at in _by_dim(batch):
                axis[at] = unit(_matrix(batch.column("embedding").take(pa.array(at)), d)) @ held.value[d][:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(axis)], names=[*batch.schema.names, "axis"])

    return run


def _cut_tiles(tile: int):
    """Sorted rows to tiles of one label and length each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n, kept = TaskContext.get().partitionId(), 0, None

        def packed(t: pa.Table) -> pa.RecordBatch:
            nonlocal n
            n += 1
            axis = t.column("axis").to_numpy()
            cols = {"label": t.column("label")[0].as_py(), "dim": t.column("dim")[0].as_py(), "tile": part * (1 << 32) + n, "lo": float(axis.min()), "hi": float(axis.max())}
            blobs = {"ids": t.column("rep").to_numpy().tobytes(), "copies": t.column("copies").to_numpy().tobytes(), "vectors": _matrix(t.column("embedding"), cols["dim"]).tobytes()}
            types = (pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), *[pa.binary()] * 3)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((cols | blobs).values(), types, strict=True)], names=list(cols | blobs))

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([kept, t]) if kept is not None else t
            key = list(zip(t.column("label").to_pylist(), t.column("dim").to_pylist(), strict=True))
            start = 0
            for i in range(1, len(key) + 1):
                if i == len(key) or key[i] != key[start] or i - start == tile:
                    if i == len(key) and i - start < tile:
                        break
                    yield packed(t.slice(start, i - start))
                    start = i
            kept = t.slice(start) if start < len(key) else None
        if kept is not None and kept.num_rows:
            yield packed(kept)

    return run


def linked_pairs(a: np.ndarray, b: np.ndarray, basis: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine of at least ``threshold``, by leading axes with the bound of the rest norms."""
    ua, ub = unit(a), unit(b)
    ra, rb = ua @ basis, ub @ basis
    dim = a.shape[1]
    cuts = [c for c in LEADING if c < dim] or [dim]
    c = cuts[0]
    rest = lambda x, k: np.sqrt(np.maximum((x[:, k:] ** 2).sum(axis=1), 0))
    total = ra[:, :c] @ rb[:, :c].T
    i, j = np.nonzero(total + np.outer(rest(ra, c), rest(rb, c)) >= threshold - SLACK)
    total = total[i, j]
    for c0, c1 in zip(cuts, [*cuts[1:], dim], strict=True):
        sa, sb = rest(ra, c1), rest(rb, c1)
        keep, sums = [], []
        for s in range(0, len(i), 1 << 18):
            x, y = i[s : s + (1 << 18)], j[s : s + (1 << 18)]
            t = total[s : s + (1 << 18)] + np.einsum("ij,ij->i", ra[x, c0:c1], rb[y, c0:c1])
            ok = t + sa[x] * sb[y] >= threshold - SLACK
            keep.append(np.flatnonzero(ok) + s)
            sums.append(t[ok])
        at = np.concatenate(keep) if keep else np.zeros(0, np.int64)
        i, j, total = i[at], j[at], np.concatenate(sums) if sums else total
    exact = np.concatenate([np.einsum("ij,ij->i", ua[i[s : s + (1 << 18)]], ub[j[s : s + (1 << 18)]]) for s in range(0, len(i), 1 << 18)] or [np.zeros(0)])
    ok = exact >= threshold
    return i[ok], j[ok]


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars with the same components as the links (u, v)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[label[far]], nodes[far]


def _compare(held, threshold: float):
    schema = pa.schema([("vec", pa.int64()), ("n", pa.int64()), ("other", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                d = r["dim"]
                ia, ib = (np.frombuffer(r[k], np.int64) for k in ("ids", "ids2"))
                ca, cb = (np.frombuffer(r[k], np.int64) for k in ("copies", "copies2"))
                a, b = (np.frombuffer(r[k], np.float64).reshape(-1, d) for k in ("vectors", "vectors2"))
                i, j = linked_pairs(a, b, held.value[d], threshold)
                if r["tile"] == r["tile2"]:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                na, nb = np.bincount(i, cb[j], len(ia)).astype(np.int64), np.bincount(j, ca[i], len(ib)).astype(np.int64)
                p, q = spanning(ia[i], ib[j])
                vec = np.concatenate([ia[na > 0], ib[nb > 0], q])
                n = np.concatenate([na[na > 0], nb[nb > 0], np.zeros(len(q), np.int64)])
                other = np.concatenate([np.full(len(vec) - len(q), -1), p])
                mask = np.arange(len(vec)) < len(vec) - len(q)
                yield pa.RecordBatch.from_arrays([pa.array(vec), pa.array(n), pa.array(other, mask=mask)], schema=schema)

    return run


def embedding_components(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    spark = vectors.sparkSession
    base = f"{B.checkpoint_dir(spark)}/embeddings-{uuid.uuid4().hex}"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    classes = rows.where(good).groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = classes.withColumn("dim", F.size("embedding"))
    classes.write.parquet(f"{base}/classes")
    classes = spark.read.parquet(f"{base}/classes")
    axes = spark.sparkContext.broadcast(principal_axes(classes))
    n = classes.count()
    key = ["label", "dim", "axis", "rep"]
    schema = classes.select("label", "embedding", "rep", "copies", "dim").schema.add("axis", "double")
    placed = classes.select("label", "embedding", "rep", "copies", "dim").mapInArrow(_first_axis(axes), schema)
    tiles = placed.repartitionByRange(max(1, n // (8 * tile)), *key).sortWithinPartitions(*key).mapInArrow(_cut_tiles(tile), "label string, dim int, tile long, lo double, hi double, ids binary, copies binary, vectors binary")
    tiles.write.parquet(f"{base}/tiles")
    tiles = spark.read.parquet(f"{base}/tiles")
    second = tiles.select("label", "dim", *[F.col(c).alias(f"{c}2") for c in ("tile", "lo", "hi", "ids", "copies", "vectors")])
    apart = float(np.sqrt(2 - 2 * threshold) + 1e-9)
    # ranges meet in narrow bins of the first axis: the later one (by its low end) stands in the bin of that end alone,
    # the earlier one in all bins from its low end to its high end and the distance beyond it, so a near pair meets once
    width = max(apart, 0.05) / BINS
    cell = lambda x: F.floor(x / width).cast("int")
    names = ("label", "dim", "tile", "tile2")
    earlier = tiles.select("label", "dim", "tile", "lo", "hi", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") + apart))).alias("bin"))
    later = second.select("label", "dim", "tile2", "lo2", "hi2", cell(F.col("lo2")).alias("bin"))
    near = (F.struct("lo", "tile") <= F.struct(F.col("lo2").alias("lo"), F.col("tile2").alias("tile"))) & (F.col("lo2") - F.col("hi") <= apart)
    ranges = earlier.join(later, ["label", "dim", "bin"]).where(near).select(*names)
    paired = ranges.join(tiles.select("tile", "ids", "copies", "vectors"), "tile").join(second.select("tile2", "ids2", "copies2", "vectors2"), "tile2")
    paired.select("dim", "tile", "tile2", "ids", "ids2", "copies", "copies2", "vectors", "vectors2").mapInArrow(_compare(axes, threshold), "vec long, n long, other long").write.parquet(f"{base}/links")
    links = spark.read.parquet(f"{base}/links")
    counted = links.where("other is null").groupBy(F.col("vec").alias("rep")).agg(F.sum("n").alias("linked"))
    part = components(links.where("other is not null").select(F.col("other").alias("a"), F.col("vec").alias("b"))).withColumnRenamed("node", "rep")
    own = classes.join(counted, "rep", "left").join(part, "rep", "left").select("label", "embedding", "rep", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    # rows that cannot link carry a null label into the join, so they match nothing
    marked = rows.select("vec_id", F.when(good, F.col("label")).alias("label"), "embedding")
    joined = marked.join(own, ["label", "embedding"], "left")
    result = joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
