"""Exact top-k inner-product search by columnar branch and bound.

Components become integers, ``floor(scale * x)``.  Vectors lie in *tiles*, written column
by column (all first components, then all second ones, ...).  Query rows are taken from
the written tiles, so a query knows its own place, and every one meets every tile:

1. Dimensions are taken in the order of their mass (the sum of squares over all rows).
2. A tile adds up products one block of dimensions at a time.  A candidate can still gain
   at most the product of the two rest norms; whoever cannot reach the query's k-th best
   score so far is left out: columns that no query of the block needs go first, and once
   few pairs survive they go on as a compact list.
3. Each group of queries first scans one group of tiles; the k-th best score found there is
   its floor for all others, which then run at the same time.

Sums are exact: in double precision while they stay below 2**53, else as Python integers
(scores beyond a long are cut to its range, and then tie).

A vector takes no part when it is null, holds a null or non-finite component, or overflows
when scaled.  A shorter vector counts as zero beyond its end; an empty one is a zero vector.
Rows are rows: of equal rows each is a candidate for the others and a query of its own.  A
null id is no query and ranks behind all other ids in a tie.  An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm import _blocks as B
from parcelspark.llm import _text as T

TILE_BYTES = 1 << 20  # of 4-byte components
TILE_GROUP_BYTES = 32 << 20
QUERY_GROUP_BYTES = 8 << 20
QUERY_ROWS = 512
FIRST_BLOCK = 8  # dimensions of the first block; every next one is twice as wide
SPARSE = 0.05  # share of surviving pairs below which they go on as a list
EXACT = float(1 << 53)
LONG = (1 << 63) - 1
TILES = "tile long, n int, dim int, wide boolean, norm double, mass array<double>, ids binary, asks binary, data binary"
BLOCKS = "tile long, n int, dim int, norm double, ids binary, slots binary, data binary"
FOUND = "tile long, slot int, query_id long, vec_id long, score long"
KINDS = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, KINDS[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _integers(col, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows take part, their scaled components padded with zeros to one width)."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    size = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(col), 0)).astype(np.int64)
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(flat * scale)
    row = np.repeat(np.arange(len(size)), size)
    ok = np.asarray(col.is_valid()) & (np.bincount(row, ~np.isfinite(flat), len(size)) == 0)
    width = int(size[ok].max(initial=0))
    out = np.zeros((int(ok.sum()), width))
    keep = ok[row]
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[(np.cumsum(ok) - 1)[row[keep]], at[keep]] = flat[keep]
    return ok, out


def _tiles(scale: int):
    def tile(key: int, x: np.ndarray, ids: np.ndarray, ask: np.ndarray) -> dict:
        wide = bool(np.abs(x).max(initial=0) >= 1 << 31)
        with np.errstate(over="ignore"):
            mass = np.square(x).sum(axis=0)
            norm = float(np.sqrt(np.square(x).sum(axis=1)).max(initial=0))
        data = np.ascontiguousarray(x.T).astype(np.float64 if wide else np.int32)
        return {"tile": key, "n": len(ids), "dim": x.shape[1], "wide": wide, "norm": norm, "mass": mass.tolist(), "ids": ids.tobytes(), "asks": np.flatnonzero(ask).astype(np.int32).tobytes(), "data": data.tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = _schema(TILES)
        key = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush():
            nonlocal key, held
            width = max(x.shape[1] for x, _, _ in held)
            x = np.vstack([np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x, _, _ in held])
            ids, ask = (np.concatenate([h[i] for h in held]) for i in (1, 2))
            step = max(1, TILE_BYTES // (4 * max(width, 1)))
            for a in range(0, len(ids), step):
                yield pa.RecordBatch.from_pylist([tile(key, x[a : a + step], ids[a : a + step], ask[a : a + step])], schema=schema)
                key += 1
            held = []

        for batch in batches:
            ok, x = _integers(batch.column("vector"), scale)
            if ok.any():
                held.append((x, T.ids_of(batch.column("id"))[ok], np.asarray(batch.column("ask"))[ok]))
            if sum(4 * h[0].size for h in held) >= TILE_BYTES:
                yield from flush()
        if held:
            yield from flush()

    return run


def _matrix(row: dict) -> np.ndarray:
    """A tile's components, one row for each dimension."""
    return np.frombuffer(row["data"], np.float64 if row["wide"] else np.int32).reshape(row["dim"], row["n"]).astype(np.float64)


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _schema(BLOCKS)
    for batch in batches:
        for row in batch.to_pylist():
            slots = np.frombuffer(row["asks"], np.int32)
            x = np.ascontiguousarray(_matrix(row)[:, slots].T)
            with np.errstate(over="ignore"):
                norm = float(np.sqrt(np.square(x).sum(axis=1)).max(initial=0))
            out = {"tile": row["tile"], "n": len(slots), "dim": row["dim"], "norm": norm, "ids": np.frombuffer(row["ids"], np.int64)[slots].tobytes(), "slots": slots.tobytes(), "data": x.tobytes()}
            yield pa.RecordBatch.from_pylist([out], schema=schema)


def _whole(a: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers."""
    return np.vectorize(int, otypes=[object])(a) if a.size else a.astype(object)


class Queries:
    """A block of queries with the best candidates found so far."""

    def __init__(self, tile: np.ndarray, slot: np.ndarray, ids: np.ndarray, x: np.ndarray, floor: np.ndarray, k: int, norm: float):
        self.tile, self.slot, self.ids, self.x, self.floor, self.k, self.norm = tile, slot, ids, x, floor.copy(), k, norm
        self.q, self.who, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, q: np.ndarray, who: np.ndarray, score: np.ndarray) -> None:
        """Keep the k best of each query (ties: the smaller id) and raise its floor."""
        if not len(q):
            return
        if self.score.dtype != score.dtype:
            self.score, score = _whole(self.score), _whole(score)
        q, who, score = np.concatenate([self.q, q]), np.concatenate([self.who, who]), np.concatenate([self.score, score])
        order = np.lexsort((who, -score, q)) if score.dtype != object else np.array(sorted(range(len(q)), key=lambda i: (q[i], -score[i], who[i])), np.int64)
        q = q[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = order[rank < self.k]
        last = order[rank == self.k - 1]
        self.q, self.who, self.score = q[rank < self.k], who[keep], score[keep]
        at = q[rank == self.k - 1]
        self.floor[at] = np.maximum(self.floor[at], score[last].astype(np.float64))


def scan_tile(qs: Queries, key: int, c: np.ndarray, ids: np.ndarray, order: np.ndarray, norm: float) -> None:
    """Adds the candidates of one tile (``c``: a row for each dimension) that can be among the k best."""
    width = max(c.shape[0], qs.x.shape[1])
    own = np.flatnonzero(qs.tile == key)
    if not qs.norm * norm < EXACT:  # also where a norm overflows
        whole = min(c.shape[0], qs.x.shape[1])
        s = _whole(qs.x[:, :whole]) @ _whole(c[:whole]) if whole else np.zeros((len(qs.ids), len(ids)), object)
        s = np.clip(s, -LONG - 1, LONG)
        q, j = np.divmod(np.arange(s.size), len(ids))
        other = ~((qs.tile[q] == key) & (qs.slot[q] == j))
        qs.add(q[other], ids[j[other]], s.reshape(-1)[other])
        return
    dims = order[order < width]
    take = lambda a, axis: np.take(np.pad(a, [(0, width - a.shape[axis]) if i == axis else (0, 0) for i in range(2)]), dims, axis)
    x, c = take(qs.x, 1), take(c, 0)
    edges = [0]
    while edges[-1] < width:
        edges.append(min(width, max(FIRST_BLOCK, 2 * edges[-1])))
    rest = lambda a, axis: np.sqrt(np.flip(np.cumsum(np.flip(np.square(a), axis), axis), axis))
    xn, cn = rest(x, 1), rest(c, 0)
    j = np.arange(len(ids))
    s = np.zeros((len(x), len(j)))
    alive = np.ones(s.shape, bool)
    alive[own, qs.slot[own]] = False
    # a margin for the rounding of norms; the sums themselves are exact
    can = lambda s, a, b, floor: s + a * b * (1 + 1e-9) + 1e-6 >= floor
    done = 0
    for a, b in zip(edges, edges[1:], strict=False):
        if alive.sum() < SPARSE * alive.size:
            break
        s += x[:, a:b] @ c[a:b]
        done = b
        if b < width:
            alive &= can(s, xn[:, b, None], cn[None, b], qs.floor[:, None])
        else:
            alive &= s >= qs.floor[:, None]
        cols = alive.any(axis=0)
        if cols.mean() < 0.7:
            j, s, alive, c, cn = j[cols], s[:, cols], alive[:, cols], c[:, cols], cn[:, cols]
            if not len(j):
                return
    if done >= width and s.shape[1] > qs.k:
        top = np.partition(np.where(alive, s, -np.inf), s.shape[1] - qs.k, axis=1)[:, s.shape[1] - qs.k]
        alive &= s >= top[:, None]
    q, i = np.nonzero(alive)
    score = s[q, i]
    for a, b in zip(edges, edges[1:], strict=False):
        if b <= done or not len(q):
            continue
        score = score + np.einsum("ij,ji->i", x[q, a:b], c[a:b, i])
        keep = can(score, xn[q, b], cn[b, i], qs.floor[q]) if b < width else score >= qs.floor[q]
        q, i, score = q[keep], i[keep], score[keep]
    qs.add(q, ids[j[i]], score)


def _scan(order: np.ndarray, k: int):
    def run(tiles: pa.Table, asked: pa.Table) -> pa.Table:
        blocks: list[Queries] = []
        for row in asked.to_pylist():
            slots, ids = np.frombuffer(row["slots"], np.int32), np.frombuffer(row["ids"], np.int64)
            x = np.frombuffer(row["data"], np.float64).reshape(row["n"], row["dim"])
            floor = np.full(row["n"], -np.inf)
            for f in row.get("floors") or []:
                floor[np.searchsorted(slots, f["slot"])] = f["floor"]
            for a in range(0, row["n"], QUERY_ROWS):
                b = slice(a, a + QUERY_ROWS)
                blocks.append(Queries(np.full(len(ids[b]), row["tile"]), slots[b], ids[b], x[b], floor[b], k, row["norm"]))
        blocks = _joined(blocks, k)
        for row in tiles.to_pylist() if blocks else []:
            c, ids = _matrix(row), np.frombuffer(row["ids"], np.int64)
            for qs in blocks:
                scan_tile(qs, row["tile"], c, ids, order, row["norm"])
        cols: dict[str, list] = {c: [] for c in _schema(FOUND).names}
        for qs in blocks:
            cols["tile"] += qs.tile[qs.q].tolist()
            cols["slot"] += qs.slot[qs.q].tolist()
            cols["query_id"] += qs.ids[qs.q].tolist()
            cols["vec_id"] += [None if w == T.NO_DOC else w for w in qs.who.tolist()]
            cols["score"] += [int(s) for s in qs.score]
        return pa.table(cols, schema=_schema(FOUND))

    return run


def _joined(blocks: list[Queries], k: int) -> list[Queries]:
    """Small blocks as one, so that products are of whole matrices."""
    out: list[list[Queries]] = []
    for b in blocks:
        if out and out[-1][0].x.shape[1] == b.x.shape[1] and sum(len(o.ids) for o in out[-1]) + len(b.ids) <= QUERY_ROWS:
            out[-1].append(b)
        else:
            out.append([b])
    cat = lambda bs, name: np.concatenate([getattr(b, name) for b in bs])
    return [Queries(cat(bs, "tile"), cat(bs, "slot"), cat(bs, "ids"), cat(bs, "x"), cat(bs, "floor"), k, max(b.norm for b in bs)) for bs in out]


def top_k(vectors: DataFrame, queries: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``queries`` holds, its k best among all other rows."""
    spark = vectors.sparkSession
    base = f"{B.checkpoint_dir(spark)}/topk-{uuid.uuid4().hex}"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("ask"))
    rows.mapInArrow(_tiles(scale), TILES).write.parquet(f"{base}/tiles")
    tiles = spark.read.parquet(f"{base}/tiles")
    mass = tiles.select(F.posexplode("mass").alias("d", "m")).groupBy("d").agg(F.sum("m").alias("m")).collect()  # one row for each dimension
    order = np.array([r["d"] for r in sorted(mass, key=lambda r: (-r["m"], r["d"]))], np.int64)
    size = tiles.agg(F.count("*").alias("tiles"), F.sum(F.octet_length("data")).alias("bytes"), F.sum(F.octet_length("asks") * 2.0 * F.col("dim")).alias("asked")).first()
    many = max(-(-(size["bytes"] or 0) // TILE_GROUP_BYTES), min(size["tiles"], spark.sparkContext.defaultParallelism), 1)
    asks = int(max(-(-(size["asked"] or 0) // QUERY_GROUP_BYTES), 1))
    deal = lambda n, seed: F.pmod(F.xxhash64("tile", F.lit(seed)), F.lit(n)).cast("int")
    held = tiles.withColumn("i", deal(many, 1))
    asked = tiles.where(F.octet_length("asks") > 0).mapInArrow(_query_blocks, BLOCKS).withColumn("j", deal(asks, 2))
    # the tile group that a query group scans first
    first = F.pmod("j", F.lit(many)).cast("int")
    seeds = held.where(F.col("i") < asks).withColumn("j", F.explode(F.sequence("i", F.lit(asks - 1), F.lit(many))))
    find = _scan(order, k)
    seeds.groupBy("j").cogroup(asked.groupBy("j")).applyInArrow(find, FOUND).write.parquet(f"{base}/first")
    found = spark.read.parquet(f"{base}/first")
    floors = found.groupBy("tile", "slot").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("floor")).where(F.col("n") >= k)
    floors = floors.groupBy("tile").agg(F.collect_list(F.struct("slot", "floor")).alias("floors"))  # at most a tile of them
    rest = asked.join(floors, "tile", "left").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(many - 1)))).where(F.col("i") != first)
    spread = held.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(asks - 1))))
    more = spread.groupBy("i", "j").cogroup(rest.groupBy("i", "j")).applyInArrow(find, FOUND) if many > 1 else found.limit(0)
    best = Window.partitionBy("tile", "slot").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.union(more).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
