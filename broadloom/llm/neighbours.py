"""Nearest neighbours by vantage-point trees, one per shard, with relaxed pruning.

A routing tree of vantage points, fitted on a bounded sample, cuts space into regions by distance medians; every row is laid
out by its region, a crowded region over several tasks. A task reads its rows region by region and builds a
vantage-point tree of each run of at most SHARD rows: that is a shard. Of every region the exact range of distances to
the vantage points above it is known.

Queries come in blocks of at most BLOCK, which every task gets. A block is searched twice: first each query in its
home region, which bounds its distance to the k-th neighbour, then in all other regions that this bound does not rule
out. By the triangle inequality no row whose distances to a vantage point lie in [lo, hi] is nearer to a query at
distance d than b = max(lo - d, d - hi). A region or subtree is left out if ``factor`` * b is above the bound of the query:
with factor 1 the search is exact, a larger factor trades recall for work.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadloom.llm.codes import finite
from broadloom.session import materialize, remove_scratch, scratch_path

NEAREST = 10
#: Recall on the given tables is 0.99 or more, measured against all distances; 1 is exact.
FACTOR = 5.0
SAMPLE = 1 << 14  # rows that fit the routing tree
REGIONS = 1 << 10  # most regions
SHARD = 1 << 16  # most rows of a tree
LEAF = 256
BLOCK = 1 << 15  # queries searched at a time
LAST = np.iinfo(np.int64).max  # stands for a null id: behind all others
FOUND = "query bigint, _row bigint, vec_id bigint, score double"


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row of ``a`` to the row of ``b`` beside it, or to all rows of a if b is one vector."""
    d = a - b
    return np.sqrt((d * d).sum(axis=1))


def vectors_of(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


# --- routing ------------------------------------------------------------------------------------


@dataclass
class Router:
    """Complete binary tree in heap order: node n has children 2n + 1 and 2n + 2; regions are the leaves."""

    points: np.ndarray
    cuts: np.ndarray
    levels: int

    def parts(self) -> tuple:
        """Plain values, for broadcast: tasks need no copy of this package."""
        return self.points, self.cuts, self.levels

    @staticmethod
    def fit(sample: np.ndarray, levels: int) -> Router:
        size = (1 << levels) - 1
        points, cuts = np.zeros((size, sample.shape[1])), np.zeros(size)
        held = {0: sample}
        for n in range(size):
            rows = held.pop(n)
            points[n] = rows[len(rows) // 2] if len(rows) else points[(n - 1) // 2]
            d = distances(rows, points[n])
            cuts[n] = np.median(d) if len(rows) else 0.0
            held[2 * n + 1], held[2 * n + 2] = rows[d <= cuts[n]], rows[d > cuts[n]]
        return Router(points, cuts, levels)

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Region of each row, and its distances to the vantage points above it."""
        node, path = np.zeros(len(x), np.int64), np.empty((len(x), self.levels))
        for level in range(self.levels):
            path[:, level] = distances(x, self.points[node])
            node = 2 * node + np.where(path[:, level] <= self.cuts[node], 1, 2)
        return node - len(self.points), path

    def above(self, region: int) -> list[int]:
        """Vantage points above a region, from the root down."""
        node, out = region + len(self.points), []
        while node:
            node = (node - 1) // 2
            out.append(node)
        return out[::-1]


# --- one shard ----------------------------------------------------------------------------------


class Best:
    """The k nearest rows of every query so far; equal distances go to the smaller id. ``bound`` is a distance that the k-th
    is known not to exceed."""

    def __init__(self, queries: np.ndarray, rows: np.ndarray, bound: np.ndarray, k: int):
        self.x, self.own, self.k = queries, rows, k
        self.bound = bound.copy()
        self.lengths = (queries * queries).sum(axis=1)
        self.d = np.full((len(queries), k), np.inf)
        self.id, self.row = np.full((2, len(queries), k), LAST)

    def offer(self, q: np.ndarray, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> None:
        # squares by products first: they tell apart what cannot be near, exact distances decide the rest
        rough = self.lengths[q][:, None] + lengths - 2.0 * (self.x[q] @ x.T)
        most = self.bound[q] ** 2
        at, to = np.nonzero(rough <= (most + 1e-9 * (self.lengths[q] + most))[:, None] + 1e-9 * lengths)
        keep = rows[to] != self.own[q[at]]
        at, to = q[at[keep]], to[keep]
        d = distances(self.x[at], x[to]) if len(at) else np.empty(0)
        near = d <= self.bound[at]
        at, to, d = at[near], to[near], d[near]
        if not len(at):
            return
        who = np.unique(at)
        query = np.concatenate([np.repeat(who, self.k), at])
        d = np.concatenate([self.d[who].ravel(), d])
        found_id, found_row = np.concatenate([self.id[who].ravel(), ids[to]]), np.concatenate([self.row[who].ravel(), rows[to]])
        order = np.lexsort((found_row, found_id, d, query))
        starts = np.searchsorted(query[order], who)
        pick = order[starts[:, None] + np.arange(self.k)]
        self.d[who], self.id[who], self.row[who] = d[pick], found_id[pick], found_row[pick]
        self.bound[who] = np.minimum(self.bound[who], self.d[who, -1])


def ruled_out(lo, hi, d: np.ndarray, bound: np.ndarray, factor: float) -> np.ndarray:
    """True where no row at distances [lo, hi] from a vantage point, d away from the query, can be as near as ``bound``."""
    return np.maximum(lo - d, d - hi) * factor > bound * (1 + 1e-9) + 1e-12


class Tree:
    """Vantage-point tree of one shard. Halves are of equal size, whatever the distances: repeated vectors cannot unbalance it."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        self.order, self.leaf, self.nodes = np.arange(len(x)), leaf, {}
        self._build(x, 0, len(x))
        self.x, self.ids, self.rows = x[self.order], ids[self.order], rows[self.order]
        self.lengths = (self.x * self.x).sum(axis=1)

    def _build(self, x: np.ndarray, start: int, end: int) -> None:
        if end - start <= self.leaf:
            return
        own = self.order[start:end]
        point = x[own[len(own) // 2]]
        d = distances(x[own], point)
        middle = len(own) // 2
        part = np.argpartition(d, middle)
        own, d = own[part], d[part]
        self.order[start:end] = own
        self.nodes[start, end] = point, (d[:middle].min(), d[:middle].max()), (d[middle:].min(), d[middle:].max())
        self._build(x, start, start + middle)
        self._build(x, start + middle, end)

    def search(self, best: Best, q: np.ndarray, factor: float, start: int = 0, end: int | None = None) -> None:
        """Offers ``best`` every row that may be near to the queries ``q``, the half that is likelier nearer first."""
        end = len(self.x) if end is None else end
        if not len(q):
            return
        if (start, end) not in self.nodes:
            best.offer(q, self.x[start:end], self.ids[start:end], self.rows[start:end], self.lengths[start:end])
            return
        point, inner, outer = self.nodes[start, end]
        d, middle = distances(best.x[q], point), start + (end - start) // 2
        sides = [(inner, start, middle), (outer, middle, end)]
        first = np.where(d - inner[1] <= outer[0] - d, 0, 1)
        for turn in (0, 1):
            for side, (of, a, b) in enumerate(sides):
                here = (first == side) == (turn == 0)
                self.search(best, q[here & ~ruled_out(*of, d, best.bound[q], factor)], factor, a, b)


# --- search -------------------------------------------------------------------------------------


def _runs(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(region, vectors, ids, rows) of each run of one region, cut at ``most`` rows."""
    held, parts, size = None, [], 0

    def close():
        x, ids, rows = (np.concatenate(p) for p in zip(*parts))
        return held, x, ids, rows

    for batch in batches:
        region = batch.column("_region").to_numpy(zero_copy_only=False)
        if not len(region):
            continue
        x = vectors_of(batch.column("_v"))
        ids = batch.column("_id").fill_null(int(LAST)).to_numpy(zero_copy_only=False)
        rows = batch.column("_row").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(region[1:] != region[:-1]) + 1).tolist(), len(region)]
        for a, b in zip(cuts, cuts[1:]):
            while a < b:
                if parts and (region[a] != held or size >= most):
                    yield close()
                    parts, size = [], 0
                held, n = region[a], min(b - a, most - size)
                parts.append((x[a:a + n], ids[a:a + n], rows[a:a + n]))
                size, a = size + n, a + n
    if parts:
        yield close()


def _searched(index: DataFrame, router, ranges, block, home_only: bool, k: int, factor: float, shard: int) -> DataFrame:
    """FOUND rows of the queries of a block: each one's nearest of every shard that is searched for it."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, spans = Router(*router.value), ranges.value
        rows, x, home, bound = block.value
        for region, vectors, ids, own in _runs(batches, shard):
            here = home == region
            if not home_only:
                here = ~here
                for point, (lo, hi) in zip(tree.above(int(region)), spans[int(region)]):
                    q = np.flatnonzero(here)
                    here[q] = ~ruled_out(lo, hi, distances(x[q], tree.points[point]), bound[q], factor)
            q = np.flatnonzero(here)
            if not len(q):
                continue
            best = Best(x[q], rows[q], bound[q], k)
            Tree(vectors, ids, own).search(best, np.arange(len(q)), factor)
            at, to = np.nonzero(np.isfinite(best.d))
            found = best.id[at, to]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[q][at]), pa.array(best.row[at, to]), pa.array(found, mask=found == LAST), pa.array(best.d[at, to])],
                names=["query", "_row", "vec_id", "score"])

    return index.select("_region", "_id", "_row", "_v").mapInArrow(run, FOUND)


def _nearest(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("score", F.col("vec_id").asc_nulls_last(), "_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def indexed(vectors: DataFrame, id_column: str, vector_column: str, sample: int = SAMPLE, regions: int = REGIONS,
            shard: int = SHARD) -> tuple[DataFrame, Router | None]:
    """Every row that takes part (_row, _id, _v, _region), in the order of its region, and the router.

    The router is fitted on the ``sample`` rows of the smallest hash; the number of regions follows the rows up to ``regions``,
    beyond that regions grow and lie in several tasks.
    """
    spark = vectors.sparkSession
    some = F.exists(vector_column, lambda x: x != 0)
    valid = vectors.where(finite(vector_column) & some).select(F.col(id_column).cast("bigint").alias("_id"), F.col(vector_column).alias("_v"))
    size = valid.agg(F.count("*").alias("n"), F.min(F.size("_v")).alias("a"), F.max(F.size("_v")).alias("b")).first()
    if size.n and size.a != size.b:
        raise ValueError(f"vectors must have one length; found {size.a} to {size.b}")
    if not size.n:
        return valid.select(F.lit(0).cast("bigint").alias("_row"), "*", F.lit(0).cast("bigint").alias("_region")), None
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size.n // shard))
    taken = valid.orderBy(F.xxhash64("_id", "_v")).limit(sample).collect()
    router = Router.fit(np.array([r._v for r in taken], np.float64), min(4 * tasks, regions).bit_length() - 1)
    shared = spark.sparkContext.broadcast(router.parts())

    @F.arrow_udf("bigint")
    def region(v: pa.Array) -> pa.Array:
        return pa.array(Router(*shared.value).route(vectors_of(v))[0] if len(v) else np.empty(0, np.int64))

    # tasks take equal ranges of (region, hash): a small region lies in one, a crowded one in as many as it fills
    placed = valid.withColumn("_region", region("_v")).withColumn("_salt", F.xxhash64("_id", F.monotonically_increasing_id()))
    laid = placed.repartitionByRange(tasks, "_region", "_salt").sortWithinPartitions("_region")
    return materialize(laid.select(F.monotonically_increasing_id().alias("_row"), "_id", "_v", "_region"), "index"), router


def _ranges(index: DataFrame, router) -> dict[int, list[tuple[float, float]]]:
    """region -> range of its rows' distances to each vantage point above it."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Router(*router.value)
        for batch in batches:
            if batch.num_rows:
                region, path = tree.route(vectors_of(batch.column("_v")))
                which = np.unique(region)
                lo = [path[region == r].min(axis=0).tolist() for r in which]
                hi = [path[region == r].max(axis=0).tolist() for r in which]
                yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(lo, pa.list_(pa.float64())), pa.array(hi, pa.list_(pa.float64()))],
                                                 names=["region", "lo", "hi"])

    levels = range(router.value[2])
    parts = index.select("_v").mapInArrow(run, "region bigint, lo array<double>, hi array<double>").groupBy("region").agg(
        F.array(*[F.min(F.col("lo")[i]) for i in levels]).alias("lo"), F.array(*[F.max(F.col("hi")[i]) for i in levels]).alias("hi"))
    return {r.region: list(zip(r.lo, r.hi)) for r in parts.collect()}  # one row per region


def nearest_rows(vectors: DataFrame, every: int = 100, k: int = NEAREST, factor: float = FACTOR, id_column: str = "vec_id",
                 vector_column: str = "embedding", block: int = BLOCK, shard: int = SHARD, regions: int = REGIONS,
                 sample: int = SAMPLE) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, its ``k`` nearest other rows found,
    all of them if there are fewer. Equal distances go to the smaller id.

    A vector that is null, empty, all zero, or holds a null, NaN or infinite component takes no part; the others must be of one
    length, else ValueError. A row without an id is no query, but may be found, behind equally near rows with ids. Rows that
    repeat an id or a vector are rows of their own, each a query if its id is one; only its own row is left out. Other columns
    are not read. An empty table gives no rows. ``factor`` below 1 is an error.
    """
    if factor < 1:
        raise ValueError("a factor below 1 prunes less than exact search does")
    spark = vectors.sparkSession
    index, router = indexed(vectors, id_column, vector_column, sample, regions, shard)
    asked = index.where(F.col("_id") % every == 0)
    queries = asked.count() if router is not None else 0
    if not queries:
        return index.where("false").select(F.col("_id").alias("query_id"), F.lit(1).alias("rank"), F.col("_id").alias("vec_id"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(router.parts())
    ranges = spark.sparkContext.broadcast(_ranges(index, shared))
    blocks, path = -(-queries // block), scratch_path(spark, "found")
    for b in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("_row"), F.lit(blocks)) == b).select("_row", "_v", "_region").toArrow()  # about ``block`` rows
        if not mine.num_rows:
            continue
        rows, home = (mine.column(n).to_numpy() for n in ("_row", "_region"))
        x = vectors_of(mine.column("_v").combine_chunks())
        far = np.full(len(rows), np.inf)
        told = spark.sparkContext.broadcast((rows, x, home, far))
        near = materialize(_searched(index, shared, ranges, told, True, k, factor, shard), "home")
        kth = {r.query: r.score for r in _nearest(near, k).where(F.col("rank") == k).collect()}  # one row a query of the block
        bound = np.array([kth.get(r, np.inf) for r in rows.tolist()])
        near.write.mode("append").parquet(path)
        told.unpersist()
        told = spark.sparkContext.broadcast((rows, x, home, bound))
        _searched(index, shared, ranges, told, False, k, factor, shard).write.mode("append").parquet(path)
        told.unpersist()
    found = _nearest(spark.read.schema(FOUND).parquet(path), k)
    names = asked.select(F.col("_row").alias("query"), F.col("_id").alias("query_id"))
    done = materialize(found.join(names, "query").select("query_id", "rank", "vec_id", "score"), "nearest")
    remove_scratch(spark, path)
    return done
