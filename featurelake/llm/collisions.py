"""Nearest neighbours by collision counting over query-aware hashes.

Every hash function is one random projection. A shard of the vectors keeps its order by each projection, as sorted
arrays that are built once and written; the bucket of a query is a window centred at its own projection. A vector
collides with the query once for each window that holds it. Vectors that collide in at least ``SHARE`` of the functions
are candidates, and each is verified with its exact inner product in double precision; no other vector is touched.

Windows of half a width h find what is within h / ``MARGIN``. In a query's first shard they grow by virtual rehashing, by
``GROWTH`` in each round, until the k-th nearest found is nearer than that. Its score bounds the query from then on: in
every other shard the windows are as wide as the bound asks for, which does not grow with the table.

Largest inner product becomes least distance by one more coordinate: vectors are divided by the largest norm of their
shard, and the new coordinate fills them up to length 1; queries are divided by their own norm. Shards are ranges of
norms, so that little is filled up; the first is that of the largest, and one whose norms cannot reach the bound is
passed over. A shard has ``SHARD_ROWS`` vectors and meets blocks of queries of bounded size. All vectors are in the
index, and nothing is fitted to a sample: the projections are random.

Vectors that are NULL, zero, of another length than most, or hold NULL or non-finite components take no part; neither do
NULL ids. Repeated rows count each as neighbours; a query is an id and a vector, searched once and ranked by itself. With
fewer candidates than asked, all are returned. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import ranked
from .common import stage

FUNCTIONS, SHARE = 250, 0.74
#: Half the first window, in standard deviations of a projected distance of 1, how windows grow, and what they find.
FIRST, GROWTH, MOST_ROUNDS, MARGIN = 1.0, 1.1, 12, 1.2
SHARD_ROWS, FIRST_ROWS, QUERY_ROWS = 4096, 512, 4096
TILE = 1024  # vectors whose collisions are counted at once
INDEX = "shard long, norm double, ids binary, vectors binary, places binary"
FOUND = "query_id long, query long, shard long, vec_id long, score double, verified long"


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def projections(points: np.ndarray) -> np.ndarray:
    """One row per function: the projections of all points."""
    directions = np.random.default_rng(7).standard_normal((FUNCTIONS, points.shape[1]))
    return directions @ points.T


def filled(x: np.ndarray, norm: float) -> np.ndarray:
    return np.column_stack([x / norm, np.sqrt(np.maximum(0, 1 - ((x / norm) ** 2).sum(1)))])


def indexed(key, shard):
    """The index of a shard: its vectors, and for each function the place of every vector in its sorted array."""
    x = matrix(shard.column("v"))
    norm = float(np.sqrt((x**2).sum(1)).max())
    order = np.argsort(projections(filled(x, norm)), axis=1, kind="stable")
    places = np.empty(order.shape, np.uint16)
    np.put_along_axis(places, order, np.arange(len(x), dtype=np.uint16)[None, :], axis=1)
    ids = shard.column("vec_id").to_numpy()
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "norm": [norm], **{
        n: pa.array([a.tobytes()], pa.binary()) for n, a in (("ids", ids), ("vectors", x), ("places", places))}})


class Shard:
    def __init__(self, row: dict):
        self.ids, self.norm = np.frombuffer(row["ids"], np.int64), row["norm"]
        self.x = np.frombuffer(row["vectors"]).reshape(len(self.ids), -1)
        self.places = np.frombuffer(row["places"], np.uint16).reshape(FUNCTIONS, -1)
        own = projections(filled(self.x, self.norm))
        self.arrays = np.empty_like(own)
        np.put_along_axis(self.arrays, self.places.astype(np.int64), own, axis=1)

        # in tiles of vectors, so that a query's comparisons stay in the processor's cache
        self.tiles = [np.ascontiguousarray(self.places[:, i : i + TILE]) for i in range(0, len(self.ids), TILE)]
        self.gaps = [np.empty_like(t) for t in self.tiles]
        self.inside = [np.empty(t.shape, bool) for t in self.tiles]

    def windows(self, centres: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query (row) and function, the first place in its window and how many there are; one search per
        function for all queries."""
        low, size = (np.empty((len(centres), FUNCTIONS), np.uint16) for _ in range(2))
        for f, places in enumerate(self.arrays):
            low[:, f] = start = places.searchsorted(centres[:, f] - halves)
            size[:, f] = places.searchsorted(centres[:, f] + halves, "right") - start
        return low, size

    def candidates(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of the vectors in enough of a query's windows."""
        low, size, counts = low[:, None], size[:, None], []
        for tile, gap, inside in zip(self.tiles, self.gaps, self.inside, strict=True):
            np.less(np.subtract(tile, low, out=gap), size, out=inside)
            counts.append(np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8))
        return np.flatnonzero(np.concatenate(counts) >= np.ceil(SHARE * FUNCTIONS))

    def search(self, q: np.ndarray, centres: np.ndarray, own: list[int], k: int, bounds: np.ndarray) -> list[tuple]:
        """Per query (row): (ids, scores) of the best found, and how many vectors were verified.

        ``bounds`` are scores of which ``k`` others are known already; -inf if there are not.
        """
        reach = self.norm * np.array([np.linalg.norm(v) for v in q])
        free, out = bounds == -np.inf, [(self.ids[:0], np.empty(0), 0)] * len(q)
        near = np.where(free, 0.0, bounds) / reach
        halves = np.where(free, FIRST, MARGIN * np.sqrt(np.maximum(0.0, 2 - 2 * near)))
        known, rows, scores = {}, {}, {}
        asked = np.flatnonzero(bounds <= reach)
        for _ in range(MOST_ROUNDS):
            left = []
            for i, low, size in zip(asked, *self.windows(centres[asked], halves[asked]), strict=True):
                fresh = self.candidates(low, size)
                if i in known:
                    fresh = fresh[~known[i][fresh]]
                if free[i]:
                    known.setdefault(i, np.zeros(len(self.ids), bool))[fresh] = True
                fresh = fresh[self.ids[fresh] != own[i]]
                rows[i] = np.concatenate([rows[i], fresh]) if i in rows else fresh
                found = self.x[fresh] @ q[i]
                scores[i] = np.concatenate([scores[i], found]) if i in scores else found
                sure = reach[i] * (1 - (halves[i] / MARGIN) ** 2 / 2)
                if free[i] and (scores[i] >= sure).sum() < k:
                    left.append(i)
                else:
                    out[i] = self.best(rows.pop(i), scores.pop(i), k)
                    known.pop(i, None)
            asked = np.array(left, np.int64)
            halves[asked] *= GROWTH
            if not left:
                break
        for i in asked:  # windows never held enough: every vector is verified
            every = np.flatnonzero(self.ids != own[i])
            out[i] = self.best(every, self.x[every] @ q[i], k)
        return out

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[order]], scores[order], len(rows)


def searched(k: int):
    """The search of one block of queries in one shard."""

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        kinds = {"query_id": pa.int64(), "query": pa.int64(), "shard": pa.int64(), "vec_id": pa.int64(), "score": pa.float64(), "verified": pa.int64()}
        if not len(index) or not len(queries):
            return pa.table({n: pa.array([], t) for n, t in kinds.items()})
        number, shard = index.column("shard")[0].as_py(), Shard(index.to_pylist()[0])
        q = matrix(queries.column("v"))
        centres = projections(np.column_stack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros(len(q))])).T
        out = []
        own, names = (queries.column(c).to_pylist() for c in ("vec_id", "query"))
        found = shard.search(q, centres, own, k, queries.column("bound").to_numpy())
        for own_id, name, (ids, scores, verified) in zip(own, names, found, strict=True):
            some = (np.full(len(ids), v) for v in (own_id, name, number))
            out.append((*some, ids, scores, np.full(len(ids), verified)))
        return pa.table({n: pa.array(np.concatenate(c), t) for (n, t), c in zip(kinds.items(), zip(*out, strict=True), strict=True)})

    return run


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as doubles."""
    v = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound)
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0][0] if sizes else 0))


def index_of(rows: DataFrame) -> DataFrame:
    """One row per shard, written; shards are ranges of falling norms."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    placed = ranked(rows.withColumn("key", -norm), [], ["key"])
    shard = ((F.col("rank") - F.col("rank") % SHARD_ROWS) / SHARD_ROWS).cast("long").alias("shard")
    return stage(placed.select("vec_id", "v", shard).groupBy("shard").applyInArrow(indexed, INDEX), "collision-index")


def found_in(index: DataFrame, asked: DataFrame, shards: list[int], block_rows: int, k: int) -> DataFrame:
    """What all queries find in the shards numbered by ``shards`` (first, one behind the last)."""
    blocks = max(1, -(-asked.count() // block_rows))
    every = lambda a, z: F.explode(F.sequence(F.lit(a).cast("long"), F.lit(z - 1).cast("long")))
    left = index.filter(F.col("shard").between(shards[0], shards[1] - 1)).withColumn("block", every(0, blocks))
    block = F.pmod(F.xxhash64("vec_id", "query"), F.lit(blocks)).alias("block")
    right = asked.select("vec_id", "query", "v", "bound", block).withColumn("shard", every(*shards))
    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(searched(k), FOUND)


def find(vectors: DataFrame, queries: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, query, shard, vec_id, score, verified): the ``k`` nearest of each query in each shard, some of them.

    Those that are among the ``k`` nearest of all are there. ``verified`` is how many vectors of the shard were compared
    exactly with the query.
    """
    rows = stage(usable(vectors, id, vector), "vectors")
    index = index_of(rows)
    shards = index.count()
    asked = rows.filter(queries).withColumn("query", F.xxhash64("v")).dropDuplicates(["vec_id", "query"])
    asked = stage(asked.withColumn("bound", F.lit(float("-inf"))), "queries")
    found = stage(found_in(index, asked, [0, 1], FIRST_ROWS, k), "first-found")
    if shards > 1:
        bounds = found.groupBy(F.col("query_id").alias("vec_id"), "query").agg(F.min("score").alias("known"), F.count(F.lit(1)).alias("n"))
        bounds = bounds.filter(F.col("n") >= k).drop("n")
        bounded = asked.join(bounds, ["vec_id", "query"], "left").withColumn("bound", F.coalesce("known", "bound")).drop("known")
        found = found.unionByName(found_in(index, bounded, [1, shards], QUERY_ROWS, k))
    return found


def search(vectors: DataFrame, queries: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of every vector that ``queries`` selects by ``vec_id``."""
    first = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    best = find(vectors, queries, k, id, vector).withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
