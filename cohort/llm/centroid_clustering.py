"""Centroid clustering in whole numbers with a vantage-point tree over the centroids.

Vectors become integers floor(scale * x) and are written once. In every round a vantage-point
tree over the centroids is built on the driver (k centroids, a parameter) and broadcast. A
node of the tree holds a centroid and the range of distances from it to the centroids of
either half; leaves hold a few centroids. Every vector searches the tree best first: the
open node with the smallest lower bound comes next, and a node is dropped only if its
bound lies beyond the best distance so far plus a slack above rounding error. The pruning
radius is inclusive, so a centroid at the same distance is always seen and the smaller
number wins. Distances that decide are exact integer squares. All vectors of a batch take
their searches' steps at the same time, each on its own node.

The task that assigns vectors also sums them by cluster, so a round shuffles k rows a task
and no vector; new centroids are exact floors of sums by counts. Rounds end early once no
centroid moves, as all later ones would repeat. The last assignment is written and
its inertia summed from there.

Defined results: vectors that are null, hold a null or non-finite component or another
number of components take no part. Rows that repeat an id all count; rows without id count and are
returned, but start no centroid unless ids run out. Equal hashes (repeated ids) start in
the order of their packed bytes. Fewer vectors than ``k`` give fewer centroids; equal
centroids keep both numbers and the smaller one gets the vectors, the other one stays
where it is; an empty table gives no rows. Components beyond 2^27 in absolute value, whose squared
distances could pass 64 bits, raise.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort.llm.common import map_arrow, pick, written

LIMIT = 1 << 27
LEAF = 4
CELLS = 1 << 22  # entries of a batch's table of open nodes, and of its differences
SLACK = 1e-5  # distances stay below 2^32, where doubles are exact to 1e-6


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """``[id, v]``: vectors that take part, as little-endian 32-bit integers in a binary column."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.floor(scale * b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
            if len(x) and np.abs(x).max() > LIMIT:
                raise ValueError(f"component beyond {LIMIT} after scaling")
            yield pa.record_batch({"id": b.column(0), "v": pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary())})

    src = pick(vectors, id=id_col, v=vector_col).select("id", F.col("v").cast("array<double>").alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ok = src.where((F.size("v") == dim) & F.forall("v", finite))
    return map_arrow(ok, pack, f"id {dict(src.dtypes)['id']}, v binary")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dim).astype(np.int64)


def first_vectors(table: DataFrame, k: int, dim: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:id``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = table.select(key.alias("key"), "v").orderBy(F.col("key").asc_nulls_last(), "v").limit(k).collect()
    return np.array([np.frombuffer(r["v"], "<i4") for r in rows], np.int64).reshape(-1, dim)


@dataclass
class VantageTree:
    """Nodes over centroids: a leaf lists centroids, an inner node has a vantage point and two halves."""

    centroids: np.ndarray
    members: list[np.ndarray] = field(default_factory=list)  # centroids compared at a node
    halves: list[list[tuple[int, float, float]]] = field(default_factory=list)  # (node, least, greatest distance)

    def __post_init__(self):
        if len(self.centroids):
            self._build(np.arange(len(self.centroids)))

    def _build(self, of: np.ndarray) -> int:
        node = len(self.members)
        self.members.append(of)
        self.halves.append([])
        if len(of) <= LEAF:
            return node
        # The centroid farthest from the others' middle sees them at the most different distances.
        points = self.centroids[of]
        spread = ((points - points.mean(0)) ** 2).sum(1)
        at = int(np.argmax(spread))
        vantage, rest = of[at], np.delete(of, at)
        away = np.sqrt(squares(self.centroids[rest], self.centroids[vantage]).astype(float))
        order = np.argsort(away, kind="stable")
        self.members[node] = of[at:at + 1]
        for half in np.array_split(order, 2):
            self.halves[node].append((self._build(rest[half]), float(away[half].min()), float(away[half].max())))
        return node

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of every row, ties to the smaller number."""
        step = max(1, CELLS // max(len(self.members), x.shape[1]))
        parts = [self._search(x[i:i + step]) for i in range(0, len(x), step)]
        number, distance = zip(*parts) if parts else ((np.empty(0, np.int64),), (np.empty(0, np.int64),))
        return np.concatenate(number), np.concatenate(distance)

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(x)
        number, distance = np.full(n, len(self.centroids)), np.full(n, np.iinfo(np.int64).max)
        bound = np.full((n, len(self.members)), np.inf)  # lower bounds of open nodes
        bound[:, 0] = 0.0
        rows = np.arange(n)
        while True:
            node = bound[rows].argmin(1)
            least = bound[rows, node]
            going = least <= np.sqrt(distance[rows].astype(float)) + SLACK
            rows, node, least = rows[going], node[going], least[going]
            if not len(rows):
                return number, distance
            bound[rows, node] = np.inf
            for v in np.unique(node):
                here = node == v
                at, low = rows[here], least[here]
                for c in self.members[v].tolist():
                    away = squares(x[at], self.centroids[c])
                    closer = (away < distance[at]) | ((away == distance[at]) & (c < number[at]))
                    distance[at[closer]], number[at[closer]] = away[closer], c
                if self.halves[v]:
                    away = np.sqrt(away.astype(float))
                    for child, least_in, most_in in self.halves[v]:
                        bound[at, child] = np.maximum(low, np.maximum(away - most_in, least_in - away))


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one point."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def _sums(table: DataFrame, tree: Callable[[], VantageTree], k: int, dim: int) -> dict[int, tuple[int, np.ndarray]]:
    """Vectors and component sums of every cluster that has vectors, summed in tasks first."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, t = np.zeros(k, np.int64), np.zeros((k, dim), np.int64), tree()
        for b in batches:
            x = _matrix(b.column(0), dim)
            number, _ = t.nearest(x)
            order = np.argsort(number, kind="stable")
            at = np.flatnonzero(np.diff(number[order], prepend=-1))
            if len(at):
                total[number[order][at]] += np.add.reduceat(x[order], at)
                n += np.bincount(number, minlength=k)
        has = np.flatnonzero(n)
        yield pa.record_batch({"cluster": pa.array(has, pa.int32()), "n": pa.array(n[has], pa.int64()),
                               "sums": pa.array(total[has].tolist(), pa.list_(pa.int64()))})

    rows = map_arrow(table.select("v"), part, "cluster int, n long, sums array<long>")
    found = (rows.select("cluster", "n", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at")
             .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
             .groupBy("cluster").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "s"))).alias("s")))
    return {r["cluster"]: (r["n"], np.array([x["s"] for x in r["s"]], np.int64)) for r in found.collect()}


def cluster_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64,
                    k: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """``[vec_id, cluster, distance]`` of every vector that takes part, and the final centroids.

    ``distance`` is the squared distance in scaled integers. The result is a written table.
    """
    spark = vectors.sparkSession
    table = written(whole_vectors(vectors, id_col, vector_col, dim, scale), "whole-vectors")
    centroids = first_vectors(table, k, dim, seed)

    def broadcast(c: np.ndarray) -> Callable[[], VantageTree]:
        shared = spark.sparkContext.broadcast(VantageTree(c))
        return lambda: shared.value

    for _ in range(rounds):
        moved = centroids.copy()
        for c, (n, s) in _sums(table, broadcast(centroids), len(centroids), dim).items():
            moved[c] = s // n  # floor, also below zero
        if np.array_equal(moved, centroids):
            break
        centroids = moved
    tree = broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number, distance = tree().nearest(_matrix(b.column(1), dim))
            yield pa.record_batch({"vec_id": b.column(0), "cluster": pa.array(number, pa.int32()),
                                   "distance": pa.array(distance, pa.int64())})

    out = map_arrow(table, assign, f"vec_id {dict(table.dtypes)['id']}, cluster int, distance long")
    return written(out, "clusters"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of its cluster.

    Only k rows are joined, by broadcast.
    """
    rows = assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # at most k rows
    total = sum(r["s"] for r in rows)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    each = assigned.sparkSession.createDataFrame(
        [(r["cluster"], r["s"], total, digest[r["cluster"]]) for r in rows],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(each), "cluster").select(
        *assigned.columns, "cluster_inertia", "inertia", "centroid_sha256")
