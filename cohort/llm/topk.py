"""Exact top-k inner products: norm-sorted blocks, rotated partial sums, Cauchy-Schwarz bounds.

Vectors become integers floor(scale * x). The second-moment matrix, summed by Spark, gives
a rotation (the right singular vectors of all vectors) that packs length into the leading
coordinates. Vectors are dealt by range in falling length into blocks; queries likewise.

A query starts with the k-th best exact score over the block of longest vectors. A block
pair is looked at only if (longest vector) * (query length) can reach that score. Inside a pair,
runs of vectors are taken in falling length; the product of the ``lead`` leading coordinates
plus the product of the residual lengths bounds the score, and only vectors whose bound
reaches the query's k-th best so far are multiplied out, in exact integer arithmetic. The
threshold rises from run to run. Bounds get a slack far above rounding error, and ties pass,
so the result is exact.

Memory: a block pair holds less than 2 * (``BLOCK`` + ``QUERY_BLOCK``) vectors. Only one block (for the first
thresholds) and the d x d moment matrix pass through the driver. Which blocks meet is worked
out on block summaries; payloads then follow in two equi-joins.

Defined results: vectors that are null or hold a null or non-finite component, and rows without an
id, take no part; shorter vectors are padded with zeros; rows that repeat an id all stay: each is
a candidate of its own for other ids, and rows of one query id share its ranks; an empty table gives no
rows; scores beyond 64 bits raise.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort.llm.common import map_arrow, pick, written

BLOCK, QUERY_BLOCK, RUN = 4096, 512, 512
SHARDS = 16
PAIRS = 4  # block pairs a task should get
DENSE = 0.02  # share of a run's pairs from which they are multiplied as a whole
_BLOCK = "block long, ids binary, vectors binary, longest double"


def cleaned(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``[id, v, norm2]``: whole-number components as doubles (exact)."""
    src = pick(vectors, id=id_col, v=vector_col)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ok = src.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.forall("v", finite))
    # rint of floor keeps doubles: floor() itself would cut to 64 bits.
    whole = lambda x: F.rint(x.cast("double") * scale - F.pmod(x.cast("double") * scale, F.lit(1.0)))
    return (ok.select("id", F.transform("v", whole).alias("v"))
               .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows padded with zeros to ``dim``."""
    out = np.zeros((len(column), dim))
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out[np.arange(dim) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def moments(table: DataFrame, dim: int) -> np.ndarray:
    """Sum of x x^T over all vectors, by task and then by matrix row."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            m = _matrix(b.column(0), dim)
            total += m.T @ m
        yield pa.record_batch({"i": pa.array(range(dim), pa.int32()), "row": pa.array([r.tobytes() for r in total], pa.binary())})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "row": [sum(map(np.frombuffer, pdf["row"])).tobytes()]})

    rows = (map_arrow(table.select("v"), part, "i int, row binary").groupBy("i")
            .applyInPandas(add, "i int, row binary").collect())
    return np.array([np.frombuffer(r["row"]) for r in sorted(rows, key=lambda r: r["i"])])


def blocks(table: DataFrame, dim: int, size: int, count: int) -> DataFrame:
    """Blocks of vectors in falling length; ties by id, so equal vectors spread too.

    Range partitions are cut into chunks of at most ``size`` vectors. A block is all chunks whose first
    vector falls into the same ``size`` places of the whole order: less than 2 * ``size`` vectors and at most
    ``count / size`` + 1 blocks, however many partitions there are. One row a partition is collected.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, place = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out(ids: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch({"part": pa.array([part], pa.int32()), "place": pa.array([place], pa.int64()),
                                    "n": pa.array([len(ids)], pa.int64()), "ids": pa.array([ids.tobytes()], pa.binary()),
                                    "vectors": pa.array([m.tobytes()], pa.binary()),
                                    "longest": pa.array([float(np.sqrt((m * m).sum(1).max()))])})

        for b in batches:
            held.append((b.column(0).to_numpy(), _matrix(b.column(1), dim)))
            ids, m = (np.concatenate(x) for x in zip(*held))
            while len(ids) >= size:
                yield out(ids[:size], m[:size])
                place += size
                ids, m = ids[size:], m[size:]
            held = [(ids, m)]
        if held and len(held[0][0]):
            yield out(*held[0])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["part", "place"])
        return pd.DataFrame({"block": pdf["block"].iloc[:1].to_numpy(), "ids": [b"".join(pdf["ids"])],
                             "vectors": [b"".join(pdf["vectors"])], "longest": [pdf["longest"].max()]})

    parts = max(1, -(-count // (16 * size)))
    src = table.withColumn("id", F.col("id").cast("long"))
    ordered = (src.repartitionByRange(parts, F.col("norm2").desc(), F.col("id"))
                  .sortWithinPartitions(F.col("norm2").desc(), F.col("id")))
    chunks = written(map_arrow(ordered.select("id", "v"), cut,
                               "part int, place long, n long, ids binary, vectors binary, longest double"), "chunks")
    before, offsets = 0, []
    for r in sorted(chunks.groupBy("part").agg(F.sum("n").alias("n")).collect(), key=lambda r: r["part"]):
        offsets.append((r["part"], before))
        before += r["n"]
    starts = F.broadcast(table.sparkSession.createDataFrame(offsets, "part int, start long"))
    block = F.floor((F.col("start") + F.col("place")) / size).cast("long")
    return (chunks.join(starts, "part").select(block.alias("block"), "part", "place", "ids", "vectors", "longest")
                  .groupBy("block").applyInPandas(join, _BLOCK))


def _unpack(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(vectors).reshape(len(i), dim)


def _in_doubles(q: np.ndarray, v: np.ndarray) -> bool:
    """Whether every sum of products stays a whole number that doubles hold."""
    return float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1] < 2.0 ** 53


def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row-wise integer inner products; doubles while they are exact, Python integers beyond."""
    if not len(q):
        return np.empty(0, np.int64)
    if _in_doubles(q, v):
        return np.einsum("ij,ij->i", q, v).astype(np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(x, y)) for x, y in zip(q, v)]
    return np.array(whole, np.int64)


def best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best: highest score, then smallest id."""
    order = np.lexsort((ids, -scores, query))
    q = query[order]
    first = np.searchsorted(q, q, "left")
    return order[np.arange(len(q)) - first < k]


class Search:
    """One block of queries against blocks of vectors."""

    def __init__(self, rotation: np.ndarray, k: int):
        self.rotation, self.k, self.lead = rotation, k, max(1, len(rotation) // 4)

    def run(self, qi: np.ndarray, q: np.ndarray, vi: np.ndarray, v: np.ndarray, floor: np.ndarray):
        """(query position, vec id, score) of the k best at or above ``floor`` per query."""
        lead, k = self.lead, self.k
        qr, vr = q @ self.rotation, v @ self.rotation
        qn, vn = np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1))
        q_rest, v_rest = np.sqrt((qr[:, lead:] ** 2).sum(1)), np.sqrt((vr[:, lead:] ** 2).sum(1))
        floor = floor.copy()
        found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
        for at in range(0, len(vi), RUN):
            part = slice(at, at + RUN)
            slack = 1.0 + 1e-9 * qn * vn[part].max()
            alive = np.flatnonzero(qn * vn[part].max() + slack >= floor)
            if not len(alive):
                break  # later vectors are shorter
            bound = qr[alive, :lead] @ vr[part, :lead].T + q_rest[alive, None] * v_rest[part]
            near, b = np.nonzero((bound + slack[alive, None] >= floor[alive, None])
                                 & (qi[alive, None] != vi[part]))
            a = alive[near]
            if len(a) > DENSE * bound.size and _in_doubles(q[alive], v[part]):
                # Many survivors: one product of whole numbers is cheaper than gathering rows, and as exact.
                scores = (q[alive] @ v[part].T)[near, b].astype(np.int64)
            else:
                scores = np.concatenate([exact(q[a[i:i + 65536]], v[at + b[i:i + 65536]])
                                         for i in range(0, len(a), 65536)] or [np.empty(0, np.int64)])
            b = b + at
            found = tuple(np.concatenate(x) for x in zip(found, (a, vi[b], scores)))
            keep = best(*found, k)
            found = tuple(x[keep] for x in found)
            # A query with k results needs at least its k-th score from now on.
            n = np.bincount(found[0], minlength=len(qi))
            last = np.full(len(qi), np.inf)
            np.minimum.at(last, found[0], found[2].astype(float))
            floor = np.where(n >= k, np.maximum(floor, last), floor)
        return found, floor


def top_inner_products(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
                       every: int = 50, scale: int = 256) -> DataFrame:
    """``[query_id, rank, vec_id, score]`` for the rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    sc = spark.sparkContext
    out = "query_id long, vec_id long, score long"
    # Rebalanced, so that many small input splits become few tasks and one large split several.
    table = written(cleaned(vectors, id_col, vector_col, scale).hint("rebalance"), "vectors")
    row = table.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"),
                    F.count_if(F.col("id") % every == 0).alias("queries")).first()
    if not row["queries"] or row["n"] < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = max(1, row["dim"])
    rotation = np.linalg.eigh(moments(table, dim))[1][:, ::-1].copy()
    v_blocks = written(blocks(table, dim, BLOCK, row["n"]), "blocks")
    first = v_blocks.orderBy("block").limit(1).first()  # one block
    shared = sc.broadcast((Search(rotation, k), bytes(first["ids"]), bytes(first["vectors"])))

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, ids, vecs = shared.value
        vi, v = _unpack(ids, vecs, dim)
        for b in batches:
            for r in b.to_pylist():
                qi, q = _unpack(r["ids"], r["vectors"], dim)
                _, floor = search.run(qi, q, vi, v, np.full(len(qi), -np.inf))
                length = np.sqrt((q * q).sum(1))
                # The shortest vector length that can still reach a query's floor.
                need = np.where(floor > 0, floor / np.maximum(length, 1e-300), 0.0).min() if len(qi) else 0.0
                yield pa.record_batch({"q": pa.array([r["block"]], pa.int64()), "q_ids": pa.array([r["ids"]], pa.binary()),
                                       "q_vectors": pa.array([r["vectors"]], pa.binary()),
                                       "floors": pa.array([floor.tobytes()], pa.binary()),
                                       "need": pa.array([float(need)])})

    q_blocks = written(map_arrow(blocks(table.where(F.col("id") % every == 0), dim, QUERY_BLOCK, row["queries"]), start,
                                 "q long, q_ids binary, q_vectors binary, floors binary, need double"), "queries")
    shard = F.pmod(F.xxhash64("block"), F.lit(SHARDS)).cast("int").alias("shard")
    all_shards = F.explode(F.sequence(F.lit(0), F.lit(SHARDS - 1))).alias("shard")
    pairs = (q_blocks.select("q", "need", all_shards).join(v_blocks.select("block", "longest", shard), "shard")
                     .where(F.col("longest") * (1 + 1e-9) >= F.col("need")).select("q", "block"))

    def search_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = shared.value[0]
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                qi, q = _unpack(r["q_ids"], r["q_vectors"], dim)
                vi, v = _unpack(r["ids"], r["vectors"], dim)
                (at, ids, scores), _ = search.run(qi, q, vi, v, np.frombuffer(r["floors"]))
                yield pa.record_batch({"query_id": pa.array(qi[at]), "vec_id": pa.array(ids), "score": pa.array(scores)})

    pairs = written(pairs, "block-pairs")
    payload = (pairs.join(v_blocks.select("block", "ids", "vectors"), "block")
               .join(q_blocks.select("q", "q_ids", "q_vectors", "floors"), "q")
               # Few bytes but much work: a fixed number of tasks, which is not merged by size.
               .repartition(max(1, -(-pairs.count() // PAIRS)), "q", "block"))
    found = map_arrow(payload.select("q_ids", "q_vectors", "floors", "ids", "vectors"), search_pairs, out)
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
