"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Vectors are scaled by the largest norm and lifted to the unit sphere (one more coordinate), so that a
large inner product is a small angle. Several rotations are learned by iterative quantisation on a
bounded sample; the signs of the rotated coordinates are the code. A code is split into substrings of
eight bits, each indexed by value. A code within Hamming radius ``r`` of the query is, by the
pigeonhole principle, within ``r // m`` of it (or one less) in one of the ``m`` substrings, so probing
the values near the query's in every substring finds all codes within the radius. Those are kept that
are within the radius over the whole code, and ranked by the exact inner product of the floats.

The radius is calibrated on the sample: the quantile ``reach`` of the distances to true neighbours
there; neighbours in the whole table are nearer still. Where fewer than ``k`` codes of a shard are
within it, the radius grows there until there are ``k``, so every query gets its results.

Shards of the index meet blocks of queries in cells of fixed size: no cell depends on vector content,
so equal or clustered vectors make no hot key. Each cell returns its ``k`` best per query.

Defined cases: rows with a null id, and vectors that are null, empty, zero or hold null or non-finite
components, take no part; nor do vectors of another length than the most frequent one. Rows with
the query's id are not its candidates. Ties go to the smaller id. Repeated query rows are searched once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.session import stored

SAMPLE_ROWS = 20_000
ROTATIONS = 4
ROUNDS = 25
REACH = 0.97
SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
SUBSTRING_BITS = 8
_BYTE_DISTANCE = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])


@dataclass
class Hasher:
    """Learned rotations, the scale of norms, and the calibrated radius."""

    rotations: list[np.ndarray]
    largest_norm: float
    radius: int = 0

    def codes(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        lifted = lift(vectors, self.largest_norm, query)
        return np.packbits(np.concatenate([lifted @ r > 0 for r in self.rotations], axis=1), axis=1)


def lift(vectors: np.ndarray, largest_norm: float, query: bool) -> np.ndarray:
    """Unit vectors with one coordinate more; a query is only scaled to length one."""
    norms = np.linalg.norm(vectors, axis=1)
    if query:
        return np.column_stack([vectors / norms[:, None], np.zeros(len(vectors))])
    return np.column_stack([vectors / largest_norm, np.sqrt(np.maximum(0.0, 1 - (norms / largest_norm) ** 2))])


def learn(sample: np.ndarray, largest_norm: float, rotations: int = ROTATIONS, k: int = 20, reach: float = REACH, seed: int = 7) -> Hasher:
    """Iterative quantisation from ``rotations`` random starts, then the radius from exact neighbours in the sample."""
    lifted = lift(sample, largest_norm, False)
    bits = max(SUBSTRING_BITS, sample.shape[1] // SUBSTRING_BITS * SUBSTRING_BITS)
    found = []
    for start in range(rotations):
        turn = np.random.default_rng(seed + start).normal(size=(lifted.shape[1], bits))
        if bits <= lifted.shape[1]:
            turn = np.linalg.qr(turn)[0]
            for _ in range(ROUNDS):
                left, _, right = np.linalg.svd(lifted.T @ np.where(lifted @ turn > 0, 1.0, -1.0), full_matrices=False)
                turn = left @ right
        found.append(turn)
    hasher = Hasher(found, largest_norm)
    hasher.radius = bits * rotations
    if len(sample) > 1:
        chosen = np.arange(0, len(sample), max(1, len(sample) // 400))
        scores = sample[chosen] @ sample.T
        scores[np.arange(len(chosen)), chosen] = -np.inf
        near = np.argsort(-scores, axis=1)[:, :min(k, len(sample) - 1)]
        codes, asked = hasher.codes(sample), hasher.codes(sample[chosen], query=True)
        apart = np.bitwise_count(codes[near] ^ asked[:, None, :]).sum(2)
        hasher.radius = int(np.quantile(apart, reach))
    return hasher


class Shard:
    """The codes of a shard with, for every substring and value, a bitmap of the rows near that value."""

    def __init__(self, codes: np.ndarray, radius: int):
        self.codes, count = codes, codes.shape[1]
        each, more = divmod(radius, count)
        # if no substring j <= more were within `each`, and no later one within `each - 1`, the whole would be beyond the radius
        limits = [each if j <= more else each - 1 for j in range(count)]
        self.near = [np.packbits((_BYTE_DISTANCE <= limit)[:, codes[:, j]], axis=1) if limit >= 0 else None for j, limit in enumerate(limits)]

    def probe(self, code: np.ndarray) -> np.ndarray:
        hit = np.zeros((len(self.codes) + 7) // 8, np.uint8)
        for value, near in zip(code, self.near):
            if near is not None:
                hit |= near[value]
        return np.flatnonzero(np.unpackbits(hit, count=len(self.codes)))


def _matrix(column: pa.Array, kind) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), -1)


def _search_cell(radius: int, k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows and queries.num_rows:
            ids, vectors, codes = rows["vec_id"].to_numpy(), _matrix(rows["vector"], np.float32).astype(float), _matrix(rows["code"], np.uint8)
            shard = Shard(codes, radius)
            asked = _matrix(queries["q_code"], np.uint8)
            for query_id, key, vector, code in zip(queries["query_id"].to_numpy(), queries["query_key"].to_numpy(), _matrix(queries["q_vector"], np.float32).astype(float), asked):
                at = shard.probe(code)
                at = at[ids[at] != query_id]
                at = at[np.bitwise_count(codes[at] ^ code).sum(1, dtype=np.int32) <= radius]
                if len(at) < k:  # the nearest k codes of the shard, and all that are as near as the last of them
                    others = np.flatnonzero(ids != query_id)
                    apart = np.bitwise_count(codes[others] ^ code).sum(1, dtype=np.int32)
                    at = others if len(others) <= k else others[apart <= np.partition(apart, k - 1)[k - 1]]
                scores = (vectors[at] * vector).sum(1)
                best = np.lexsort((ids[at], -scores))[:k]
                out.append((np.full(len(best), query_id), np.full(len(best), key), ids[at][best], scores[best]))
        columns = [np.concatenate([o[i] for o in out]) if out else np.empty(0) for i in range(4)]
        return pa.table({n: pa.array(c.astype(t)) for n, c, t in zip(("query_id", "query_key", "vec_id", "score"), columns, (np.int64, np.int64, np.int64, float))})
    return run


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` (packed floats, little-endian) of the rows that take part."""
    values = F.col(vector).cast("array<double>")
    fine = F.coalesce(F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0), F.lit(False))
    rows = df.filter(F.col(vec_id).isNotNull() & fine).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<float>").alias("values"))
    common = rows.groupBy(F.size("values").alias("size")).count().orderBy(F.desc("count"), "size").first()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<f4")
            data = [x.tobytes() for x in flat.reshape(len(lists), -1)] if len(lists) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["vec_id", "vector"])

    return rows.filter(F.size("values") == (common["size"] if common else -1)).mapInArrow(pack, "vec_id long, vector binary")


def fit(rows: DataFrame, count: int, sample_rows: int = SAMPLE_ROWS, k: int = 20, **options) -> Hasher | None:
    """Learn on about ``sample_rows`` rows picked by the hash of their id, at most 1.5 times as many; the norm is taken over all."""
    picked = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < F.lit(int(min(1.0, sample_rows / max(count, 1)) * (1 << 20)))).limit(sample_rows * 3 // 2)
    sample = [np.frombuffer(r["vector"], "<f4") for r in picked.select("vector").collect()]
    sample = sample or [np.frombuffer(r["vector"], "<f4") for r in rows.select("vector").limit(1000).collect()]
    return learn(np.array(sample, float), largest_norm(rows), k=k, **options) if sample else None


def largest_norm(rows: DataFrame) -> float:
    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = max((float(np.linalg.norm(_matrix(b.column(0), "<f4").astype(float), axis=1).max()) for b in batches if len(b)), default=0.0)
        yield pa.RecordBatch.from_arrays([pa.array([top])], names=["norm"])

    return rows.select("vector").mapInArrow(norms, "norm double").agg(F.max("norm")).first()[0]


def index(rows: DataFrame, hasher: Hasher) -> DataFrame:
    """Every row with its code."""
    shared = rows.sparkSession.sparkContext.broadcast(hasher)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                vectors = _matrix(batch.column("vector"), "<f4").astype(float)
                codes, asked = shared.value.codes(vectors), shared.value.codes(vectors, query=True)
                packed = [pa.array([c.tobytes() for c in x], pa.binary()) for x in (codes, asked)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *packed], names=[*batch.schema.names, "code", "q_code"])

    return rows.mapInArrow(run, "vec_id long, vector binary, code binary, q_code binary")


def search(indexed: DataFrame, queries: DataFrame, hasher: Hasher, count: int, query_count: int, k: int = 20,
           shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query of ``queries`` (rows of an index) its ``k`` best among ``indexed``.

    The query set is laid against all rows in blocks: each cell holds at most about ``shard_rows`` rows
    and ``block_queries`` queries, however many there are of either.
    """
    shards, blocks = max(1, -(-count // shard_rows)), max(1, -(-query_count // block_queries))
    rows = indexed.select("vec_id", "vector", "code", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("q_vector"), "q_code").distinct()
    asked = asked.select("query_id", F.xxhash64("q_vector").alias("query_key"), "q_vector", "q_code",
                         F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    cells = rows.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(
        _search_cell(hasher.radius, k), "query_id long, query_key long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return cells.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(df: DataFrame, query_step: int, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, **options) -> DataFrame:
    """Fit, index every row, and search for the rows whose id is divisible by ``query_step``."""
    rows = stored(usable(df, vec_id, vector))
    count = rows.count()
    hasher = fit(rows, count, k=k, **options)
    if hasher is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    indexed = stored(index(rows, hasher))
    asked = indexed.filter(F.col("vec_id") % query_step == 0)
    return search(indexed, asked, hasher, count, asked.count(), k)
