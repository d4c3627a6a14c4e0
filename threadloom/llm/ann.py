"""Nearest neighbours by cosine over randomly rotated one-bit codes.

A vector of unit length o is rotated by a random orthogonal matrix and kept as the signs of its components, packed into
bits, and one correction scalar: the inner product c of the rotated vector with its sign vector x = signs / sqrt(dim).
For a unit query q the inner product <o, q> is estimated as <x, q'> / c, with q' the rotated query; its error is at
most `epsilon` * sqrt((1 - c*c) / (c*c)) / sqrt(dim - 1) but for a probability that falls with exp(-epsilon^2 / 2).
Within a block, vectors whose upper bound reaches the K-th greatest lower bound are reranked by the exact cosine, in
double precision on the original vectors; blocks give their K best, and the best of all blocks are returned.

Queries are a stated set, of every row whose id is divisible by a number. Rows are dealt into blocks of about
ROWS vectors, queries into blocks of about QUERIES; each pair of blocks is one task of bounded size.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, as queries or
as candidates; so do rows with a null id. Vectors of each length are searched among their own. Of rows with one id and
length, the least vector takes part; an id of several lengths asks with each and gets the nearest of all. A query with fewer candidates than K gets all of them; an empty table gives an empty result.
Ties go to the smaller id. Other columns are not read. Every row is indexed; the rotation needs no fitting.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from threadloom.llm.common import store

K = 5
EPSILON = 4.0
ROWS = 8192
QUERIES = 2048


@lru_cache(maxsize=4)
def rotation(dim: int, seed: int = 1) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(units: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors, and their correction scalars."""
    rotated = units @ matrix
    bits = np.packbits(rotated >= 0, axis=1)
    return bits, np.abs(rotated).sum(axis=1) / math.sqrt(units.shape[1])


def estimate(bits: np.ndarray, scalars: np.ndarray, rotated_queries: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x vectors) and the error bound of each vector."""
    dim = rotated_queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    products = rotated_queries.astype(np.float32) @ signs.T / math.sqrt(dim)
    # A little is added for the single precision of the products.
    error = epsilon * np.sqrt(np.maximum(0, 1 - scalars**2) / scalars**2) / math.sqrt(max(dim - 1, 1)) + 1e-4
    return products / scalars, error


def _in_order(products: np.ndarray) -> np.ndarray:
    """Sums of rows from first to last component, so that a pair has one score however vectors are blocked."""
    return products.cumsum(axis=1)[:, -1]


def search_block(ids, vectors, bits, scalars, query_ids, queries, matrix, k: int, epsilon: float):
    """(query, id, cosine) of the k nearest of the block for each query, with their exact cosines."""
    squares, query_squares = _in_order(vectors * vectors), _in_order(queries * queries)
    rotated = (queries / np.sqrt(query_squares)[:, None]) @ matrix
    out = []
    for start in range(0, len(queries), 128):
        part = slice(start, start + 128)
        near, error = estimate(bits, scalars, rotated[part], epsilon)
        for i, row in enumerate(near, start):
            own = ids == query_ids[i]
            lower = np.where(own, -np.inf, row - error)
            enough = np.partition(lower, -k)[-k] if len(lower) > k else -np.inf
            picked = np.flatnonzero((row + error >= enough) & ~own)
            cosines = _in_order(vectors[picked] * queries[i]) / np.sqrt(squares[picked] * query_squares[i])
            order = np.lexsort((ids[picked], -cosines))[:k]
            out += [(int(query_ids[i]), int(ids[picked[j]]), float(cosines[j])) for j in order]
    return out


def nearest(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = K,
    epsilon: float = EPSILON, rows: int = ROWS, queries: int = QUERIES, seed: int = 1,
) -> DataFrame:
    """(query_id, rank, id as `vec_id`, score): the k nearest of each row whose id is divisible by `every`."""
    v = F.col("v")
    valid = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    valid = valid.where(F.col("id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    valid = valid.withColumn("dim", F.size("v"))
    lengths = valid.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(F.col("id") % every == 0, 1)).alias("q"))
    blocks = lambda count, size: F.greatest(F.lit(1), F.ceil(F.col(count) / size)).cast("int")
    lengths = store(lengths.select(F.col("dim"), blocks("n", rows).alias("rbs"), blocks("q", queries).alias("qbs")), "lengths")

    def code(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                units = np.array(part.column("v").to_pylist())
                units /= np.abs(units).max(axis=1, keepdims=True)
                units /= np.sqrt((units * units).sum(axis=1, keepdims=True))
                bits, scalars = encode(units, rotation(int(dim), seed))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("v"), part.column("dim"), pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(scalars)],
                    names=["id", "v", "dim", "bits", "c"],
                )

    coded = valid.select("id", "v", "dim").mapInArrow(code, "id long, v array<double>, dim int, bits binary, c double")
    coded = store(coded, "codes").join(lengths, "dim")
    place = F.xxhash64("id")
    dealt = coded.withColumn("rb", F.pmod(place, "rbs").cast("int"))
    searched = dealt.withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qbs") - 1)))
    asked = coded.where(F.col("id") % every == 0).withColumn("qb", F.pmod(F.shiftright(place, 20), "qbs").cast("int"))
    asked = asked.select("id", "v", "dim", "qb", F.explode(F.sequence(F.lit(0), F.col("rbs") - 1)).alias("rb")).toDF("id", "v", "dim", "qb", "rb")
    searched = searched.select("id", "v", "dim", "bits", "c", "rb", "qb")

    def least(table: pa.Table) -> tuple[np.ndarray, list]:
        """One row per id, the one of the least vector, by id."""
        held = {}
        for r in zip(*(table.column(c).to_pylist() for c in table.column_names if c in ("id", "v", "bits", "c"))):
            if r[0] not in held or r[1] < held[r[0]][1]:
                held[r[0]] = r
        return [held[i] for i in sorted(held)]

    def search(_, left: pa.Table, right: pa.Table) -> pa.Table:
        candidates, wanted = least(left), least(right)
        found = []
        if candidates and wanted:
            bits = np.frombuffer(b"".join(r[2] for r in candidates), np.uint8).reshape(len(candidates), -1)
            found = search_block(
                np.array([r[0] for r in candidates]), np.array([r[1] for r in candidates]), bits, np.array([r[3] for r in candidates]),
                np.array([r[0] for r in wanted]), np.array([r[1] for r in wanted]), rotation(len(wanted[0][1]), seed), k, epsilon,
            )
        return pa.table({"query_id": pa.array([f[0] for f in found], pa.int64()), "vec_id": pa.array([f[1] for f in found], pa.int64()), "score": pa.array([f[2] for f in found], pa.float64())})

    block = ("dim", "rb", "qb")
    best = searched.groupBy(*block).cogroup(asked.groupBy(*block)).applyInArrow(search, "query_id long, vec_id long, score double")
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
