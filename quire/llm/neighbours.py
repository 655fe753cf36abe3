"""Nearest neighbours by a block matrix join: int8 tiles bound every distance, only survivors are computed in double."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quire.llm.store import stored

#: Rows of a block of queries and of a block of candidates, on average: a task holds one of each.
QUERY_ROWS, CANDIDATE_ROWS = 2048, 4096
#: Candidates of one int8 product.
STRIP = 1024
#: int8 products up to this many dimensions are exact sums in float32.
EXACT = 1024


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component finite."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
                                          ) & F.exists(vector, lambda x: x != 0)


def _quantised(vectors: np.ndarray):
    """int8 codes of unit vectors (as floats, for the product), scales, lengths of code and of error."""
    units = vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    scales = np.abs(units).max(axis=1) / 127
    codes = np.rint(units / scales[:, None]).astype(np.int8)
    rebuilt = codes * scales[:, None]
    length = np.sqrt(np.einsum("ij,ij->i", rebuilt, rebuilt))
    error = np.sqrt(np.einsum("ij,ij->i", units - rebuilt, units - rebuilt))
    return codes.astype(np.float32), scales, length, error


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 codes."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT):
        total += a[:, at:at + EXACT] @ b[:, at:at + EXACT].T
    return total


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed from the first component on, so that equal vectors give equal bits wherever they lie."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks])
    return flat.astype(np.float64).reshape(len(column), -1)


def _tile(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k nearest of one block of candidates for each query of a block."""
    schema = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not queries.num_rows or not candidates.num_rows:
        return schema.empty_table()
    own, ids = queries["vec_id"].to_numpy(), candidates["vec_id"].to_numpy()
    left, right = _matrix(queries["vector"]), _matrix(candidates["vector"])
    norms = _dot(left, left), _dot(right, right)
    codes, scales, lengths, errors = _quantised(left)
    heaps: list[list[tuple[float, int]]] = [[] for _ in own]
    floor = np.full(len(own), -np.inf)
    for at in range(0, len(ids), STRIP):
        part = slice(at, at + STRIP)
        c_codes, c_scales, _, c_errors = _quantised(right[part])
        close = _product(codes, c_codes) * scales[:, None] * c_scales
        # u.v - u'.v' = u'.(v - v') + (u - u').v, and |v| = 1
        slack = lengths[:, None] * c_errors + errors[:, None] + 1e-9
        close[own[:, None] == ids[part]] = -np.inf
        lower = close - slack
        if lower.shape[1] >= k:
            floor = np.maximum(floor, np.partition(lower, lower.shape[1] - k, axis=1)[:, lower.shape[1] - k])
        q, c = np.nonzero((close + slack >= floor[:, None]) & (close > -np.inf))
        c += at
        exact = np.empty(len(q))
        for some in range(0, len(q), 1 << 16):
            i, j = q[some:some + (1 << 16)], c[some:some + (1 << 16)]
            exact[some:some + (1 << 16)] = _dot(left[i], right[j]) / np.sqrt(norms[0][i] * norms[1][j])
        for i, score, vec in zip(q.tolist(), exact.tolist(), (-ids[c]).tolist()):
            heap = heaps[i]
            if len(heap) < k:
                heapq.heappush(heap, (score, vec))
            elif (score, vec) > heap[0]:
                heapq.heapreplace(heap, (score, vec))
        floor = np.array([max(f, h[0][0] - 1e-9) if len(h) == k else f for f, h in zip(floor, heaps)])
    rows = [(q, n, -vec, score) for q, n, heap in zip(own.tolist(), queries["query"].to_pylist(), heaps)
            for score, vec in heap]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)],
                                schema=schema) if rows else schema.empty_table()


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id",
            vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k rows of largest cosine, ties to the smaller id.

    `is_query` selects the queries by the column vec_id; candidates are all rows but those of the query's own id.
    Queries and candidates are dealt into blocks of bounded size by a hash, each pair of blocks is one task, and the
    nearest of a query's tasks are merged. The result is exact: a pair is left out of the double computation only if
    its int8 bounds show that k others of the block are nearer.

    Rows with null ids and vectors that are null, empty, zero or hold null or non-finite components take no part;
    vectors of different lengths are not compared. Rows equal in id and vector count once; if one id has several
    vectors, each is a candidate and each a query of its own. Queries have fewer rows if there are fewer candidates.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    rows = stored(rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct()
                  .withColumn("query", F.xxhash64("vec_id", "vector")), "vectors")
    asked = rows.filter(is_query)
    n_query = math.ceil(max(asked.count(), 1) / QUERY_ROWS)
    n_candidate = math.ceil(max(rows.count(), 1) / CANDIDATE_ROWS)

    def dealt(side, own, other, n_own, n_other):
        return side.select("*", F.size("vector").alias("length"),
                           F.expr(f"pmod(xxhash64(query, 1), {n_own})").alias(own),
                           F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)).cast("array<long>")).alias(other))

    key = ["length", "q_block", "c_block"]
    tiles = (dealt(asked, "q_block", "c_block", n_query, n_candidate).groupBy(key)
             .cogroup(dealt(rows, "c_block", "q_block", n_candidate, n_query).groupBy(key))
             .applyInArrow(lambda a, b: _tile(a, b, k), "query_id long, query long, vec_id long, score double"))
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (tiles.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
