"""Nearest neighbours by inner product: a block matrix join with int8 tiles.

Vectors are quantised to int8 with one scale each, and each keeps the exact
length of its quantisation error. A query block meets a candidate block in
one task; tiles of int8 products give every approximate product, and the
error lengths bound how far the exact one can be off. Pairs whose upper bound
is below the query's ``k``-th best lower bound so far cannot be in the
result; the surviving pairs are recomputed in double precision on the
original vectors, and heaps of ``k`` entries per query merge the tiles of a
task. The tasks' heaps meet in a ranking by query. The result is exact.

Equal vectors are compared once: of those in a block, only the ``k`` + 1
smallest ids can be among a query's ``k`` nearest (ties go to smaller ids),
so a vector that many rows share makes no extra pairs.

Every row in a block of the grid is dealt by the hash of its id; ids are
unique after rows of one id have been reduced to one, so blocks stay near
their nominal sizes. Queries and candidates are replicated along the grid
(rows x blocks), never broadcast.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows with a null id; of several rows of one
id the smallest vector (as Spark orders arrays) counts; vectors of different
lengths are never compared; with fewer than ``k`` candidates all are
returned; an empty table gives an empty result. Only the id and the vector
are read, so other columns may have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

K = 20
#: Rows of a query block and of a candidate block of the grid; tiles within a task.
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 16384
QUERY_TILE, CANDIDATE_TILE = 256, 4096


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, lengths of the rows and of their quantisation errors."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1.0  # only where a component is too small to divide
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(x, axis=1), np.linalg.norm(x - q * scale[:, None], axis=1)


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of the rows, added up from the first component on."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * y[:, d]
    return total


def _tile_bounds(q: tuple, c: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Approximate products of a tile and how far each may be from the exact one."""
    (qi, qs, qn, qe), (ci, cs, cn, ce) = q, c
    kind = np.float32 if qi.shape[1] * 127 * 127 < 1 << 24 else np.float64  # whole numbers stay exact
    near = (qi.astype(kind) @ ci.astype(kind).T).astype(np.float64) * qs[:, None] * cs[None, :]
    # <q,c> - <q',c'> = <q - q', c> + <q', c - c'>, and |q'| <= |q| + |q - q'|
    slack = qe[:, None] * cn[None, :] + (qn + qe)[:, None] * ce[None, :]
    return near, slack * (1 + 1e-9) + 1e-12 * (qn[:, None] * cn[None, :])


def nearest(q_ids: np.ndarray, q: np.ndarray, ids: list[np.ndarray], c: np.ndarray, k: int) -> Iterator[tuple[int, list]]:
    """The ``k`` best (score, -id) of each query among distinct vectors ``c``, each with its ascending ids."""
    quantised = quantise(c)
    for at in range(0, len(q), QUERY_TILE):
        part = slice(at, at + QUERY_TILE)
        mine = quantise(q[part])
        heaps: list[list] = [[] for _ in range(len(q[part]))]
        floor = np.full(len(heaps), -np.inf)
        for lo in range(0, len(c), CANDIDATE_TILE):
            tile = slice(lo, lo + CANDIDATE_TILE)
            near, slack = _tile_bounds(mine, tuple(x[tile] for x in quantised))
            # Of k + 1 vectors one may be the query's own.
            low = near - slack
            if low.shape[1] > k + 1:
                floor = np.maximum(floor, np.partition(low, -(k + 1), axis=1)[:, -(k + 1)])
            row, col = np.nonzero(near + slack >= floor[:, None])
            for start in range(0, len(row), 1 << 16):
                r, j = row[start:start + (1 << 16)], col[start:start + (1 << 16)] + lo
                scores = exact(q[part][r], c[j])
                for a, b, s in zip(r.tolist(), j.tolist(), scores.tolist()):
                    heap, own = heaps[a], q_ids[at + a]
                    if len(heap) == k and s < heap[0][0]:
                        continue
                    for i in ids[b].tolist():
                        if i != own:
                            if len(heap) < k:
                                heapq.heappush(heap, (s, -i))
                            elif (s, -i) > heap[0]:
                                heapq.heapreplace(heap, (s, -i))
                            else:
                                break
            floor = np.maximum(floor, [h[0][0] if len(h) == k else -np.inf for h in heaps])
        for a, heap in enumerate(heaps):
            yield int(q_ids[at + a]), heap


def _distinct(ids: np.ndarray, x: np.ndarray, most: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows and of each the ``most`` smallest ids, ascending."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], np.ascontiguousarray(x[order])
    whole = x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, first, which = np.unique(whole, return_index=True, return_inverse=True)
    by = np.argsort(which, kind="stable")
    cuts = np.searchsorted(which[by], np.arange(1, len(first)))
    return [ids[g][:most] for g in np.split(by, cuts)], x[first]


def _join_blocks(k: int):
    def rows(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        flat = block.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return block.column("id").to_numpy(), flat.astype(np.float64).reshape(max(block.num_rows, 1), -1)

    def run(asked: pa.Table, there: pa.Table) -> pa.Table:
        (q_ids, q), (c_ids, c) = rows(asked), rows(there)
        found = []
        if len(q_ids) and len(c_ids):
            ids, distinct = _distinct(c_ids, c, k + 1)
            found = [(i, -n, s) for i, heap in nearest(q_ids, q, ids, distinct, k) for s, n in heap]
        cols = list(zip(*found)) or [(), (), ()]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                              names=["query_id", "vec_id", "score"])
    return run


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
           query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """The ``k`` nearest other rows of each query row: query_id, rank, vec_id, score.

    ``is_query`` is a condition on a column ``id``.
    """
    x = F.col("x")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("id").isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x"))
    rows = cut(rows.where(F.coalesce(usable, F.lit(False))).groupBy("id").agg(F.min("x").alias("x")).withColumn("dim", F.size("x")))
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    over, down = max(1, -(-n // candidate_block)), max(1, -(-n_queries // query_block))
    deal = lambda blocks, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asked = rows.where(is_query).select("id", "x", "dim", deal(down, 1).alias("qb"), every(over).alias("cb"))
    there = rows.select("id", "x", "dim", deal(over, 2).alias("cb"), every(down).alias("qb"))
    pairs = asked.groupBy("dim", "qb", "cb").cogroup(there.groupBy("dim", "qb", "cb"))
    found = pairs.applyInArrow(_join_blocks(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
