"""Nearest neighbours by int8 product tiles with error bounds, survivors recomputed in double."""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.grid import top_lists

# Room for rounding in the bounds themselves; far above what doubles lose here.
SLACK = 1e-9


class _Coded:
    """Unit vectors as int8 codes, one step width each, and the length of what codes miss."""

    def __init__(self, matrix: np.ndarray):
        square = np.zeros(len(matrix))
        for column in matrix.T:  # in order, as a sum over a list adds up
            square += column * column
        self.norm = np.sqrt(square)
        unit = matrix / self.norm[:, None]
        step = np.abs(unit).max(axis=1, keepdims=True) / 127.0
        code = np.rint(unit / step)
        self.codes, self.step = code.astype(np.int8), step[:, 0]
        rest = unit - code * step
        self.missed = np.sqrt((rest * rest).sum(axis=1))


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whole-number products of int8 codes: exact in single precision up to 1,040 components."""
    kind = np.float32 if left.shape[1] * 127 * 127 < 2**24 else np.float64
    return left.astype(kind) @ right.astype(kind).T


class _Nearest:
    """A heap of the ``k`` nearest per query of a block."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int):
        self.ids, self.matrix, self.k = ids, matrix, k
        self.coded = _Coded(matrix)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.limit = np.full(len(ids), -np.inf)

    def add(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, matrix = ids[order], matrix[order]
        own, other = self.coded, _Coded(matrix)
        near = _products(own.codes, other.codes) * own.step[:, None] * other.step[None, :]
        # |uw - qp| <= |u - q||w| + |q||w - p|, with |w| = 1 and |q| <= 1 + |u - q|.
        error = own.missed[:, None] + (1.0 + own.missed[:, None]) * other.missed[None, :] + SLACK
        same = self.ids[:, None] == ids[None, :]
        lower = np.where(same, -np.inf, near - error)
        take = min(self.k, len(ids))
        sure = np.partition(lower, len(ids) - take, axis=1)[:, len(ids) - take]
        if take < self.k:
            sure = np.full(len(self.ids), -np.inf)
        limit = np.maximum(self.limit, sure)
        q, c = np.nonzero((near + error >= limit[:, None]) & ~same)
        score = np.zeros(len(q))
        for left, right in zip(self.matrix.T, matrix.T, strict=True):
            score += left[q] * right[c]
        score /= own.norm[q] * other.norm[c]
        # Columns are in order of ids, and the sort keeps that order among equal scores.
        best = np.lexsort((c, -score, q))
        q, c, score = q[best], c[best], score[best]
        place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        first = place < self.k
        for i, s, j in zip(
            q[first].tolist(), score[first].tolist(), ids[c[first]].tolist(), strict=True
        ):
            heap, entry = self.heaps[i], (s, -j)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.limit[i] = heap[0][0]

    def lists(self):
        for query, heap in zip(self.ids.tolist(), self.heaps, strict=True):
            yield query, sorted((-s, -i) for s, i in heap)


def nearest(
    vectors: DataFrame, k: int = 5, every: int = 50, shard_rows: int = 16_384
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest cosines of each query, in double.

    ``vectors`` has ``vec_id`` and ``embedding``.  Codes only rule pairs out: a pair is dropped
    when its cosine plus the error bound is below what ``k`` other pairs surely reach, so the
    result is exact and equals brute force.  Queries, ties, repeated rows, null ids and vectors
    of different lengths are treated as in :func:`lakeward.llm.exact_topk.exact_top_k`; vectors
    whose norm is zero or not finite take no part either.
    """
    square = F.aggregate(
        F.col("v"), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    slim = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").alias("v")).where(
        (square > 0) & (square < F.lit(float("inf")))
    )
    found = top_lists(slim, every, k, partial(_Nearest, k=k), "double", shard_rows)
    return found.select("query_id", "rank", "vec_id", (-F.col("neg")).alias("score"))
