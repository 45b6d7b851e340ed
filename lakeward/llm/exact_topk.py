"""Exact top-k search by integer inner product: tiled matrix products, selection per tile."""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.grid import top_lists

# Below every score, and still with a negative.
_LOWEST = np.iinfo(np.int64).min + 1


class _Best:
    """Running best ``k`` of a block of queries; ties go to the smaller id."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, scale: float, k: int):
        self.ids, self.k, self.scale = ids, k, scale
        self.matrix = np.floor(matrix * scale)
        self.scores = np.full((len(ids), 0), 0, np.int64)
        self.found = np.full((len(ids), 0), 0, np.int64)

    def _product(self, tile: np.ndarray) -> np.ndarray:
        bound = np.abs(self.matrix).max() * np.abs(tile).max() * tile.shape[1]
        if bound < 2**53:  # every partial sum is a whole number that a double holds
            return (self.matrix @ tile.T).astype(np.int64)
        return self.matrix.astype(np.int64) @ tile.T.astype(np.int64)

    def add(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, tile = ids[order], np.floor(matrix[order] * self.scale)
        scores = self._product(tile)
        scores[self.ids[:, None] == ids[None, :]] = _LOWEST
        take = min(self.k, len(ids))
        # Select on scores; where more than fit tie with the last one, the first ids win.
        last = -np.partition(-scores, take - 1, axis=1)[:, take - 1 : take]
        above, level = scores > last, scores == last
        room = take - above.sum(axis=1, keepdims=True)
        keep = above | (level & (np.cumsum(level, axis=1) <= room))
        columns = np.nonzero(keep)[1].reshape(len(self.ids), take)
        scores = np.hstack([self.scores, np.take_along_axis(scores, columns, axis=1)])
        found = np.hstack([self.found, ids[columns]])
        best = np.lexsort((found, -scores), axis=-1)[:, : self.k]
        self.scores = np.take_along_axis(scores, best, axis=1)
        self.found = np.take_along_axis(found, best, axis=1)

    def lists(self):
        for query, scores, found in zip(
            self.ids.tolist(), self.scores.tolist(), self.found.tolist(), strict=True
        ):
            yield query, [(-s, i) for s, i in zip(scores, found, strict=True) if s != _LOWEST]


def exact_top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, shard_rows: int = 16_384
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest integer inner products of each query.

    ``vectors`` has ``vec_id`` and ``embedding``.  Components become floor(scale * x); queries
    are the ids divisible by ``every``, candidates all rows of another id.  Equal scores rank
    by smaller id.  Vectors that are null or empty or hold a null or non-finite component take
    no part, nor do rows without an id; vectors of different lengths never meet.  A candidate
    row stored twice counts twice; a repeated query id is asked once, with its smallest vector.
    Sums are exact below 2**63.
    """
    slim = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").alias("v"))
    found = top_lists(slim, every, k, partial(_Best, scale=scale, k=k), "long", shard_rows)
    return found.select("query_id", "rank", "vec_id", (-F.col("neg")).alias("score"))
