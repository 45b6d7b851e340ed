"""Queries against all rows in blocks: both sides dealt to the cells of a grid.

Each row of the grid is a block of queries, each column a shard of the candidates.  A cell
holds its query block (at most ``BLOCK`` rows on average) and streams its shard through in
tiles, so memory doesn't depend on either table; cells are independent tasks that can be
repeated anywhere.  Every cell hands on ``k`` rows per query, and lists are merged up a tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.scratch import prepare

BLOCK = 1_024
SHARD = 16_384
TILE_CELLS = 1 << 20
FAN = 16


def usable(vector: Column) -> Column:
    """A vector of at least one component, all present and finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def cells(rows: DataFrame, every: int, shards: int, blocks: int) -> DataFrame:
    """(cell, kind, vec_id, v): queries (kind 0) to all shards, candidates (1) to all blocks."""
    once = (
        rows.where(F.col("vec_id") % every == 0)
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .withColumn("kind", F.lit(0))
    )
    # The second hash keeps shards independent of how Spark deals the cells out.
    rest = (
        rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .withColumn("kind", F.lit(1))
    )
    cell = (F.col("shard") * blocks + F.col("block")).cast("long").alias("cell")
    columns = [cell, "kind", "vec_id", "v"]
    return once.select(*columns).unionByName(rest.select(*columns))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, float64 matrix) of the vectors of each length in a batch."""
    column, ids = batch.column("v"), batch.column("vec_id").to_numpy()
    lengths = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        if len(rows) == len(ids):
            yield ids, flat.reshape(len(ids), length)
        else:
            yield ids[rows], flat[starts[rows][:, None] + np.arange(length)]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(cell, kind, rows) for every stretch of equal cell and kind of the sorted input."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cell, kind = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
        turns = np.flatnonzero((np.diff(cell) != 0) | (np.diff(kind) != 0)) + 1
        edges = [0, *turns.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield int(cell[a]), int(kind[a]), batch.slice(a, b - a)


def task(best: Callable, score_type: pa.DataType):
    """Task function over sorted cells.  ``best(ids, matrix)`` makes the state of a query block
    with ``add(ids, matrix)`` for a tile of candidates and ``lists()`` for (id, [(neg, id)])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(states, cell):
            rows = [(q, top) for state in states for q, top in state.lists() if top]
            entry = pa.struct([("neg", score_type), ("vec_id", pa.int64())])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([q for q, _ in rows], pa.int64()),
                    pa.array([cell] * len(rows), pa.int64()),
                    pa.array(
                        [[{"neg": s, "vec_id": i} for s, i in top] for _, top in rows],
                        pa.list_(entry),
                    ),
                ],
                ["query_id", "cell", "top"],
            )

        now, asked, states = None, {}, {}
        for cell, kind, rows in _stretches(batches):
            if cell != now:
                if states:
                    yield out(states.values(), now)
                now, asked, states = cell, {}, {}
            for ids, matrix in _matrices(rows):
                width = matrix.shape[1]
                if kind == 0:
                    asked.setdefault(width, []).append((ids, matrix))
                    continue
                if width not in states:
                    if width not in asked:
                        continue  # no query of this length
                    parts = asked[width]
                    states[width] = best(
                        np.concatenate([p[0] for p in parts]), np.vstack([p[1] for p in parts])
                    )
                state = states[width]
                tile = max(1, TILE_CELLS // len(state.ids))
                for a in range(0, len(ids), tile):
                    state.add(ids[a : a + tile], matrix[a : a + tile])
        if states:
            yield out(states.values(), now)

    return run


def merged(lists: DataFrame, k: int, shards: int, blocks: int) -> DataFrame:
    """(query_id, top): lists of the cells merged ``FAN`` at a time, level by level."""
    level = lists.select("query_id", F.expr(f"cell div {blocks}").alias("node"), "top")
    width = shards
    while width > 1:
        level = (
            level.withColumn("node", F.expr(f"node div {FAN}"))
            .groupBy("query_id", "node")
            .agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
        )
        width = -(-width // FAN)
    return level.select("query_id", "top")


def top_lists(
    vectors: DataFrame, every: int, k: int, best: Callable, score: str, shard_rows: int = SHARD
) -> DataFrame:
    """(query_id, rank, vec_id, neg) of the ``k`` best candidates of every query.

    Queries are the rows whose vec_id is divisible by ``every``; all other ids compete.  Only
    the number of rows is read beforehand, to choose how finely the grid is cut.
    """
    spark = prepare(vectors.sparkSession)
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    number = vectors.count()
    shards = max(4 * spark.sparkContext.defaultParallelism, -(-number // shard_rows))
    blocks = max(1, -(-number // (every * BLOCK)))
    dealt = cells(rows, every, shards, blocks)
    arrow = {"long": pa.int64(), "double": pa.float64()}[score]
    lists = (
        dealt.repartition(shards * blocks, "cell")
        .sortWithinPartitions("cell", "kind")
        .mapInArrow(
            task(best, arrow), f"query_id long, cell long, top array<struct<neg:{score},vec_id:long>>"
        )
    )
    top = merged(lists, k, shards, blocks)
    return top.select("query_id", F.posexplode("top").alias("place", "hit")).select(
        "query_id",
        (F.col("place") + 1).alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        F.col("hit.neg").alias("neg"),
    )
