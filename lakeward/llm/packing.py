"""Pack tokenised documents into sequences: exact complements first, then best fit.

A piece matters to packing only by its length, and lengths are bounded by the capacity.  So
the corpus is reduced to one count per length, the plan is made on those counts (at most
``capacity`` numbers, whatever the input), and each piece finds its place from its rank among
the pieces of its length: no piece is compared with another.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.gather import Encoder, Layout, before_words
from lakeward.llm.scratch import prepare, stored
from lakeward.llm.text import as_bytes, blocks
from lakeward.llm.token_counts import FileEncoder

CAPACITY = 2048
END_ID = 0
# Bytes of text encoded together: fewer distinct words to look up than in smaller blocks.
BLOCK = 1 << 22
_RANKS = 1 << 44


@lru_cache(maxsize=1)
def _file_encoder(path: str) -> FileEncoder:
    return FileEncoder(path)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids): token ids of every whole text, cut at ``capacity``.

    ``ids`` holds unsigned 32-bit little-endian ids; id 0 ends every document, so an empty or
    null text is one piece of length 1.  Only documents longer than ``capacity`` are cut.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = _file_encoder(path)
        # What is remembered goes with the task: a worker that is used again starts empty.
        encoder = Encoder(lambda words: file.packed([w.decode() for w in words]))
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            for a, b in blocks(texts, BLOCK):
                ids, counts = _ids(file, encoder, texts[a:b])
                yield _cut(batch.column("doc_id").slice(a, b - a), ids, counts, capacity)
        file.forget()

    slim = docs.select(F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def _ids(
    file: FileEncoder, encoder: Encoder, texts: list[bytes]
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and the number of ids of each."""
    packed = file.whole(texts, BLOCK)
    rest = [i for i, ids in enumerate(packed) if ids is None]
    if rest:
        layout = Layout([texts[i] for i in rest])
        ids, counts = encoder.ids(*layout.pieces(before_words(layout)))
        ends, data = np.append(0, 4 * np.cumsum(counts)).tolist(), ids.tobytes()
        for i, start, end in zip(rest, ends, ends[1:]):
            packed[i] = data[start:end]
    lengths = np.fromiter(map(len, packed), np.int64, len(packed))
    return np.frombuffer(b"".join(packed), "<u4"), lengths // 4


def _cut(doc_id: pa.Array, ids: np.ndarray, counts: np.ndarray, capacity: int) -> pa.RecordBatch:
    """Pieces of documents whose ids follow each other in ``ids``, each closed by the end id."""
    ends = np.cumsum(counts)
    closed = np.insert(ids, ends, np.uint32(END_ID)).astype("<u4")
    lengths = counts + 1
    pieces = -(-lengths // capacity)
    owner = np.repeat(np.arange(len(counts)), pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = number * capacity
    size = np.minimum(lengths[owner] - starts, capacity)
    offsets = np.append(0, 4 * np.cumsum(size)).astype(np.int32)
    packed = pa.Array.from_buffers(
        pa.binary(), len(owner), [None, pa.py_buffer(offsets), pa.py_buffer(closed.tobytes())]
    )
    return pa.RecordBatch.from_arrays(
        [doc_id.take(pa.array(owner)), pa.array(number.astype(np.int32)), pa.array(starts),
         pa.array(size), packed],
        ["doc_id", "piece", "start", "length", "ids"],
    )


class _Stock:
    """Pieces left per length, and ways to fill a gap exactly with one, two or three of them."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()

    def pair(self, gap: int) -> tuple[int, ...] | None:
        if gap < 2:
            return None
        ways = np.minimum(self.left[1:gap], self.left[gap - 1 : 0 : -1])
        if gap % 2 == 0:
            ways[gap // 2 - 1] = self.left[gap // 2] // 2
        best = int(np.argmax(ways))
        return (best + 1, gap - best - 1) if ways[best] > 0 else None

    def triple(self, gap: int) -> tuple[int, ...] | None:
        if gap < 3:
            return None
        there = (self.left[: gap + 1] > 0).astype(np.float32)
        there[0] = 0
        sums = np.convolve(there, there)[: gap + 1] > 0.5
        for one in np.flatnonzero((there > 0) & sums[::-1])[::-1].tolist():
            self.left[one] -= 1
            rest = self.pair(gap - one)
            self.left[one] += 1
            if rest:
                return (one, *rest)
        return None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        if gap <= 0:
            return () if gap == 0 else None
        if self.left[gap] > 0:
            return (gap,)
        return self.pair(gap) or self.triple(gap)

    def largest(self, gap: int) -> int:
        fits = np.flatnonzero(self.left[1 : gap + 1])
        return int(fits[-1]) + 1 if fits.size else 0

    def use(self, lengths: tuple[int, ...]) -> int:
        kinds, each = np.unique(lengths, return_counts=True)
        times = int((self.left[kinds] // each).min())
        self.left[kinds] -= times * each
        return times


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of one sequence, how many such sequences)] that use every piece once.

    Longest pieces first: as long as one, two or three other pieces fill the rest of a sequence
    exactly, that combination is used as often as the counts allow.  What remains is packed by
    best fit: the longest piece that fits, again and again, ending exactly where a combination
    does.  Every step uses some length up, so the steps are bounded by the capacity.
    """
    stock, out = _Stock(counts), []

    def take(lengths):
        out.append((tuple(lengths), stock.use(tuple(lengths))))

    if stock.left[capacity]:
        take([capacity])
    for length in range(capacity - 1, 0, -1):
        while stock.left[length]:
            stock.left[length] -= 1
            rest = stock.exact(capacity - length)
            stock.left[length] += 1
            if rest is None:
                break
            take((length, *rest))
    while stock.left.any():
        chosen, gap = [], capacity
        while gap:
            rest = stock.exact(gap) if chosen else None
            more = rest or (stock.largest(gap),)
            if not more[0]:
                break
            for length in more:
                stock.left[length] -= 1
                chosen.append(length)
                gap -= length
        for length in chosen:
            stock.left[length] += 1
        take(chosen)
    return out


def _slots(patterns, capacity: int):
    """Sorted keys (length and first rank) of every slot, its first sequence and its offset."""
    used, key, sequence, offset, base = np.zeros(capacity + 1, np.int64), [], [], [], 0
    for lengths, times in patterns:
        place = 0
        for length in lengths:
            key.append(length * _RANKS + int(used[length]))
            sequence.append(base)
            offset.append(place)
            used[length] += times
            place += length
        base += times
    order = np.argsort(np.array(key, np.int64))
    return tuple(np.array(x, np.int64)[order] for x in (key, sequence, offset))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """All columns of ``pieces`` with ``sequence_id`` and ``offset`` added.

    ``pieces`` has a column ``length`` between 1 and ``capacity``.  Every row is placed once and
    the rows of a sequence follow each other from 0 without gaps.  Equal rows are separate
    pieces.  Rows are numbered within their partition and length as they are stored, and the
    partitions' counts are added up per length; so a length that holds a third of all rows
    needs no sort and no common task.  The driver sees one count per length.
    """
    spark = prepare(pieces.sparkSession)
    names = pieces.columns
    columns = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, part = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            order = np.argsort(lengths, kind="stable")
            ordered = lengths[order]
            rank = np.empty(len(lengths), np.int64)
            rank[order] = np.arange(len(lengths)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(lengths, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(lengths), part, np.int32)), pa.array(rank)],
                [*batch.schema.names, "_part", "_rank"],
            )

    rows = stored(pieces.mapInArrow(number, f"{columns}, _part int, _rank long"), "pieces")
    parts = stored(rows.groupBy("_part", "length").agg(F.count("*").alias("_n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for row in parts.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    key, sequence, offset = _slots(plan(counts, capacity), capacity)

    # What is ahead of a partition, one list of numbers by length for each partition.
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = parts.select(
        "_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    first = ahead.groupBy("_part").agg(
        F.map_from_entries(F.collect_list(F.struct("length", "_first"))).alias("_firsts")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("_rank").to_numpy()
            own = batch.column("length").to_numpy() * _RANKS + rank
            slot = np.searchsorted(key, own, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array(sequence[slot] + own - key[slot]),
                    pa.array(offset[slot]),
                ],
                [*names, "sequence_id", "offset"],
            )

    ranked = rows.join(first, "_part").withColumn("_rank", F.col("_rank") + F.col("_firsts")[F.col("length")])
    return ranked.select(*names, "_rank").mapInArrow(
        place, f"{columns}, sequence_id long, offset long"
    )
