"""Periodic runs of words: stretches of a text that repeat themselves from a period on.

A stretch ``[a, a + d + m)`` of period ``d`` that no neighbour extends is a pair of equal
passages of ``m`` words at ``a`` and ``a + d`` that differ in the word before and the word after:
a maximal pair whose distance is at most its length.  Such pairs are enumerated bottom-up in the
tree of LCP intervals of a text's suffixes.  An interval keeps the places of its passage in order,
listed by classes of the word before, so that places with the same word before are passed over
together; a pair from two parts of an interval differs in the word after by itself.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.gather import gathered
from lakeward.llm.scratch import prepare
from lakeward.llm.text import Words, as_bytes, blocks, mix, runs, symbols

MIN_LENGTH = 12
# A run of MIN_LENGTH words and two periods repeats at least half of it.
HALF = MIN_LENGTH // 2
RUNS = "array<struct<start: long, length: long, period: long>>"
_RUN_TYPE = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes, words that each shares with the one before it).

    Ranks are refined by doubling, only where they still tie; the ranks of every depth are kept
    (32 bits a word for each power of two up to the longest repeat) to read off shared lengths.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    firsts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    rank = np.empty(n + 1, np.int32)
    rank[order] = np.repeat(firsts, np.diff(np.append(firsts, n)))
    rank[n] = -1
    sizes = np.repeat(np.diff(np.append(firsts, n)), np.diff(np.append(firsts, n)))
    open_, width, depths = order[sizes > 1], 1, []
    while True:
        depths.append((width, rank.copy()))
        if not open_.size:
            break
        after = rank[np.minimum(open_ + width, n)]
        key = rank[open_].astype(np.int64) << 32 | (after + 1)
        turn = np.argsort(key, kind="stable")
        open_, key = open_[turn], key[turn]
        place = np.arange(len(open_))
        fresh = np.append(True, key[1:] != key[:-1])
        firsts = np.maximum.accumulate(np.where(fresh, place, 0))
        head = np.append(True, (key[1:] >> 32) != (key[:-1] >> 32))
        heads = np.maximum.accumulate(np.where(head, place, 0))
        rank[open_] = (key >> 32) + firsts - heads
        counts = np.diff(np.append(np.flatnonzero(fresh), len(open_)))
        open_ = open_[np.repeat(counts, counts) > 1]
        width *= 2
    order = np.empty(n, np.int64)
    order[rank[:n]] = np.arange(n)
    left, right = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n, np.int64)
    for width, ranks in reversed(depths):
        same = ranks[np.minimum(left, n)] == ranks[np.minimum(right, n)]
        step = np.where(same, width, 0)
        left += step
        right += step
        shared[1:] += step
    return order, shared


class _Places:
    """Places of one passage in order; ``heads`` begin a stretch of one class of word before."""

    __slots__ = ("places", "heads")

    def __init__(self, place: int):
        self.places, self.heads = [place], [place]

    def add(self, x: int, before: list[int]) -> None:
        places, heads, own = self.places, self.heads, before[x]
        i = bisect_left(places, x)
        ahead = before[places[i - 1]] if i else None
        if ahead != own:
            insort(heads, x)
        if i < len(places):
            follower = places[i]
            was, now = ahead != before[follower], own != before[follower]
            if was and not now:
                del heads[bisect_left(heads, follower)]
            elif now and not was:
                insort(heads, follower)
        places.insert(i, x)

    def other_classes(self, x: int, reach: int, own: int, before: list[int]) -> Iterator[int]:
        """Places within ``reach`` of ``x`` that follow another word than ``own``."""
        places, heads = self.places, self.heads
        i = bisect_left(places, x - reach)
        while i < len(places) and places[i] <= x + reach:
            y = places[i]
            if before[y] != own:
                yield y
                i += 1
            else:
                h = bisect_right(heads, y)
                if h == len(heads):
                    return
                i = bisect_left(places, heads[h], i)


def _maximal_pairs(order: list[int], shared: list[int], before: list[int]) -> dict:
    """{(start, end): period} from one interval: its suffixes share ``HALF`` words at least."""
    found: dict[tuple[int, int], int] = {}

    def joined(one: _Places, two: _Places, length: int) -> _Places:
        if len(one.places) < len(two.places):
            one, two = two, one
        for x in two.places:
            for y in one.other_classes(x, length, before[x], before):
                start, distance = min(x, y), abs(x - y)
                if distance + length >= MIN_LENGTH:
                    stretch = start, start + distance + length
                    found[stretch] = min(distance, found.get(stretch, distance))
        for x in two.places:
            one.add(x, before)
        return one

    stack: list[tuple[int, _Places]] = []
    current = _Places(order[0])
    for place, length in zip(order[1:], shared[1:], strict=True):
        while stack and stack[-1][0] > length:
            height, places = stack.pop()
            current = joined(places, current, height)
        if stack and stack[-1][0] == length:
            stack[-1] = length, joined(stack[-1][1], current, length)
        else:
            stack.append((length, current))
        current = _Places(place)
    while stack:
        height, places = stack.pop()
        current = joined(places, current, height)
    return found


def find(symbols: np.ndarray, bounds: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """{text: [(start, length, period)]} of texts with runs; text ``i`` is
    ``symbols[bounds[i]:bounds[i + 1]]`` and starts count from its first word.
    """
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    # A text without a repeated passage of HALF words has no run.
    grams = runs(mix(symbols.astype(np.uint64)), HALF)
    inside = owner[: len(grams)] == owner[len(symbols) - len(grams) :]
    grams = mix(grams ^ mix(owner[: len(grams)].astype(np.uint64)))
    at = np.flatnonzero(inside)
    turn = np.argsort(grams[at], kind="stable")
    again = grams[at[turn]]
    repeats = np.unique(owner[at[turn][1:][again[1:] == again[:-1]]])
    if not repeats.size:
        return {}
    kept = np.flatnonzero(np.isin(owner, repeats))
    own, text = symbols[kept].astype(np.int64), owner[kept]
    first = np.append(True, text[1:] != text[:-1])
    order, shared = suffix_order(text * (int(symbols.max()) + 1) + own)
    before = np.where(first, -1, np.append(-1, own[:-1]))
    # Intervals of HALF shared words; those whose places all lie farther apart than any of
    # their passages is long hold no run.
    edges = np.flatnonzero(shared < HALF)
    ends = np.append(edges[1:], len(order))
    group = np.repeat(np.arange(len(edges)), ends - edges)
    turn = np.lexsort((order, group))
    gap = np.diff(order[turn], prepend=-1)
    gap[group[turn] != np.append(-1, group[turn][:-1])] = len(order)
    nearest = np.minimum.reduceat(gap, edges)
    longest = np.maximum.reduceat(shared * (shared >= HALF), edges)
    out: dict[int, list[tuple[int, int, int]]] = {}
    begins = np.maximum.accumulate(np.where(first, np.arange(len(text)), 0))
    before = before.tolist()
    for k in np.flatnonzero((ends - edges > 1) & (nearest <= longest)).tolist():
        a, b = edges[k], ends[k]
        pairs = _maximal_pairs(order[a:b].tolist(), shared[a:b].tolist(), before)
        for (start, end), period in pairs.items():
            run = int(start - begins[start]), end - start, period
            out.setdefault(int(text[start]), []).append(run)
    # A stretch found in two intervals keeps its smallest period.
    for i, found in out.items():
        least: dict[tuple[int, int], int] = {}
        for start, length, period in found:
            least[start, length] = min(period, least.get((start, length), period))
        out[i] = sorted((s, n, p) for (s, n), p in least.items())
        out[i].sort(key=lambda run: (run[0], run[2]))
    return out


def _collapsed(words: Words, found: dict) -> list[bytes]:
    """Every text's words joined by one space, without those that a run only repeats."""
    stays = np.zeros(len(words.starts) + 1, np.int32)
    for i, all_runs in found.items():
        base = int(words.bounds[i])
        for start, length, period in all_runs:
            stays[base + start + period] += 1
            stays[base + start + length] -= 1
    stays = np.cumsum(stays[:-1]) == 0
    data = words.data.copy()
    data[words.ends] = 0x20
    lengths = np.where(stays, words.ends - words.starts + 1, 0)
    flat = gathered(data, words.starts, lengths).tobytes()
    ends = np.append(0, np.cumsum(lengths))[words.bounds].tolist()
    return [flat[a : max(a, b - 1)] for a, b in zip(ends, ends[1:])]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of ``docs``, which has ``doc_id`` and ``text``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  ``runs`` lists, by start and then period,
    every stretch of words with smallest period q and at least max(12, 2 q) words that no
    neighbouring word extends; ``collapsed`` is the text's words joined by one space, without
    those that some run contains after its first q words.  A null or empty text has no words, no
    runs and an empty ``collapsed``; null and repeated doc_ids are carried along; other columns
    are not read.  Texts are worked on in blocks, a longer text by itself in one task, in memory
    of about 100 bytes a word and 4 more for each doubling of its longest repeat.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            for a, b in blocks(texts):
                words = Words(texts[a:b])
                found = find(symbols(words), words.bounds) if words.starts.size else {}
                listed = [
                    [{"start": s, "length": n, "period": p} for s, n, p in found.get(i, ())]
                    for i in range(b - a)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(np.diff(words.bounds).astype(np.int64)),
                        pa.array(listed, _RUN_TYPE),
                        pa.array(_collapsed(words, found), pa.binary()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS}, collapsed binary"
    ).withColumn("collapsed", F.col("collapsed").cast("string"))
