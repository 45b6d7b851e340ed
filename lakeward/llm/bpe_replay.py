"""Byte-level BPE by replaying merges over a block of the corpus, and decoding.

All distinct matches of a block are laid out in one array of linked symbols.  An inverted index
leads from the token that a pair of neighbours makes, by slices of ranks, to the positions of such
pairs.  Slices are taken in rank order; in a slice the lowest merge of every word is applied in
all words at once, and only the neighbours of a merged pair enter the index anew.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.pieces import PieceCache, cut
from lakeward.llm.scratch import prepare
from lakeward.llm.text import blocks

SLICES = 48


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Replay:
    """Encoder of single pattern matches by a rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # Every pair of tokens that makes a token, as left << 32 | right, in order.
        made = {}
        for token, rank in ranks.items():
            for cut_at in range(1, len(token)):
                left, right = ranks.get(token[:cut_at]), ranks.get(token[cut_at:])
                if left is not None and right is not None:
                    made[left << 32 | right] = rank
        self.keys = np.fromiter(made, np.int64, len(made))
        self.values = np.fromiter(made.values(), np.int32, len(made))
        order = np.argsort(self.keys)
        self.keys = np.append(self.keys[order], np.int64(2**62))
        self.values = np.append(self.values[order], np.int32(-1))
        self.edges = (max(ranks.values()) + 1) * (np.arange(1, SLICES) / SLICES) ** 2

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the tokens that neighbours make, -1 where they make none."""
        keys = left.astype(np.int64) << 32 | right
        found = np.searchsorted(self.keys, keys)
        return np.where(self.keys[found] == keys, self.values[found], np.int32(-1))

    def _in_turn(self, at, pair, word, symbols, follow, ahead) -> np.ndarray:
        """Of several places of one token in a word those to merge now, from the left: every other
        one where places overlap, and none beyond a merge that lets a better pair appear.
        """
        place = np.arange(len(at))
        chained = np.append(False, follow[at[:-1]] == at[1:])
        began = np.maximum.accumulate(np.where(chained, 0, place))
        at = at[(place - began) % 2 == 0]
        token, beyond, before = pair[at], follow[follow[at]], ahead[at]
        right = self._made(token, symbols[beyond])
        beside = np.append(False, beyond[:-1] == at[1:])
        left = self._made(np.where(beside, token, symbols[before]), token)
        better = (beyond >= 0) & (right >= 0) & (right < token)
        better |= (before >= 0) & (left >= 0) & (left < token)
        passed = np.cumsum(better) - better
        firsts = np.flatnonzero(np.append(True, word[at[1:]] != word[at[:-1]]))
        return at[passed == np.repeat(passed[firsts], np.diff(np.append(firsts, len(at))))]

    def encode(self, words: Sequence[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of every word: the token itself if there is one, else by merges."""
        whole = [self.ranks.get(w) for w in words]
        apart = [w for w, token in zip(words, whole, strict=True) if token is None]
        merged = iter(self._replay(apart))
        return [next(merged) if t is None else t.to_bytes(4, "little") for t in whole]

    def _replay(self, words: list[bytes]) -> list[bytes]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(lengths)
        symbols = self.single[np.frombuffer(b"".join(words), np.uint8)]
        total = len(symbols)
        if not total:
            return [b""] * len(words)
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        # After the last symbol of a word comes none, before its first neither.
        ends = stops[lengths > 0] - 1
        follow = np.arange(1, total + 1)
        follow[ends] = -1
        ahead = np.arange(-1, total - 1)
        ahead[ends[:-1] + 1] = -1
        # pair[i]: the token that symbol i makes with the next.
        pair = np.full(total, -1, np.int32)
        inner = np.flatnonzero(follow >= 0)
        pair[inner] = self._made(symbols[inner], symbols[inner + 1])

        # The index holds places by slices of ranks; entries that pair no longer backs are stale.
        index: list[list[np.ndarray]] = [[] for _ in range(SLICES)]

        def enter(places: np.ndarray) -> None:
            slices = np.searchsorted(self.edges, pair[places], "right")
            places = places[np.argsort(slices, kind="stable")]
            bounds = np.cumsum(np.bincount(slices, minlength=SLICES)).tolist()
            for held, start, stop in zip(index, [0, *bounds], bounds):
                if start < stop:
                    held.append(places[start:stop])

        enter(np.flatnonzero(pair >= 0))
        for n, edge in enumerate([*self.edges.tolist(), np.inf]):
            open_ = np.concatenate(index[n]) if index[n] else np.zeros(0, np.int64)
            open_, index[n] = open_[pair[open_] < edge], []
            while open_.size:
                open_ = np.unique(open_[pair[open_] >= 0])
                if not open_.size:
                    break
                # Of every word the places of its lowest rank come first.
                ranks, of = pair[open_], word[open_]
                firsts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                group = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(of))))
                lowest = ranks == np.minimum.reduceat(ranks, firsts)[group]
                at = open_[lowest]
                again = word[at[1:]] == word[at[:-1]]
                if again.any():
                    several = np.append(again, False) | np.append(False, again)
                    turn = self._in_turn(at[several], pair, word, symbols, follow, ahead)
                    at = np.concatenate([at[~several], turn])
                after = follow[at]
                beyond = follow[after]
                symbols[at], symbols[after], pair[after] = pair[at], -1, -1
                follow[at] = beyond
                right = beyond >= 0
                ahead[beyond[right]] = at[right]
                # Only pairs beside a merge change.
                pair[at] = -1
                touched = np.concatenate([at[right], ahead[at[ahead[at] >= 0]]])
                pair[touched] = self._made(symbols[touched], symbols[follow[touched]])
                touched = touched[pair[touched] >= 0]
                now = pair[touched] < edge
                enter(touched[~now])
                open_ = np.concatenate([open_[pair[open_] >= 0], touched[now]])
                open_ = open_[pair[open_] < edge]
        stays = symbols >= 0
        ids = symbols[stays].astype("<i4").tobytes()
        count = np.append(0, np.cumsum(stays))
        cuts = (4 * count[np.append(0, stops)]).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> PieceCache:
    import regex

    replay = Replay(read_ranks(path))
    # White space as Unicode defines it, not with the separators that Python adds.
    match = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall

    def encode(pieces: list[str]) -> list[bytes]:
        matches = [match(p) for p in pieces]
        words = list(set().union(*matches))
        ids = dict(zip(words, replay.encode([w.encode() for w in words]), strict=True))
        return [b"".join([ids[m] for m in found]) for found in matches]

    return PieceCache(encode)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): token ids of every whole text; a null or empty text has none.

    ``path`` is a file of ranks, ``pattern`` splits texts into the matches that merges never
    cross.  Workers keep the ids of pieces they have met, up to a bound.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _encoder(path, pattern)
        for batch in batches:
            texts = batch.column("text").fill_null("").to_pylist()
            for a, b in blocks(texts):
                ids = [
                    np.frombuffer(b"".join(values), "<i4")
                    for values in cache.values([cut(t) for t in texts[a:b]])
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(ids, pa.list_(pa.int32()))],
                    ["doc_id", "ids"],
                )

    slim = docs.select(F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(run, "doc_id long, ids array<int>")


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> list[bytes]:
    ranks = read_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns of ``encoded`` and ``decoded``: the bytes that its ``ids`` stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _vocabulary(path)
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy()
            ends = np.cumsum(ids.value_lengths().fill_null(0).to_numpy())
            texts, start = [], 0
            for end in ends.tolist():
                texts.append(b"".join(map(tokens.__getitem__, flat[start:end].tolist())))
                start = end
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"]
            )

    columns = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)
    return encoded.mapInArrow(run, f"{columns}, decoded binary")
