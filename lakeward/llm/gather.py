"""Encode every distinct piece of a block of texts once, and lay results out by offsets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa

CACHE_BYTES = 48 << 20
# What a Python dictionary entry, its key and its value take besides their own bytes.
_ENTRY = 200
LONGEST = 64


class Layout:
    """UTF-8 of several texts end to end; ``ends[i]`` is where text ``i`` ends."""

    def __init__(self, texts: Sequence[bytes]):
        self.joined = b"".join(texts)
        self.data = np.frombuffer(self.joined, np.uint8)
        self.ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))

    def pieces(self, cuts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The pieces between ``cuts`` and the ends of texts, and how many each text has."""
        edge = np.zeros(len(self.data) + 1, bool)
        edge[cuts] = True
        edge[self.ends] = True
        edge[0] = False
        stops = np.flatnonzero(edge)
        bounds = np.searchsorted(stops, self.ends, "right")
        offsets = np.append(0, stops).astype(np.int32)
        pieces = pa.Array.from_buffers(
            pa.binary(), len(stops), [None, pa.py_buffer(offsets), pa.py_buffer(self.joined)]
        )
        return pieces, np.diff(np.append(0, bounds))


def before_words(layout: Layout) -> np.ndarray:
    """Places of a space with a visible character behind it, where no token can cross.

    White space outside ASCII starts with one of four bytes; there no cut is made, which costs a
    longer piece and nothing else.
    """
    data = layout.data
    follows = np.append(data[1:], np.uint8(0x20))
    visible = (follows > 0x20) & (follows != 0x7F)
    for lead in (0xC2, 0xE1, 0xE2, 0xE3):
        visible &= follows != lead
    visible[layout.ends[layout.ends > 0] - 1] = False
    return np.flatnonzero((data == 0x20) & visible)


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches ``values[starts[i] : starts[i] + lengths[i]]`` one after another."""
    stops = np.cumsum(lengths)
    if not stops.size:
        return values[:0]
    shift = np.repeat(starts - (stops - lengths), lengths)
    return values[shift + np.arange(int(stops[-1]))]


class Encoder:
    """Pieces to 32-bit ids; ``encode`` takes distinct pieces and returns their packed ids.

    Pieces met before are remembered up to ``limit`` bytes, counted with what Python adds to
    them, in two generations; a piece of more than ``LONGEST`` bytes is not remembered.
    """

    def __init__(self, encode: Callable[[list[bytes]], Sequence[bytes]], limit: int = CACHE_BYTES):
        self.encode, self.limit = encode, limit // 2
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0

    def _values(self, pieces: list[bytes]) -> list[bytes]:
        values = list(map(self.young.get, pieces))
        absent = [i for i, value in enumerate(values) if value is None]
        keys = [pieces[i] for i in absent]
        older = list(map(self.old.get, keys))
        missed = [key for key, value in zip(keys, older, strict=True) if value is None]
        fresh = iter(self.encode(missed) if missed else ())
        found = [next(fresh) if value is None else value for value in older]
        for i, value in zip(absent, found, strict=True):
            values[i] = value
        self._keep([(k, v) for k, v in zip(keys, found, strict=True) if len(k) <= LONGEST])
        return values

    def _keep(self, entries: list[tuple[bytes, bytes]]) -> None:
        self.young.update(entries)
        self.held += _ENTRY * len(entries) + sum(len(k) + len(v) for k, v in entries)
        if self.held > self.limit:
            self.young, self.old, self.held = {}, self.young, 0

    def ids(self, pieces: pa.Array, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each text."""
        coded = pieces.dictionary_encode()
        values = self._values(coded.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(values), "<u4")
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
        starts = np.cumsum(lengths) - lengths
        codes = coded.indices.to_numpy()
        counts = np.append(0, np.cumsum(lengths[codes]))
        stops = counts[np.cumsum(per_text)]
        return gathered(flat, starts[codes], lengths[codes]), np.diff(np.append(0, stops))
