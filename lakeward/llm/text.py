"""Words of a batch of texts as numpy arrays: bounds, hashes, runs per document."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1B54A32D192ED03)
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def blocks(texts: Sequence[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together; a longer text is a range alone."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


@lru_cache(maxsize=1)
def _powers(bits: int) -> np.ndarray:
    steps = np.full(1 << bits, _BASE, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of several texts laid out in one byte array.

    ``starts`` and ``ends`` are byte positions in ``data``; the words of text ``i`` are
    ``bounds[i]`` to ``bounds[i + 1]``; ``firsts[i]`` is the gap byte before text ``i``.
    """

    def __init__(self, texts: Sequence[bytes]):
        self.data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.firsts = np.concatenate([[0], np.cumsum(lengths + 1)])
        gap = _GAP[self.data]
        edge = gap[1:] != gap[:-1]
        turns = np.flatnonzero(edge) + 1
        self.starts, self.ends = turns[0::2], turns[1::2]
        self.bounds = np.searchsorted(self.starts, self.firsts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, the same wherever the word stands."""
        if not self.starts.size:
            return np.zeros(0, np.uint64)
        low, high = int(self.starts[0]), int(self.ends[-1])
        data = self.data[low:high]
        began = np.zeros(len(data), np.int64)
        began[self.starts - low] = self.starts - low
        place = np.arange(len(data)) - np.maximum.accumulate(began)
        values = _powers(max(16, int(place.max()).bit_length()))[place]
        values *= data.astype(np.uint64) + np.uint64(1)
        values[_GAP[data]] = 0
        return mix(np.add.reduceat(values, self.starts - low))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive values."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(length))
    for k in range(length):
        out = mix(out * _STEP + hashes[k : k + n])
    return out


def symbols(words: Words) -> np.ndarray:
    """Numbers from 0 of the words of a block, equal exactly where words are."""
    lengths = words.ends - words.starts
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int64)
    letters = words.data[~_GAP[words.data]]
    array = pa.Array.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    )
    return array.dictionary_encode().indices.to_numpy().astype(np.int64)


def as_bytes(column) -> list[bytes]:
    """Texts of an Arrow column as UTF-8; null is empty."""
    return [t or b"" for t in column.cast("binary").to_pylist()]
