"""Cut texts where no token can cross, and remember what a piece encodes to.

A token of the vocabularies used here starts with a space or holds none, and a space before a
visible character always starts a new match of their patterns.  So a text may be cut before
every such space, each piece encoded by itself, and the results joined.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Hashable, Sequence

_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?:\s|\Z)")
MAX_PIECES = 200_000
MAX_KEY = 64


def cut(text: str) -> list:
    """Pieces of a text.  All but the first stand for a space and the piece; the first is marked."""
    parts = _CUT.split(text) if _ODD.search(text) else text.split(" ")
    parts[0] = (parts[0],)
    return parts


def spelled(piece) -> str:
    return piece[0] if isinstance(piece, tuple) else " " + piece


class PieceCache:
    """piece -> value, in two generations: at most twice ``limit`` short pieces and a batch."""

    def __init__(self, encode: Callable[[list[str]], Sequence], limit: int = MAX_PIECES):
        self.encode, self.limit = encode, limit
        self.young: dict[Hashable, object] = {}
        self.old: dict[Hashable, object] = {}

    def values(self, texts: Sequence[list]) -> list[list]:
        """For every list of pieces the list of their values."""
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        new = set().union(*texts).difference(young)
        again = [k for k in new if k in old]
        young.update((k, old[k]) for k in again)
        new.difference_update(again)
        missing = list(new)
        young.update(zip(missing, self.encode([spelled(k) for k in missing]), strict=True))
        out = [list(map(young.__getitem__, keys)) for keys in texts]
        for key in missing:
            if len(key[0] if isinstance(key, tuple) else key) > MAX_KEY:
                del young[key]
        return out
