"""SentencePiece encoding and decoding for merge-type vocabularies, checked by the library.

Every distinct word is encoded with an agenda of adjacent symbol pairs: the pair with the
highest score merges first, of equal ones the leftmost, and only the neighbours of a merge enter
the agenda anew.  The agendas of words of equal length are rows of one array and move on
together; a long word has a heap of its own.  Whole texts are then checked, batch by batch,
against the sentencepiece library.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.gather import Encoder, Layout, gathered
from lakeward.llm.scratch import prepare
from lakeward.llm.text import blocks

SPACE = "▁"
UNKNOWN_SURFACE = " ⁇ ".encode()
BLOCK = 1 << 22
PART = 1 << 19
BLOCK_IDS = 1 << 18
# Longest word, in characters, whose agenda is a row of an array.
ROW = 24
NONE = 1 << 40


class Mismatch(RuntimeError):
    """The library encodes or decodes a text otherwise."""


class Vocabulary:
    """Pieces, scores and kinds of a ``.model`` file of the merge type."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        number = range(len(names))
        self.unknown = lib.unk_id()
        self.bytes = {int(names[i][1:-1], 16): i for i in number if lib.is_byte(i)}
        special = {i for i in number if lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i)}
        self.ids = {names[i]: i for i in number if i not in special}
        self.scores = {p: -lib.get_score(i) for p, i in self.ids.items()}
        self.unused = {p for p, i in self.ids.items() if lib.is_unused(i)}
        # Words may be encoded by themselves if no piece leads from a word into the next space.
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        # Pairs of ASCII characters that stand side by side in no piece: no merge crosses them.  A
        # cut there changes nothing where unknown symbols are spelled one by one.
        self.never = np.zeros((256, 256), bool)
        self.never[:128, :128] = bool(self.bytes)
        for piece in self.ids:
            for a, b in zip(piece, piece[1:]):
                if a < "\x80" and b < "\x80":
                    self.never[ord(a), ord(b)] = False
        # The first space of a text stands for none if the model puts one before every text.
        self.prefixed = lib.normalize("a").startswith(SPACE)
        surface = [p.replace(SPACE, " ").encode() for p in names]
        for byte, i in self.bytes.items():
            surface[i] = bytes([byte])
        for i in special.difference(self.bytes.values()):
            surface[i] = UNKNOWN_SURFACE if i == self.unknown else b""
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.lengths = np.fromiter(map(len, surface), np.int64, len(surface))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.led = [n.startswith(SPACE) for n in names]
        self.is_byte = np.zeros(len(names), bool)
        self.is_byte[list(self.bytes.values())] = True
        self._table()
        self.cache = Encoder(self.encode_words)

    def _table(self) -> None:
        """Pairs of symbols that make a piece: sorted keys, the symbol made, and its rank."""
        symbols = {c for p in self.ids for c in p} | set(self.ids)
        self.names = sorted(symbols)
        self.symbol = {s: i for i, s in enumerate(self.names)}
        ranks = {x: i for i, x in enumerate(sorted(set(self.scores.values())))}
        rows = []
        for piece in self.ids:
            for at in range(1, len(piece)):
                left, right = self.symbol.get(piece[:at]), self.symbol.get(piece[at:])
                if left is not None and right is not None:
                    rows.append((left << 32 | right, self.symbol[piece], ranks[self.scores[piece]]))
        rows.sort()
        table = np.array([*rows, (2**62, 0, NONE)], np.int64)
        self.keys, self.makes, self.rank = (np.ascontiguousarray(x) for x in table.T)
        # A symbol per character; one that no piece holds stands for itself beyond the table.
        self.of_char = np.arange(0x110000, dtype=np.int32) + len(symbols)
        for name, i in self.symbol.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        # With byte pieces what a symbol gives does not depend on the ones beside it.
        self.of_symbol = lru_cache(1 << 16)(lambda s: self._packed([self._name(s)]))
        out = [self._packed([s]) for s in self.symbol]
        self.out = np.frombuffer(b"".join(out), "<u4")
        self.out_lengths = np.fromiter(map(len, out), np.int64, len(out)) // 4
        self.out_starts = np.cumsum(self.out_lengths) - self.out_lengths

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left << 32 | right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.rank[at], NONE), self.makes[at]

    def _together(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of symbols merged to the end; -1 where a symbol has gone into one before it."""
        done = np.full(symbols.shape, -1, np.int64)
        rows = np.arange(len(symbols))
        agenda, made = self._pairs(symbols[:, :-1], symbols[:, 1:])
        while symbols.shape[1] > 1 and len(rows):
            best = agenda.argmin(axis=1)
            open_ = agenda[np.arange(len(rows)), best] < NONE
            done[rows[~open_], : symbols.shape[1]] = symbols[~open_]
            rows, symbols, agenda, made, best = (
                x[open_] for x in (rows, symbols, agenda, made, best)
            )
            each = np.arange(len(rows))
            symbols[each, best] = made[each, best]
            # Close the gap: what lies behind the merged pair moves up by one.
            width = symbols.shape[1] - 1
            moved = np.arange(width) > best[:, None]
            symbols = np.where(moved, symbols[:, 1:], symbols[:, :-1])
            moved = moved[:, : width - 1] | (np.arange(width - 1) >= best[:, None])
            agenda = np.where(moved, agenda[:, 1:], agenda[:, :-1])
            made = np.where(moved, made[:, 1:], made[:, :-1])
            for side in (best - 1, best):
                here = np.flatnonzero((side >= 0) & (side < width - 1))
                at = side[here]
                agenda[here, at], made[here, at] = self._pairs(symbols[here, at], symbols[here, at + 1])
        done[rows, : symbols.shape[1]] = symbols
        return done

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of distinct words."""
        texts = [w.decode() for w in words]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        out: list[bytes] = [b""] * len(words)
        fits = np.flatnonzero(lengths <= (0 if self.unused else ROW))
        for i in np.flatnonzero(lengths > (0 if self.unused else ROW)).tolist():
            out[i] = self._packed(self.merged(texts[i]))
        order = fits[np.argsort(lengths[fits], kind="stable")]
        for which in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            if not len(which) or not lengths[which[0]]:
                continue
            joined = "".join([texts[i] for i in which.tolist()]).encode("utf-32-le")
            chars = np.frombuffer(joined, "<u4").reshape(len(which), -1)
            symbols = self._together(self.of_char[chars].astype(np.int64))
            known = (symbols < len(self.names)).all(axis=1)
            for i, row in zip(which[~known].tolist(), symbols[~known].tolist(), strict=True):
                left = [s for s in row if s >= 0]
                if self.bytes:
                    out[i] = b"".join(map(self.of_symbol, left))
                else:
                    out[i] = self._packed([self._name(s) for s in left])
            symbols = symbols[known]
            flat = symbols[symbols >= 0]
            ids = gathered(self.out, self.out_starts[flat], self.out_lengths[flat]).tobytes()
            ends = np.append(0, np.cumsum(self.out_lengths[flat]))
            stops = (4 * ends[np.cumsum((symbols >= 0).sum(axis=1))]).tolist()
            start = 0
            for i, stop in zip(which[known].tolist(), stops, strict=True):
                out[i], start = ids[start:stop], stop
        return out

    def _name(self, symbol: int) -> str:
        inside = symbol < len(self.names)
        return self.names[symbol] if inside else chr(symbol - len(self.names))

    def merged(self, word: str) -> list[str]:
        """The symbols that are left when no adjacent pair is a piece, by a heap of pairs."""
        symbols: list[str | None] = list(word)
        follow = list(range(1, len(symbols))) + [-1]
        ahead = list(range(-1, len(symbols) - 1))
        scores, parts = self.scores, {}
        agenda = []
        for i in range(len(symbols) - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in scores:
                agenda.append((scores[pair], i, pair))
        heapify(agenda)
        while agenda:
            _, i, pair = heappop(agenda)
            left, j = symbols[i], follow[i]
            # An entry is stale once either of its symbols has gone into another merge.
            if left is None or j < 0 or len(left) + len(symbols[j]) != len(pair):
                continue
            if pair in self.unused:
                parts[pair] = left, symbols[j]
            symbols[i], symbols[j] = pair, None
            follow[i] = k = follow[j]
            if k >= 0:
                ahead[k] = i
                wider = pair + symbols[k]
                if wider in scores:
                    heappush(agenda, (scores[wider], i, wider))
            h = ahead[i]
            if h >= 0:
                wider = symbols[h] + pair
                if wider in scores:
                    heappush(agenda, (scores[wider], h, wider))
        rest = [s for s in symbols if s is not None]
        while parts and any(s in parts for s in rest):  # pieces that may only be part of others
            rest = [part for s in rest for part in parts.get(s, (s,))]
        return rest

    def _packed(self, symbols: list[str]) -> bytes:
        ids, gap = [], False
        for symbol in symbols:
            found = self.ids.get(symbol)
            if found is not None:
                ids.append(found)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in symbol.encode())
            elif not gap:  # neighbouring unknown symbols are one unknown
                ids.append(self.unknown)
            gap = found is None
        return np.array(ids, "<u4").tobytes()

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each."""
        layout = Layout([t.encode() for t in self.library.normalize(list(texts))])
        cuts = np.zeros(0, np.int64)
        if self.apart:
            data, mark = layout.data, SPACE.encode()
            at = np.flatnonzero(data[:-2] == mark[0])
            at = at[(data[at + 1] == mark[1]) & (data[at + 2] == mark[2])]
            spaces = at[np.append(True, at[1:] - at[:-1] > len(mark))] if at.size else at
            cuts = np.append(spaces, np.flatnonzero(self.never[data[:-1], data[1:]]) + 1)
        ids, counts = self.cache.ids(*layout.pieces(cuts))
        return ids.astype(np.int32), counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 of every text; a byte that belongs to no character becomes U+FFFD."""
        data = gathered(self.surface, self.starts[ids], self.lengths[ids]).tobytes()
        ends = np.append(0, np.cumsum(self.lengths[ids]))
        stops = ends[np.cumsum(counts)].tolist()
        firsts = np.cumsum(counts) - counts
        # Ids without a text, such as a begin mark, part the bytes beside them.
        silent = np.append(0, np.cumsum(self.lengths[ids] == 0))
        parted = (silent[firsts + counts] > silent[firsts]).tolist()
        out, start = [], 0
        for i, (first, count, stop) in enumerate(
            zip(firsts.tolist(), counts.tolist(), stops, strict=True)
        ):
            text, start = data[start:stop], stop
            try:
                text.decode()
                broken = parted[i]
            except UnicodeDecodeError:
                broken = True
            if broken:
                text = self._repaired(ids[first : first + count])
            if self.prefixed and text.startswith(b" "):
                while not self.lengths[ids[first]]:
                    first += 1
                text = text[1:] if self.led[ids[first]] else text
            out.append(text)
        return out

    def _repaired(self, ids: np.ndarray) -> bytes:
        out = bytearray()
        edges = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        for part in np.split(ids, edges):
            run = gathered(self.surface, self.starts[part], self.lengths[part]).tobytes()
            while run:
                try:
                    out += run.decode().encode()
                    break
                except UnicodeDecodeError as error:
                    out += run[: error.start] + "�".encode()
                    run = run[error.start + 1 :]
        return bytes(out)


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _same(name: str, ours: Iterable, theirs: Sequence) -> None:
    for own, library in zip(ours, theirs, strict=True):
        if own != library:
            raise Mismatch(f"{name}: {str(own)[:200]} here, {str(library)[:200]} by the library")


def _by_text(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    ends = np.append(0, np.cumsum(counts)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _check_ids(
    vocabulary: Vocabulary, texts: list[str], ids: np.ndarray, counts: np.ndarray
) -> list[list[int]]:
    """The library's ids, which are ours."""
    theirs = vocabulary.library.encode(texts, num_threads=1)
    ends = np.cumsum(counts).tolist()
    own = (ids[e - n : e].tolist() for e, n in zip(ends, counts.tolist(), strict=True))
    _same("ids", own, theirs)
    return theirs


def _check_text(vocabulary: Vocabulary, ids: list[list[int]], texts: list[bytes]) -> None:
    _same("text", texts, [t.encode() for t in vocabulary.library.decode(ids)])


def encode(docs: DataFrame, path: str, check: bool = True, with_decoded: bool = False) -> DataFrame:
    """(doc_id, ids): ids of every whole text without begin or end ids, one row per row.

    A null or empty text has no ids; null and repeated doc_ids are carried along; other columns,
    whatever their names, are not read.  A text that is one long word is one piece of work, of
    n log n steps.  ``with_decoded`` adds ``decoded``, what :func:`decode` makes of the ids, in
    the same pass.  With ``check`` a text whose ids the library gives or decodes otherwise ends
    the job with ``Mismatch``; without it the library only normalises.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            column = batch.column("text").fill_null("")
            sizes = column.cast("binary").to_pylist()
            for a, b in blocks(sizes, BLOCK):
                ids, counts = vocabulary.encode(column.slice(a, b - a).to_pylist())
                ends = np.append(0, np.cumsum(counts))
                # The library's lists take much memory: a part of the block at a time.
                for c, d in blocks(sizes[a:b], PART):
                    some, number = ids[ends[c] : ends[d]], counts[c:d]
                    out = [batch.column("doc_id").slice(a + c, d - c), _by_text(some, number)]
                    theirs = []
                    if check:
                        texts = column.slice(a + c, d - c).to_pylist()
                        theirs = _check_ids(vocabulary, texts, some, number)
                    if with_decoded:
                        decoded = vocabulary.decode(some, number)
                        if check:
                            _check_text(vocabulary, theirs, decoded)
                        out.append(pa.array(decoded, pa.binary()))
                    yield pa.RecordBatch.from_arrays(out, ["doc_id", "ids", "decoded"][: len(out)])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, ids array<int>" + (", decoded binary" if with_decoded else "")
    return slim.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, check: bool = True) -> DataFrame:
    """(doc_id, ids, decoded): the text that ``ids`` stand for, as UTF-8; null ids give none.

    Other columns are not read.  With ``check`` a text that the library decodes otherwise ends
    the job with ``Mismatch``.
    """
    prepare(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            every = batch.column("ids").value_lengths().fill_null(0).to_numpy()
            groups = np.cumsum(every) // BLOCK_IDS
            edges = [*np.flatnonzero(np.diff(groups, prepend=-1)).tolist(), len(every)]
            for a, b in zip(edges, edges[1:]):
                lists, counts = batch.column("ids").slice(a, b - a), every[a:b]
                flat = lists.flatten().to_numpy()
                decoded = vocabulary.decode(flat, counts)
                if check:
                    _check_text(vocabulary, _by_text(flat, counts).to_pylist(), decoded)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), lists, pa.array(decoded, pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
