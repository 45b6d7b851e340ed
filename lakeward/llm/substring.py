"""Removal of passages that another document holds, by FM-indexes over word sequences.

Windows of ``length`` words are what is compared.  Every window is routed by its anchor, the
smallest hash of the short runs of words inside it, which equal windows share wherever they
stand.  Neighbouring windows of one anchor form a piece.  Pieces of equal words collapse to one
with the smallest doc_id, so copies cost one row each.  Only anchors with different pieces in
several documents need a search: their pieces are dealt to shards, each shard is indexed and
its pieces are streamed against the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.llm.fm_index import FMIndex
from lakeward.llm.scratch import prepare, stored
from lakeward.llm.text import Words, as_bytes, blocks, mix, runs, symbols


@dataclass(frozen=True)
class Settings:
    """``shard``: words that are indexed together, about; ``hot``: an anchor whose different
    pieces hold more words than that is resolved by grouping its windows.
    """

    length: int = 50
    gram: int = 8
    shard: int = 400_000
    hot: int = 1_000_000


_STEP = np.uint64(0xD1B54A32D192ED03)
_BACK = np.uint64(pow(0xD1B54A32D192ED03, -1, 1 << 64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbouring values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:])


@lru_cache(maxsize=2)
def _power_table(base: int, bits: int) -> np.ndarray:
    steps = np.full(1 << bits, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return _power_table(int(base), max(16, n.bit_length()))[:n]


def _stretches(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    """Hash of the words from each start to each end, the same wherever they stand."""
    n = len(hashes)
    values = mix(hashes ^ np.uint64(salt)) * _powers(_STEP, n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    back = _powers(_BACK, n)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def _pieces(settings: Settings):
    """Task function: the pieces of every document, by anchor."""
    length, gram = settings.length, settings.gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            for a, b in blocks(texts):
                words = Words(texts[a:b])
                hashes, bounds = words.hashes(), words.bounds
                if len(hashes) < length:
                    continue
                least = _least(runs(hashes, gram), length - gram + 1)
                # Window k belongs to the text of word k, unless it runs into the next text.
                text_of = np.repeat(np.arange(b - a), np.diff(bounds))[: len(least)]
                inside = np.arange(len(least)) + length <= bounds[1:][text_of]
                new = inside.copy()
                new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
                first = np.flatnonzero(new)
                if not first.size:
                    continue
                # A piece ends before the next one begins, or where windows leave the text.
                ahead = np.concatenate([first[1:], [len(least)]])
                last = np.minimum(ahead, bounds[1:][text_of[first]] - length + 1)
                digest = _stretches(hashes, first, last - 1 + length, 0)
                rows, anchor, count = pa.array(a + text_of[first]), least[first], last - first
                first = first - bounds[text_of[first]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(digest.view(np.int64)),
                        batch.column("doc_id").take(rows),
                        batch.column("tag").take(rows),
                        pa.array(first.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                    ],
                    ["anchor", "digest", "doc_id", "tag", "first", "windows"],
                )

    return run


def _words_of_pieces(settings: Settings):
    """Task function: the words of the pieces listed for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, listed = as_bytes(batch.column("text")), batch.column("pieces").to_pylist()
            for a, b in blocks(texts):
                rows = []
                for text, pieces in zip(texts[a:b], listed[a:b], strict=True):
                    words = text.split()
                    for p in pieces:
                        end = p["first"] + p["windows"] - 1 + settings.length
                        rows.append((p["anchor"], p["digest"], p["n"], b" ".join(words[p["first"] : end])))
                anchor, digest, n, text = zip(*rows, strict=True)
                doc = np.repeat(batch.column("doc_id").to_numpy()[a:b], [len(p) for p in listed[a:b]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor, pa.int64()),
                        pa.array(digest, pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(doc, pa.int64()),
                        pa.array(text, pa.binary()),
                    ],
                    ["anchor", "digest", "n", "doc_id", "words"],
                )

    return run


_RANGES = "array<struct<low:int,high:int>>"
_FOUND = f"anchor long, digest long, ranges {_RANGES}"


def _found_rows(anchor, digest, piece, place) -> pa.Table:
    """Places (window numbers, sorted within each piece) as ranges per piece."""
    turn = np.flatnonzero((np.diff(piece) != 0) | (np.diff(place) != 1)) + 1
    low = np.concatenate([[0], turn]).astype(np.int64)[: len(turn) + (len(piece) > 0)]
    high = np.concatenate([turn, [len(piece)]]).astype(np.int64)[: len(low)]
    ranges: dict[int, list] = {}
    for p, x, y in zip(piece[low].tolist(), place[low].tolist(), place[high - 1].tolist(), strict=True):
        ranges.setdefault(p, []).append({"low": x, "high": y + 1})
    kept = list(ranges)
    pair = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
    return pa.table(
        {
            "anchor": pa.array(anchor[kept], pa.int64()),
            "digest": pa.array(digest[kept], pa.int64()),
            "ranges": pa.array(list(ranges.values()), pair),
        }
    )


def _search(settings: Settings):
    """Group function: index the pieces of a shard, stream them against it, report windows that
    a piece of a smaller doc_id holds too."""
    length = settings.length

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        anchor, digest, doc = (table.column(c).to_numpy() for c in ("anchor", "digest", "doc_id"))
        words = Words(table.column("words").to_pylist())
        sizes = np.diff(words.bounds) + 1
        starts = np.cumsum(sizes) - sizes
        # Symbol 0 ends every piece.
        text = np.insert(symbols(words) + 1, words.bounds[1:], 0).astype(np.int32)
        index = FMIndex(text)
        # Nothing is smaller than the smallest document of an anchor: its pieces are not streamed.
        _, group = np.unique(anchor, return_inverse=True)
        smallest = np.full(group.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(smallest, group, doc)
        asked = np.flatnonzero(doc > smallest[group])
        windows = sizes[asked] - length
        piece = np.repeat(asked, windows)
        place = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
        matched, low, high = index.match(text, starts[piece] + place + length, length)
        which = np.flatnonzero(matched >= length)
        if not which.size:
            return _found_rows(anchor, digest, which, which)
        # Ranges of different windows don't overlap, so each is looked up once.
        at, back = np.unique(low[which], return_inverse=True)
        until = np.zeros(len(at), np.int64)
        until[back] = high[which]
        counts = until - at
        ends = np.cumsum(counts)
        rows = np.arange(int(ends[-1])) + np.repeat(at - (ends - counts), counts)
        owners = doc[np.searchsorted(starts, index.locate(rows), "right") - 1]
        least = np.minimum.reduceat(owners, ends - counts)
        hit = which[least[back] < doc[piece[which]]]
        return _found_rows(anchor, digest, piece[hit], place[hit])

    return run


def _windows(settings: Settings):
    """Task function: two hashes of every window of every piece."""
    length = settings.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, first, second, place = [], [], [], []
            for i, text in enumerate(batch.column("words").to_pylist()):
                hashes = Words([text]).hashes()
                starts = np.arange(len(hashes) - length + 1)
                owner.append(np.full(len(starts), i))
                first.append(_stretches(hashes, starts, starts + length, 1).view(np.int64))
                second.append(_stretches(hashes, starts, starts + length, 2).view(np.int64))
                place.append(starts.astype(np.int32))
            if not owner:
                continue
            rows = pa.array(np.concatenate(owner))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(rows) for c in ("anchor", "digest", "doc_id")],
                    *[pa.array(np.concatenate(x)) for x in (first, second, place)],
                ],
                ["anchor", "digest", "doc_id", "w1", "w2", "place"],
            )

    return run


def _by_windows(pieces: DataFrame, settings: Settings) -> DataFrame:
    """The exact way for anchors of very many pieces: minimum doc_id per window, joined back."""
    windows = stored(
        pieces.mapInArrow(
            _windows(settings),
            "anchor long, digest long, doc_id long, w1 long, w2 long, place int",
        ),
        "windows",
    )
    least = stored(windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("least")), "least")
    held = windows.join(least, ["w1", "w2"]).where("doc_id > least")
    one = F.struct(F.col("place").alias("low"), (F.col("place") + 1).alias("high"))
    return held.groupBy("anchor", "digest").agg(F.collect_set(one).cast(_RANGES).alias("ranges"))


def repeated_ranges(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, tag, spans): word ranges (low, high) of every document that holds any word of a
    window which a document of smaller doc_id holds too."""
    pieces = stored(
        docs.where("doc_id IS NOT NULL").mapInArrow(
            _pieces(settings),
            "anchor long, digest long, doc_id long, tag long, first int, windows int",
        ),
        "pieces",
    )
    anchors = stored(
        pieces.groupBy("anchor")
        .agg(
            F.min("doc_id").alias("low"),
            F.max("doc_id").alias("high"),
            (F.min("digest") < F.max("digest")).alias("open"),
        )
        .where("low < high")
        .select("anchor", "open"),
        "anchors",
    )
    shared = stored(pieces.join(anchors, "anchor"), "shared")
    classes = stored(
        shared.groupBy("anchor", "digest", "open").agg(
            F.min(F.struct("doc_id", "tag", "first", "windows")).alias("owner")
        ),
        "classes",
    )
    size = F.col("owner.windows") + F.lit(settings.length - 1)
    numbers = stored(
        classes.where("open").groupBy("anchor").agg(F.sum(size).alias("n")), "numbers"
    )
    places = (
        classes.where("open")
        .join(numbers, "anchor")
        .select(
            "owner.doc_id",
            "owner.tag",
            F.struct("anchor", "digest", "n", "owner.first", "owner.windows").alias("piece"),
        )
        .groupBy("doc_id", "tag")
        .agg(F.collect_list("piece").alias("pieces"))
    )
    words = stored(
        docs.join(stored(places, "places"), ["doc_id", "tag"]).mapInArrow(
            _words_of_pieces(settings),
            "anchor long, digest long, n long, doc_id long, words binary",
        ),
        "words",
    )
    total = numbers.where(F.col("n") <= settings.hot).agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // settings.shard))
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards))
    searched = (
        words.where(F.col("n") <= settings.hot)
        .withColumn("shard", shard)
        .groupBy("shard")
        .applyInArrow(_search(settings), _FOUND)
    )
    grouped = _by_windows(words.where(F.col("n") > settings.hot), settings)
    covers = stored(searched.unionByName(grouped), "covers")
    results = stored(
        classes.join(covers, ["anchor", "digest"], "left").select(
            "anchor", "digest", F.col("owner.doc_id").alias("owner"), "ranges"
        ),
        "results",
    )
    whole = F.array(F.struct(F.lit(0).alias("low"), F.col("windows").alias("high")))
    ranges = F.when(F.col("doc_id") > F.col("owner"), whole.cast(_RANGES)).otherwise(F.col("ranges"))
    spans = F.transform(
        ranges,
        lambda r: F.struct(
            (F.col("first") + r["low"]).alias("low"),
            (F.col("first") + r["high"] - 1 + settings.length).alias("high"),
        ),
    )
    return (
        shared.join(results, ["anchor", "digest"])
        .select("doc_id", "tag", spans.alias("spans"))
        .where("spans IS NOT NULL")
        .groupBy("doc_id", "tag")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


def _cut(names: list[str]):
    """Task function: number of words, number removed, and the words that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, spans in zip(
                as_bytes(batch.column("text")), batch.column("spans").to_pylist(), strict=True
            ):
                words = text.split()
                total.append(len(words))
                if not spans:
                    removed.append(0)
                    kept.append(b" ".join(words))
                    continue
                change = np.zeros(len(words) + 1, np.int64)
                for span in spans:
                    change[span["low"]] += 1
                    change[span["high"]] -= 1
                stay = np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()
                removed.append(len(words) - len(stay))
                kept.append(b" ".join([words[i] for i in stay]))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                [*names, "_words", "_removed", "_kept"],
            )

    return run


def remove_repeats(
    docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), settings: Settings = Settings()
) -> DataFrame:
    """The columns ``carry`` of every row, with ``_words``, ``_removed`` and ``_kept``.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A word goes if a window of ``length`` words over it also
    stands in a document of smaller doc_id; ``_kept`` joins the others by one space.  Windows
    are judged on the input.  Null texts have no words.  Rows without doc_id keep everything and
    take nothing from others; rows that repeat a doc_id are judged one by one, and don't count
    as smaller than each other.  Words are compared by 64-bit hashes up to the anchors and
    pieces, and as they are in the index.
    """
    prepare(docs.sparkSession)
    keyed = docs.select(*carry, *[c for c in ("doc_id", "text") if c not in carry])
    keyed = keyed.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn(
        "text", F.coalesce("text", F.lit(""))
    )
    slim = keyed.select("doc_id", "text").withColumn("tag", F.xxhash64("text"))
    spans = stored(repeated_ranges(slim, settings), "spans").select(
        F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), "spans"
    )
    joined = keyed.join(
        spans,
        (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_tag")),
        "left",
    ).drop("_id", "_tag")
    schema = T.StructType([*keyed.select(*carry).schema.fields])
    for name, kind in (("_words", "long"), ("_removed", "long"), ("_kept", "string")):
        schema = schema.add(name, kind)
    return joined.mapInArrow(_cut(list(carry)), schema)
