"""Near duplicates by min-max hashing: minimum and maximum of every permutation, banded.

Each permutation of the shingles is computed once and gives two signature values, its smallest
and its largest.  Either agrees between two sets with the probability of their Jaccard
similarity, so both are unbiased and half the permutations fill a signature.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.components import components
from lakeward.llm.scratch import in_tasks, prepare, stored
from lakeward.llm.text import Words, as_bytes, blocks, mix, runs


GROWTH = 64
# Words of 64 bits in the sketch of a set.
SKETCH = 16
# A pair with its texts counts as so many rows.
TEXTS = 32
# Shingles permuted at a time: a work space that stays in the processor's cache.
CHUNK = 1024
# Bytes of text whose words are laid out together; the work space is about fifty times that.
BLOCK = 1 << 19


@dataclass(frozen=True)
class Settings:
    """``bands`` (even) of ``rows`` values from ``bands * rows / 2`` permutations.

    At a similarity of 0.8 a pair shares no band with probability (1 - 0.8**5)**40, about 1e-7.
    """

    shingle: int = 2
    percent: int = 80
    bands: int = 40
    rows: int = 5
    seed: int = 11


def _sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text; A-Z count as a-z."""
    for start, end in blocks(texts, BLOCK):
        words = Words([t.lower() for t in texts[start:end]])
        hashes, bounds = words.hashes(), words.bounds.tolist()
        full = runs(hashes, width)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if 0 < b - a < width:
                yield runs(hashes[a:b], b - a)
                continue
            own = np.sort(full[a : max(a, b - width + 1)])
            new = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            yield own[new]


class _Signer:
    def __init__(self, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        number = settings.bands * settings.rows // 2
        # An odd factor permutes 32-bit values, which vector units multiply several at once.
        self.factor = rng.integers(0, 2**31, (number, 1)).astype(np.uint32) * np.uint32(2) + np.uint32(1)
        self.salt = mix(np.arange(1, settings.bands + 1, dtype=np.uint64))
        self.rows = settings.rows
        self.space = np.empty((number, CHUNK), np.uint32)

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        low = high = None
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        for a in range(0, len(short), CHUNK):
            some = short[a : a + CHUNK]
            part = np.multiply(some, self.factor, out=self.space[:, : len(some)])
            least, most = part.min(axis=1), part.max(axis=1)
            low = least if low is None else np.minimum(low, least)
            high = most if high is None else np.maximum(high, most)
        values = np.concatenate([low, high]).reshape(-1, self.rows).astype(np.uint64)
        key = self.salt
        for column in values.T:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
        return key.view(np.int64)


def _odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Bits that tell, for each of as many classes of hashes, whether the set holds an odd number.

    A shingle that only one of two sets has turns one bit over, so sketches differ in no more
    bits than sets differ in shingles.
    """
    bits = 64 * SKETCH
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _profile(settings: Settings, own: Sequence[str]):
    """Task function: the columns ``own``, and size, digest and band keys of every text's set."""
    other = np.uint64(0xA24BAED4963EE407)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = _Signer(settings)
        for batch in batches:
            number, first, second, bands, odd = [], [], [], [], []
            for shingles in _sets(as_bytes(batch.column("text")), settings.shingle):
                number.append(len(shingles))
                first.append(np.bitwise_xor.reduce(mix(shingles)).astype(np.int64))
                second.append(np.add.reduce(mix(shingles ^ other)).astype(np.int64))
                bands.append(signer.bands(shingles) if len(shingles) else np.zeros(0, np.int64))
                odd.append(_odd_sketch(shingles))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in own],
                    pa.array(number, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(odd, pa.list_(pa.int64())),
                ],
                [*own, "n_shingles", "d1", "d2", "bands", "odd"],
            )

    return run


def _linked(settings: Settings):
    """Task function: the pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, held = None, None
            keep = []
            lefts, rights = as_bytes(batch.column("text_a")), as_bytes(batch.column("text_b"))
            right_sets = _sets(rights, settings.shingle)
            for left, right in zip(lefts, right_sets, strict=True):
                if left != last:
                    last, held = left, next(_sets([left], settings.shingle))
                both = len(np.intersect1d(held, right, assume_unique=True))
                whole = len(held) + len(right) - both
                keep.append(whole > 0 and 100 * both >= settings.percent * whole)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"]
            )

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(_linked(settings), "a long, b long")


def _alone(texts: DataFrame, settings: Settings) -> DataFrame:
    """(id, u): how many shingles of a text no other of these ``texts`` has; texts with some.

    A doc_id with several rows has several sets, and counts as one that shares all it has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for i, shingles in zip(ids, _sets(as_bytes(batch.column("text")), settings.shingle), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(shingles), i)), pa.array(shingles.view(np.int64))],
                    ["id", "shingle"],
                )

    held = texts.select("doc_id", "text").mapInArrow(run, "id long, shingle long")
    once = held.groupBy("shingle").agg(F.min("id").alias("id"), F.max("id").alias("last"))
    single = texts.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("rows")).where("rows = 1")
    found = once.where("id = last").groupBy("id").agg(F.count("*").alias("u"))
    return found.join(single, "id", "left_semi")


def _may_link(settings: Settings, n, u, m, v):
    """Whether sets of n and m shingles can be similar enough when u and v of them are in no
    other set: at most the rest of either is common.
    """
    common = F.least(n - u, m - v)
    return (100 + settings.percent) * common >= settings.percent * (n + m)


def _near(settings: Settings, n, odd, m, other):
    """Whether sketches differ in few enough bits: similar sets differ in few shingles."""
    apart = sum((F.bit_count(odd[i].bitwiseXOR(other[i])) for i in range(SKETCH)), F.lit(0))
    return (100 + settings.percent) * apart <= (100 - settings.percent) * (n + m)


def _links(
    members: DataFrame, texts: DataFrame, sketches: DataFrame, settings: Settings
) -> DataFrame | None:
    """(id, component) of the linked members of shared buckets.

    In each turn some members of a bucket, its pivots, are compared with all members that
    aren't in their component yet; what they link becomes one component.  Turns take other
    pivots, ``GROWTH`` times as many each time, until every bucket is one component or all its
    members have been pivots.  So each pair that shares a bucket is compared or already
    connected, while a large group of copies costs a few comparisons per member.

    Pairs that cannot be similar enough are not compared on full sets.  In the first turn the
    numbers of shingles tell.  Buckets that it leaves open carry more: a sketch of every set,
    which bounds how much two sets differ, and the number of shingles that a member shares with
    no other member still open.  Near copies of one text differ by such shingles, so the copies
    with the fewest, the next pivots, link nearly all that can be linked.
    """
    first = members.withColumns({"component": F.col("id"), "u": F.lit(0).cast("long")})
    rows = members.count()
    order = Window.partitionBy("bucket").orderBy(F.xxhash64("id"), "id")
    left = first.withColumn("place", F.row_number().over(order)).where("place = 1")
    found = _turn(first, stored(in_tasks(left, rows), "pivots"), texts, None, settings)
    now = stored(in_tasks(_joined(first, found), rows), "members")
    ends = now.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = stored(in_tasks(ends.where("low < high").select("bucket"), rows), "buckets")
    now = now.drop("u").join(open_, "bucket", "left_semi")
    now = stored(in_tasks(now.join(sketches, ["id", "n", "d1"]), rows), "open")
    rows = now.count()
    if not rows:
        return found
    ids = stored(in_tasks(now.select(F.col("id").alias("doc_id")).distinct(), rows), "ids")
    alone = _alone(texts.join(ids, "doc_id", "left_semi"), settings)
    alone = stored(in_tasks(alone, rows), "alone")
    now = now.join(alone, "id", "left").withColumn("u", F.coalesce("u", F.lit(0)))
    rest = _open(stored(in_tasks(now, rows), "members"), settings)
    key, last, pivots = F.struct("u", F.xxhash64("id").alias("h"), "id"), None, 1
    order = Window.partitionBy("bucket").orderBy("u", F.xxhash64("id"), "id")
    while rows := rest.count():
        free = rest
        if last is not None:
            free = rest.join(last, "bucket", "left").where(
                F.col("last").isNull() | (key > F.col("last"))
            )
        ranked = free.withColumn("place", F.row_number().over(order))
        left = ranked.where(F.col("place") <= pivots).withColumn("key", key)
        left = stored(in_tasks(left, rows), "pivots")
        found = _turn(rest, left, texts, found, settings)
        newest = left.groupBy("bucket").agg(F.max("key").alias("newest"))
        if last is None:
            last = newest.withColumnRenamed("newest", "last")
        else:
            last = newest.join(last, "bucket", "full").select(
                "bucket", F.coalesce("newest", "last").alias("last")
            )
        last, pivots = stored(in_tasks(last, rows), "last"), GROWTH * pivots
        rest = _open(stored(in_tasks(_joined(rest, found), rows), "members"), settings, last)
    return found


def _joined(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with the component that they belong to by now."""
    now = members.drop("component").join(found, "id", "left")
    return now.withColumn("component", F.coalesce("component", "id"))


def _turn(
    members: DataFrame, pivots: DataFrame, texts: DataFrame, found: DataFrame | None, settings: Settings
) -> DataFrame:
    """(id, component) after members have been compared with the pivots of their buckets."""
    known = {"id": "p", "component": "c", "n": "m", "u": "v", "odd": "other"}
    left = pivots.select("bucket", *[F.col(a).alias(b) for a, b in known.items() if a in pivots.columns])
    may = _may_link(settings, F.col("n"), F.col("u"), F.col("m"), F.col("v"))
    if "odd" in members.columns:
        may &= _near(settings, F.col("n"), F.col("odd"), F.col("m"), F.col("other"))
    rows = members.count()
    pairs = members.join(left, "bucket").where((F.col("component") != F.col("c")) & may)
    pairs = pairs.select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b"))
    pairs = stored(in_tasks(in_tasks(pairs, rows).distinct(), rows), "pairs")
    # Every pair brings two texts along: fewer of them make a task.
    links = _confirmed(pairs, texts, settings)
    links = stored(in_tasks(links, TEXTS * pairs.count()), "confirmed")
    if found is not None:
        links = links.unionAll(found.select(F.col("id").alias("a"), F.col("component").alias("b")))
    return stored(in_tasks(components(links), links.count()), "components")


def _open(members: DataFrame, settings: Settings, last: DataFrame | None = None) -> DataFrame:
    """Members that may still be linked with another component of their bucket.

    Members that no other member of the bucket can be similar enough to are left out, then
    buckets of one component, and those in which every member has been a pivot.
    """
    percent, n, u = settings.percent, F.col("n"), F.col("u")
    rows = members.count()
    reach = (100 + percent) * (n - u)
    key = F.struct("u", F.xxhash64("id").alias("h"), "id")
    buckets = members.groupBy("bucket").agg(
        F.max(reach - percent * n).alias("best"),
        F.min(n).alias("least"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.max(key).alias("end"),
    )
    buckets = buckets.where("low < high")
    if last is not None:
        buckets = buckets.join(last, "bucket", "left").where("last IS NULL OR end > last")
    buckets = stored(in_tasks(buckets.select("bucket", "best", "least"), rows), "buckets")
    alive = (F.col("best") >= percent * n) & (reach >= percent * (n + F.col("least")))
    some = members.join(buckets, "bucket").where(alive).drop("best", "least")
    return stored(in_tasks(some, rows), "open")


def near_duplicates(
    docs: DataFrame, settings: Settings = Settings(), with_digest: bool = False
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    ``with_digest`` adds ``text_sha256``, which tells rows without doc_id apart.

    A document's set holds the hashes (64 bits) of its distinct shingles of ``shingle`` words;
    fewer words make one shingle, no words none.  Equal sets are one class from the start, and
    only classes are banded.  Pairs that share a band are confirmed on full sets.
    ``component_id`` is the smallest doc_id reachable over links, ``kept`` marks it.  A text
    without words is linked with nothing.  Rows that repeat a doc_id get a row each, and count
    as linked if any of their texts is.  A row without doc_id joins a class of equal sets, but
    links nothing else; alone it has no component and is kept.
    """
    prepare(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    own = {"doc_id": "long", **({"text_sha256": "string"} if with_digest else {})}
    read = slim.withColumn("text_sha256", F.sha2("text", 256)) if with_digest else slim
    profile = stored(
        read.mapInArrow(
            _profile(settings, list(own)),
            ", ".join(f"{c} {kind}" for c, kind in own.items())
            + ", n_shingles long, d1 long, d2 long, bands array<long>, odd array<long>",
        ),
        "profile",
    )
    digest = ["n_shingles", "d1", "d2"]
    classes = profile.where("n_shingles > 0").groupBy(*digest).agg(
        F.min("doc_id").alias("rep"), F.min("bands").alias("bands"), F.min("odd").alias("odd")
    )
    # A row of a class stands for its bands.
    classes = stored(in_tasks(classes, settings.bands * profile.count()), "classes")
    rows = settings.bands * classes.count()
    bands = classes.where("rep IS NOT NULL").select(
        F.col("rep").alias("id"),
        F.col("n_shingles").alias("n"),
        "d1",
        F.explode("bands").alias("bucket"),
    )
    shared = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(in_tasks(shared.select("bucket"), rows), "buckets")
    members = stored(in_tasks(bands.join(shared, "bucket", "left_semi"), rows), "members")
    ids = members.select(F.col("id").alias("doc_id")).distinct()
    texts = slim.where("doc_id IS NOT NULL").join(
        stored(in_tasks(ids, rows), "ids"), "doc_id", "left_semi"
    )
    texts = stored(in_tasks(texts, rows), "texts")
    sketches = classes.select(F.col("rep").alias("id"), F.col("n_shingles").alias("n"), "d1", "odd")
    found = _links(members, texts, sketches, settings)
    joined = classes.drop("bands", "odd").join(
        found.select(F.col("id").alias("rep"), "component"), "rep", "left"
    )
    joined = joined.select(*digest, F.coalesce("component", "rep").alias("component"))
    joined = stored(in_tasks(joined, rows), "classes")
    return profile.drop("bands", "odd").join(joined, digest, "left").select(
        *own,
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("component", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
    )
