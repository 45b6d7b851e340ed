"""Quality classifier: averaged hashed subword vectors, softmax output, numpy gradient descent.

A document is the mean of the vectors of its words and of the character n-grams inside them,
each found by hash in one table, plus one vector that every document has.  The output layer is
linear in that mean, so a trained model is folded into one number per hash bucket and scoring
adds and divides; it never needs the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.llm.scratch import prepare
from lakeward.llm.text import Words, as_bytes, blocks

THRESHOLD = 0.3
# Bytes of text taken apart together; the work space is about fifty times that.
BLOCK = 1 << 19


@dataclass(frozen=True)
class Settings:
    """``train_rows`` bounds the labelled sample a model is fitted on, whatever the input."""

    train_rows: int = 3_000
    bits: int = 17
    width: int = 8
    grams: tuple[int, ...] = (3, 4, 5)
    epochs: int = 4
    rate: float = 0.6
    seed: int = 7


_MIX = np.uint32(0x9E3779B1)
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _features(texts: list[bytes], settings: Settings):
    """(bucket, owner bounds) per kind of feature: words first, then each n-gram length."""
    words = Words(texts)
    shift = np.uint64(64 - settings.bits)
    found = [((words.hashes() >> shift).astype(np.int64), words.bounds)]
    data = np.where(_GAP[words.data], np.uint8(0x20), words.data)
    gaps = np.concatenate([[0], np.cumsum(data == 0x20)])
    narrow = np.uint32(32 - settings.bits)
    for n in settings.grams:
        size = len(data) - n + 1
        if size <= 0:
            continue
        code = np.full(size, np.uint32(n))
        for k in range(n):
            code = code * _MIX + data[k : k + size]
        code = (code ^ (code >> np.uint32(15))) * _MIX
        inside = gaps[n - 1 : n - 1 + size] == gaps[1 : 1 + size]
        at = np.flatnonzero(inside)
        found.append(((code[at] >> narrow).astype(np.int64), np.searchsorted(at, words.firsts)))
    return found


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def counted(settings: Settings):
    """Task function: (label, buckets, counts) of every labelled text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            buckets, counts = [], []
            for start, end in blocks(texts, BLOCK):
                found = _features(texts[start:end], settings)
                for i in range(end - start):
                    ids = np.concatenate([b[at[i] : at[i + 1]] for b, at in found])
                    ids, n = np.unique(ids, return_counts=True)
                    buckets.append(ids.astype(np.int32))
                    counts.append(n.astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"),
                    pa.array(buckets, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.float32())),
                ],
                ["label", "buckets", "counts"],
            )

    return run


def descend(samples: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings):
    """(weight per bucket, weight of the common feature): log odds of label 1, folded."""
    rng = np.random.default_rng(settings.seed)
    size = 1 << settings.bits
    vectors = rng.uniform(-1, 1, (size + 1, settings.width)) / settings.width
    output = np.zeros((settings.width, 2))
    total, step = settings.epochs * len(samples), 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(samples)):
            label, ids, n = samples[i]
            ids, share = np.append(ids, size), np.append(n, 1.0) / (n.sum() + 1.0)
            hidden = share @ vectors[ids]
            logits = hidden @ output
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[label] -= 1.0
            rate = settings.rate * (1.0 - step / total)
            back = output @ error
            output -= rate * np.outer(hidden, error)
            vectors[ids] -= rate * np.outer(share * min(len(ids), 64), back)
            step += 1
    weights = (vectors @ output) @ np.array([-1.0, 1.0])
    return weights[:size].astype(np.float32), float(weights[size])


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()):
    """Learn from at most ``train_rows`` labelled rows whose crc32(doc_id) mod 5 is not 0.

    The rows are those with the smallest hash of the id, so the choice doesn't depend on
    partitions.  Whole texts are turned into bucket counts in tasks.  A label that is neither 0
    nor 1 teaches nothing; of several labels of one document the smallest counts.  Without both
    labels in the sample every text gets the share of label 1 (0.5 without any label).
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("label"))
    )
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.train_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    counts = texts.select("label", "text").mapInArrow(
        counted(settings), "label int, buckets array<int>, counts array<float>"
    )
    # The sample is bounded, so one task can hold it; the driver receives the folded weights.
    model = counts.repartition(1).mapInArrow(trained(settings), "weights binary, common double")
    row = model.first()
    if row is None:
        return np.zeros(1 << settings.bits, np.float32), 0.0
    return np.frombuffer(row["weights"], np.float32), row["common"]


def trained(settings: Settings):
    """Task function: the weights learnt from all rows of the one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = []
        for batch in batches:
            labels, ids, n = batch.columns
            flat_ids, flat_n = ids.flatten().to_numpy(), n.flatten().to_numpy()
            ends = np.cumsum(ids.value_lengths().to_numpy())
            for label, a, b in zip(labels.to_pylist(), [0, *ends[:-1]], ends, strict=True):
                samples.append((label, flat_ids[a:b].copy(), flat_n[a:b].copy()))
        seen = {label for label, _, _ in samples}
        if len(seen) < 2:
            share = 0.5 if not seen else min(max(seen.pop(), 1e-3), 1 - 1e-3)
            weights, common = np.zeros(1 << settings.bits, np.float32), np.log(share / (1 - share))
        else:
            # Rows may arrive in any order; training must not depend on it.
            samples.sort(key=lambda s: (s[0], len(s[1]), s[1].tobytes(), s[2].tobytes()))
            weights, common = descend(samples, settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.tobytes()], pa.binary()), pa.array([float(common)])],
            ["weights", "common"],
        )

    return run


def scores(texts: list[bytes], weights: np.ndarray, common: float, settings: Settings):
    out = []
    for start, end in blocks(texts, BLOCK):
        value, number = np.full(end - start, common), np.ones(end - start)
        for bucket, bounds in _features(texts[start:end], settings):
            value += _sums(weights[bucket], bounds)
            number += np.diff(bounds)
        out.append(value / number)
    logit = np.concatenate(out) if out else np.zeros(0)
    return 1.0 / (1.0 + np.exp(-logit))


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All columns of ``docs`` and ``_score``: probability of label 1 from the whole text alone.

    A null text counts as empty and is scored by the common feature.  Rows keep their number
    and order; other columns pass through unread, but a column ``_score`` is replaced.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("_score")
    weights, common = fit(docs, labels, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = scores(as_bytes(batch.column("text")), weights, common, settings)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(score, pa.float64())], ["_row", "_score"]
            )

    # Names with dots or quotes mean something to Spark: columns travel inside one.
    names = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    boxed = docs.select("text", F.struct(*[F.col(c) for c in names]).alias("_row"))
    schema = T.StructType([boxed.schema["_row"]]).add("_score", "double")
    return boxed.mapInArrow(run, schema).select("_row.*", "_score")
