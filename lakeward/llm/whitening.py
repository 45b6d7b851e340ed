"""Whitening of embeddings by an incremental eigendecomposition.

Each partition of the distinct vectors holds the spectrum of its scatter and takes vectors in
one by one: a centred rank-one update solves the secular equation for the new eigenvalues, after
deflation.  Spectra of partitions are combined in a tree, each of one side's eigenvectors being a
rank-one update of the other.  The directions found are then refined on all vectors: the exact
centred covariance within them is summed up by partition and its eigenvectors turn them
(Rayleigh-Ritz).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.scratch import prepare, stored

SCALE = 256
COMPONENTS = 4
# States combined by one task.
WIDTH = 16
# Beyond this a scaled entry is no exact double: such a vector counts as not finite.
LARGEST = 2.0**53
EPS = np.finfo(float).eps
_STEPS = 60
# Roots this near are enough: weights are matched to them, and the refinement is exact anyway.
_NEAR = 1e-10


def _secular(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z2 / (d - x)) for rising ``d`` and positive ``rho``.

    Root i lies between d[i] and d[i + 1].  It is returned as the nearer of the two (its index)
    and the distance from there, which keeps all differences d[j] - x accurate.
    """
    n = len(d)
    upper = np.append(d[1:], d[-1] + rho * z2.sum())
    gap = upper - d
    middle = d + gap / 2
    at_middle = 1 + rho * (z2 / (d - middle[:, None])).sum(axis=1)
    low_side = (at_middle >= 0) | (np.arange(n) == n - 1)
    origin = np.where(low_side, np.arange(n), np.minimum(np.arange(n) + 1, n - 1))
    delta = d - d[origin][:, None]
    # Bounds of the distance from the origin; the function rises between the poles.
    low = np.where(low_side, 0.0, -gap / 2)
    high = np.where(low_side, gap / 2, 0.0)
    high[-1] = gap[-1] if at_middle[-1] < 0 else gap[-1] / 2
    low[-1] = gap[-1] / 2 if at_middle[-1] < 0 else 0.0
    weight = rho * z2
    below = np.arange(n) <= np.arange(n)[:, None]
    x = (low + high) / 2
    moving = np.arange(n)
    for _ in range(_STEPS):
        difference = delta[moving] - x[moving, None]
        terms = weight / difference
        slopes = terms / difference
        value = 1 + terms.sum(axis=1)
        rising = value < 0
        low[moving] = np.where(rising, x[moving], low[moving])
        high[moving] = np.where(rising, high[moving], x[moving])
        # Middle way: the two neighbouring poles carry all the slope of their side.
        side = below[moving]
        left_slope = (slopes * side).sum(axis=1)
        right_slope = slopes.sum(axis=1) - left_slope
        to_left = difference[np.arange(len(moving)), moving]
        last = moving == n - 1
        to_right = np.where(
            last, 1.0, difference[np.arange(len(moving)), np.minimum(moving + 1, n - 1)]
        )
        right_slope = np.where(last, 0.0, right_slope)
        # After a step y the value is about c + a / (to_left - y) + b / (to_right - y).
        a, b = left_slope * to_left**2, right_slope * to_right**2
        c = value - left_slope * to_left - right_slope * to_right
        # c y^2 - p y + q = 0, multiplied out.
        p = c * (to_left + to_right) + a + b
        q = c * to_left * to_right + a * to_right + b * to_left
        p, q = np.where(last, c * to_left + a, p), np.where(last, 0.0, q)
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(p * p - 4 * c * q, 0))
            step = np.where(p >= 0, 2 * q / (p + root), (p - root) / (2 * c))
            step = np.where(last, p / c, step)
            new = x[moving] + step
        outside = ~(np.isfinite(new) & (new > low[moving]) & (new < high[moving]))
        new = np.where(outside, (low[moving] + high[moving]) / 2, new)
        size = np.abs(terms).sum(axis=1) + 1
        done = (np.abs(value) <= _NEAR * size) | (
            np.abs(new - x[moving]) <= 2 * EPS * np.abs(x[moving])
        )
        keep = moving[~done]
        x[keep] = new[~done]
        moving = keep
        if not moving.size:
            break
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, x: np.ndarray, rho: float):
    """Spectrum of V diag(values) V' + rho x x', for rising ``values`` and positive ``rho``."""
    z = vectors.T @ x
    norm = np.sqrt(z @ z)
    if not norm or not rho:
        return values, vectors
    z, rho = z / norm, rho * norm * norm
    scale = max(abs(values[0]), abs(values[-1]), rho)
    limit = 8 * EPS * scale
    # Deflation: directions that x does not touch keep their value, and of directions with equal
    # values all but one are turned out of its way.
    vectors = vectors.copy()
    for i in np.flatnonzero(np.diff(values) <= limit).tolist():
        r = np.hypot(z[i], z[i + 1])
        if r:
            c, s = z[i + 1] / r, z[i] / r
            one, two = vectors[:, i].copy(), vectors[:, i + 1]
            vectors[:, i], vectors[:, i + 1] = c * one - s * two, s * one + c * two
            z[i], z[i + 1] = 0.0, r
    touched = rho * np.abs(z) > limit
    if not touched.any():
        return values, vectors
    d, w = values[touched], z[touched]
    origin, x_ = _secular(d, w * w, rho)
    difference = (d - d[origin][:, None]) - x_[:, None]  # [root, pole]
    # Weights for which these roots are exact keep the new vectors orthogonal.
    ratio = -difference.T  # [pole, root]: root - pole
    poles = d - d[:, None]
    np.fill_diagonal(poles, 1.0)
    n = len(d)
    matched = ratio.copy()
    matched[np.arange(n), np.arange(n)] = 1.0
    product = np.prod(matched / np.where(np.eye(n, dtype=bool), 1.0, poles), axis=1)
    w = np.copysign(np.sqrt(np.abs(product * ratio[np.arange(n), np.arange(n)])), w)
    turn = w / difference
    turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
    values = values.copy()
    values[touched] = d[origin] + x_
    vectors[:, touched] = vectors[:, touched] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number, exact sums, and eigenvalues and vectors of the centred scatter of some vectors."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size, object), np.zeros(size), np.eye(size))

    def add(self, rows: np.ndarray) -> None:
        """Take in rows one by one: a rank-one update along what each differs from the mean."""
        sums = self.sums.astype(float)
        for x in rows.astype(float):
            if self.n:
                away = x - sums / self.n
                weight = self.n / (self.n + 1)
                self.values, self.vectors = rank_one(self.values, self.vectors, away, weight)
            self.n += 1
            sums += x
        self.sums = self.sums + rows.sum(axis=0, dtype=object)

    def merge(self, other: Spectrum) -> None:
        """Take in another spectrum: its directions one by one, then the way between the means."""
        if self.n and other.n:
            for value, vector in zip(other.values, other.vectors.T, strict=True):
                if value > 0:
                    self.values, self.vectors = rank_one(self.values, self.vectors, vector, value)
            away = (self.sums / self.n - other.sums / other.n).astype(float)
            weight = self.n * other.n / (self.n + other.n)
            self.values, self.vectors = rank_one(self.values, self.vectors, away, weight)
        elif other.n:
            self.values, self.vectors = other.values, other.vectors
        self.n, self.sums = self.n + other.n, self.sums + other.sums

    def packed(self) -> dict:
        return {
            "n": self.n,
            "sums": [str(s) for s in self.sums],
            "numbers": np.concatenate([self.values, self.vectors.ravel()]).tobytes(),
        }

    @classmethod
    def unpacked(cls, row: dict) -> Spectrum:
        size = len(row["sums"])
        numbers = np.frombuffer(row["numbers"], float)
        sums = np.array([int(s) for s in row["sums"]], object)
        return cls(row["n"], sums, numbers[:size].copy(), numbers[size:].reshape(size, size).copy())


def _rows(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(-1, size)


def _folded(states: DataFrame, schema: str, combine: Callable[[list[dict]], dict]) -> list:
    """The last state of a tree in which a task combines ``WIDTH`` states; [] if there are none.

    ``states`` has ``part``, a number that is different in every row, and the columns of
    ``schema``.  Every level is stored, so a lost executor costs one task's states.
    """

    types = {"part": pa.int64(), "n": pa.int64(), "sums": pa.list_(pa.string())}
    names = ["part", *(f.split()[0] for f in schema.split(", "))]
    out = pa.schema([(n, types.get(n, pa.binary())) for n in names])

    def run(key, table):
        rows = sorted(table.drop_columns("_group").to_pylist(), key=lambda r: r["part"])
        row = combine(rows) | {"part": key[0].as_py()}
        return pa.Table.from_pylist([row], schema=out)

    while True:
        states = stored(states, "states")
        top = states.agg(F.max("part")).first()[0]
        if top is None or top == 0:
            return states.collect()
        states = (
            states.withColumn("_group", F.floor(F.col("part") / WIDTH))
            .groupBy("_group")
            .applyInArrow(run, f"part long, {schema}")
        )


def _usable(table: DataFrame) -> DataFrame:
    """(vec_id, x): scaled whole vectors of the rows that take part."""
    v = F.col("embedding")
    scaled = F.transform(v, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))
    fine = F.forall(
        v,
        lambda c: c.isNotNull() & (F.abs(F.lit(float(SCALE)) * c.cast("double")) < LARGEST)
    )
    taken = table.where(v.isNotNull() & (F.size(v) > 0) & fine)
    return taken.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("x"))


def _dimension(rows: DataFrame) -> int | None:
    """The length that most rows have, the smaller one of several."""
    sizes = rows.groupBy(F.size("x").alias("size")).count()
    first = sizes.orderBy(F.desc("count"), "size").first()
    return first["size"] if first else None


RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, "
    "explained double, identity_error double"
)


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every usable row of ``table`` (``vec_id``, ``embedding``).

    An entry c becomes x = floor(256 c).  The fit list has each distinct x once, n of them.
    Components are eigenvectors of its covariance (divisor n), numbered from 1 by falling
    eigenvalue.  A row and component up to ``components`` give (vec_id, component, n, deviation,
    whitened, explained, identity_error): see the columns of ``RESULT``.

    Rows whose vector is null, empty, or holds null, non-finite or (scaled) entries from 2^53 on
    take no part, nor do rows of another length than most have (of two lengths equally frequent,
    the longer).  Null and repeated vec_ids are carried along; other columns are not read; an
    empty table gives no rows.  A component without variance has explained 0 (null if there is
    no variance at all) and whitened null; identity_error is over the components with variance.
    A deviation beyond a long is null.
    """
    spark = prepare(table.sparkSession)
    rows = _usable(table)
    size = _dimension(rows)
    if size is None:
        return spark.createDataFrame([], RESULT)
    rows = rows.where(F.size("x") == size)
    # Equal vectors meet in partial aggregates: a vector with very many copies costs one row a task.
    fit = stored(rows.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit")

    def spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Spectrum.empty(size)
        for batch in batches:
            state.add(_rows(batch, "x", size))
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pylist(
            [{"part": part, **state.packed()}],
            schema=pa.schema(
                [("part", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.string())),
                 ("numbers", pa.binary())]
            ),
        )

    def combined(states: list[dict]) -> dict:
        total = Spectrum.unpacked(states[0])
        for state in states[1:]:
            total.merge(Spectrum.unpacked(state))
        return total.packed()

    schema = "n long, sums array<string>, numbers binary"
    states = fit.mapInArrow(spectra, f"part long, {schema}")
    whole = Spectrum.unpacked(_folded(states, schema, combined)[0].asDict())
    n, sums, basis = whole.n, whole.sums, whole.vectors
    exact = abs(n) * max(abs(int(s)) for s in sums) < 2**62  # n * x and S fit a long

    def centred(x: np.ndarray) -> np.ndarray:
        """n * x - S, exact, as doubles or whole numbers of any size."""
        if exact and n * int(np.abs(x).max(initial=0)) < 2**62:
            return x * n - sums.astype(np.int64)
        return x.astype(object) * n - sums

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = (centred(_rows(batch, "x", size)).astype(float) / n) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_pylist(
            [{"part": TaskContext.get().partitionId(), "numbers": total.tobytes()}],
            schema=pa.schema([("part", pa.int64()), ("numbers", pa.binary())]),
        )

    def added(states: list[dict]) -> dict:
        return {"numbers": sum(np.frombuffer(s["numbers"], float) for s in states).tobytes()}

    blocks = fit.mapInArrow(within, "part long, numbers binary")
    total = _folded(blocks, "numbers binary", added)[0]["numbers"]
    covariance = np.frombuffer(total, float).reshape(size, size) / n
    values, turn = np.linalg.eigh((covariance + covariance.T) / 2)
    kept = min(components, size)
    directions = (basis @ turn)[:, ::-1][:, :kept]
    directions /= np.sqrt((directions * directions).sum(axis=0))
    values, trace = values[::-1][:kept], float(np.trace(covariance))
    real = values > size * 64 * EPS * trace if trace > 0 else np.zeros(kept, bool)
    spread = np.sqrt(np.where(real, values, 1.0))

    def projected(x: np.ndarray) -> np.ndarray:
        w = (centred(x).astype(float) / n) @ directions / spread
        return np.where(real, w, np.nan)

    def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = projected(_rows(batch, "x", size))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in w.T], [f"w{k}" for k in range(kept)]
            )

    doubles = ", ".join(f"w{k} double" for k in range(kept))
    pairs = [(i, j) for i in range(kept) for j in range(i, kept) if real[i] and real[j]]
    error = None
    if pairs:
        covered = fit.mapInArrow(coordinates, doubles).agg(
            *[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]
        )
        found = covered.first()
        error = max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    explained = [None if trace <= 0 else float(e) if r else 0.0
                 for e, r in zip(values / (trace or 1.0), real, strict=True)]

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch, "x", size)
            w, away = projected(x), centred(x)
            if away.dtype == object or np.abs(away).max(initial=0) >= 2**31 / np.sqrt(size):
                away = [int(s) for s in (away.astype(object) ** 2).sum(axis=1)]
                away = [s if s < 2**63 else None for s in away]
            else:
                away = (away * away).sum(axis=1)
            many = len(x)
            flat = w.ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(many), kept))),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * kept, n, np.int64)),
                    pa.array(away, pa.int64()).take(pa.array(np.repeat(np.arange(many), kept))),
                    pa.array(flat, mask=np.isnan(flat)),
                    pa.array(explained * many, pa.float64()),
                    pa.array([error] * (many * kept), pa.float64()),
                ],
                [c.split()[0] for c in RESULT.split(", ")],
            )

    return rows.mapInArrow(final, RESULT)
