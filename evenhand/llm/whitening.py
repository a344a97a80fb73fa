"""Embedding whitening by incremental eigendecomposition.

Entries become integers, so their sums are exact in any order. Every task then holds a running mean and the spectrum
of its rows' scatter; a row changes the scatter by one centred rank-one term, and the new spectrum comes from the
secular equation of that term: its roots lie between the old eigenvalues. Directions that the term does not touch, and
all but one of those with equal eigenvalues, are deflated. Spectra of parts are combined in a tree, each by successive
rank-one terms: the eigenvectors of one of them, and the difference of the means. A last pass projects all centred rows
on the vectors found, sums the small matrix of products, and rotates the vectors by its eigenvectors (Rayleigh-Ritz),
which makes them exact to double precision. The driver sees the sums of a dimension and matrices of dimension by
dimension, nothing that grows with the rows.

Defined results: vectors that are null, empty or hold null or non-finite entries, or entries beyond LARGEST, are
dropped; where lengths differ, those of the most frequent length (then the longest) count and others are dropped; rows
with a null vec_id stay, repeated rows repeat; with fewer than eight dimensions there are as many components; where an
eigenvalue is zero beside the largest (one row, equal rows, dependent dimensions), ``whitened`` is null, and
``identity_error`` is taken over the others, null if there are none; ``explained`` is null where all rows are equal;
``deviation`` is null where it does not fit a long; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import only, ship, written

SCALE, SHIFT = 1024.0, 100_000
#: Entries beyond this many steps of 1 / SCALE have no integer that a sum could hold.
LARGEST = 2.0**40
COMPONENTS = 8
FAN = 16
#: Eigenvalues below this part of the largest count as zero.
ZERO = 1e-12
EPS = float(np.finfo(np.float64).eps)


def secular_roots(poles: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(squares / (poles - x)) for rising poles: the nearest pole's place and the distance from it."""
    k = len(poles)
    if k == 1:
        return np.zeros(1, dtype=int), squares
    ends = np.append(poles[1:], poles[-1] + squares.sum())
    gaps = ends - poles
    middle = poles + gaps / 2
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        at_middle = 1 + (squares / (poles - middle[:, None])).sum(axis=1)
    right = (at_middle < 0) & (np.arange(k) < k - 1)
    origin = np.arange(k) + right
    delta = poles - poles[origin][:, None]
    low, high = np.where(right, -gaps / 2, 0.0), np.where(right, 0.0, np.where(np.arange(k) < k - 1, gaps / 2, gaps))
    left_of = np.tri(k)
    pole, next_pole = poles - poles[origin], ends - poles[origin]
    x = (low + high) / 2
    todo, roots = np.arange(k), x.copy()
    with np.errstate(all="ignore"):
        for _ in range(60):
            away = 1 / (delta - x[:, None])
            below = away * left_of
            fall, value = below @ squares, 1 + away @ squares
            below_slope, slope = (below * below) @ squares, (away * away) @ squares
            low, high = np.where(value < 0, x, low), np.where(value >= 0, x, high)
            roots[todo] = x
            open_ = (np.abs(value) > 8 * EPS * (value - 2 * fall)) & (high - low > 4 * EPS * np.abs(x))
            if not open_.any():
                break
            # A step to the root of the simple fractions at the two poles beside it that have the same value and slopes.
            a, b = pole - x, next_pole - x
            c = value - a * below_slope - b * (slope - below_slope)
            p = (a + b) * value - a * b * slope
            q = a * b * value
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0.0))
            tried = x + np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            x = np.where((tried > low) & (tried < high), tried, (low + high) / 2)
            if not open_.all():
                todo, x, low, high, pole, next_pole = (v[open_] for v in (todo, x, low, high, pole, next_pole))
                delta, left_of = delta[open_], left_of[open_]
    return origin, roots


def rank_one(values: np.ndarray, vectors: np.ndarray, weight: float, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, rising, and eigenvectors of ``vectors diag(values) vectors' + weight term term'``, weight above 0."""
    z = vectors.T @ term
    length = float(z @ z)
    if weight * length == 0:
        return values, vectors
    tolerance = 8 * EPS * max(abs(values[0]), abs(values[-1]), weight * length)
    # Directions with equal eigenvalues are turned until one of them alone holds what the term has there.
    cuts = np.flatnonzero(np.diff(values) > tolerance) + 1
    if len(cuts) + 1 < len(values):
        vectors, z = vectors.copy(), z.copy()
        for start, end in zip([0, *cuts], [*cuts, len(values)]):
            size = np.linalg.norm(z[start:end])
            if end - start > 1 and size > 0:
                mirror = z[start:end].copy()
                mirror[-1] += np.copysign(size, mirror[-1])
                mirror /= np.linalg.norm(mirror)
                last = -np.copysign(size, z[end - 1])
                vectors[:, start:end] -= 2 * np.outer(vectors[:, start:end] @ mirror, mirror)
                z[start:end] = 0
                z[end - 1] = last
    active = np.flatnonzero(weight * np.abs(z) * np.sqrt(length) > tolerance)
    if not len(active):
        return values, vectors
    poles, squares = values[active], weight * z[active] ** 2
    origin, x = secular_roots(poles, squares)
    # root i minus pole j, from the distance to the nearest pole, which keeps all digits
    distance = x[:, None] - (poles - poles[origin][:, None])
    distance[distance == 0] = EPS * tolerance
    between = poles[:, None] - poles
    np.fill_diagonal(between, 1.0)
    exact = np.sqrt(np.abs(np.prod(distance / between, axis=0)))
    turn = (np.copysign(exact, z[active]) / -distance).T
    turn /= np.linalg.norm(turn, axis=0)
    values, vectors = values.copy(), vectors.copy()
    vectors[:, active] = vectors[:, active] @ turn
    values[active] = poles[origin] + x
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Rows seen, their mean, and the eigenvalues and eigenvectors of their scatter."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def nothing(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, row: np.ndarray) -> None:
        self.n += 1
        step = row - self.mean
        if self.n > 1:
            self.values, self.vectors = rank_one(self.values, self.vectors, (self.n - 1) / self.n, step)
        self.mean = self.mean + step / self.n

    def combine(self, other: Spectrum) -> None:
        if not other.n or not self.n:
            if other.n:
                self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        step, n = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, float(value), vector)
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n * other.n / n, step)
        self.mean, self.n = self.mean + step * (other.n / n), n


def integers(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors of so many entries, and their integers."""
    sizes = np.asarray(column.value_lengths().fill_null(-1))
    at = np.flatnonzero(sizes == dim)
    flat = column.take(pa.array(at)).flatten().cast(pa.float64())
    entries = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(len(at), dim)
    with np.errstate(invalid="ignore", over="ignore"):
        usable = (np.abs(entries * SCALE) <= LARGEST).all(axis=1)
    return at[usable], np.floor(entries[usable] * SCALE).astype(np.int64) + SHIFT


def _rows(embeddings: DataFrame) -> DataFrame:
    return only(embeddings, vec_id="vec_id", embedding="embedding").withColumn("embedding", F.col("embedding").cast("array<double>"))


def _packed(part: int, arrays: list[np.ndarray]) -> pa.RecordBatch:
    data = np.concatenate([np.atleast_1d(a).astype("<f8").ravel() for a in arrays]).tobytes()
    return pa.record_batch([pa.array([part], pa.int64()), pa.array([data], pa.binary())], names=["part", "data"])


PACKED = "part long, data binary"


def _tree(parts: DataFrame, combine, label: str) -> np.ndarray | None:
    """One array of doubles from those of all parts, FAN parts at a time; ``parts`` has one row per task of a stage."""
    parts = written(parts, label)
    most = parts.agg(F.max("part")).first()[0]
    if most is None:
        return None

    def some(group: pa.Table) -> pa.Table:
        # in the order of the parts, so that sums do not depend on which task ended first
        rows = sorted(zip(group.column("part").to_pylist(), group.column("data").to_pylist()))
        merged = combine([np.frombuffer(data, dtype="<f8") for _, data in rows])
        return pa.Table.from_batches([_packed(rows[0][0] // FAN, [merged])])

    while True:
        parts = parts.groupBy(F.floor(F.col("part") / FAN).alias("group")).applyInArrow(some, PACKED)
        most //= FAN
        if not most:
            return np.frombuffer(parts.first()["data"], dtype="<f8")


def sums(embeddings: DataFrame) -> tuple[int, list[int]]:
    """Number of usable vectors and their exact sums per dimension."""
    sizes = F.size("embedding")
    whole = F.forall("embedding", lambda c: F.coalesce(F.abs(c * SCALE) <= LARGEST, F.lit(False)))
    usable = _rows(embeddings).filter((sizes > 0) & whole)
    most = usable.groupBy(sizes.alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if most is None:
        return 0, []
    dim = most["dim"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim, dtype=object)
        for batch in batches:
            _, x = integers(batch.column("embedding"), dim)
            high, low = x >> 20, x & ((1 << 20) - 1)  # no sum of a batch leaves 64 bits
            total += high.sum(axis=0).astype(object) * (1 << 20) + low.sum(axis=0).astype(object)
        yield pa.record_batch([pa.array(range(dim), pa.int32()), pa.array(map(str, total))], names=["place", "total"])

    found = _rows(embeddings).mapInArrow(run, "place int, total string")
    rows = found.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return most["count"], [int(r["total"]) for r in sorted(rows, key=lambda r: r["place"])]


@dataclass
class Whitening:
    """Components of the fit list: mean, unit eigenvectors by falling eigenvalue, and the sums that make deviations."""

    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.total])

    @property
    def shown(self) -> int:
        return min(COMPONENTS, len(self.values))

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of integer rows; NaN where the eigenvalue is zero."""
        top = self.values[: self.shown]
        scale = np.where(top > ZERO * self.values[0], top, np.nan)
        return (x - self.mean) @ self.vectors[:, : self.shown] / np.sqrt(scale)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        total = np.array(self.total, dtype=object)
        away = np.abs(x.astype(object) * self.n - total) if self.n * 2 * (LARGEST + SHIFT) >= 2**62 else np.abs(x * self.n - np.array(self.total))
        if away.size and int(away.max()) ** 2 * len(total) >= 2**63:
            return [d if (d := sum(int(a) ** 2 for a in row)) < 2**63 else None for row in away]
        return (away * away).sum(axis=1).tolist()


def fit(embeddings: DataFrame) -> Whitening | None:
    """All usable vectors are the fit list; None if there is none."""
    ship(embeddings.sparkSession)
    n, total = sums(embeddings)
    if not n:
        return None
    dim, rows = len(total), _rows(embeddings)
    mean = np.array([s / n for s in total])

    def pack(s: Spectrum) -> list:
        return [np.array([s.n]), s.mean, s.values, s.vectors]

    def unpack(data: np.ndarray) -> Spectrum:
        return Spectrum(int(data[0]), data[1 : 1 + dim], data[1 + dim : 1 + 2 * dim], data[1 + 2 * dim :].reshape(dim, dim))

    def spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum.nothing(dim)
        for batch in batches:
            _, x = integers(batch.column("embedding"), dim)
            for row in x - mean:
                own.add(row)
        if own.n:
            yield _packed(TaskContext.get().partitionId(), pack(own))

    def combine(parts: list[np.ndarray]) -> np.ndarray:
        own = Spectrum.nothing(dim)
        for part in parts:
            own.combine(unpack(part))
        return np.concatenate([np.ravel(a) for a in pack(own)])

    merged = unpack(_tree(rows.mapInArrow(spectra, PACKED), combine, "spectra"))
    basis = np.linalg.qr(merged.vectors[:, ::-1])[0]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, first, second = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            _, x = integers(batch.column("embedding"), dim)
            z = (x - mean) @ basis
            count, first, second = count + len(z), first + z.sum(axis=0), second + z.T @ z
        if count:
            yield _packed(TaskContext.get().partitionId(), [first, second])

    added = _tree(rows.mapInArrow(products, PACKED), lambda parts: np.sum(parts, axis=0), "ritz")
    first, second = added[:dim] / n, added[dim:].reshape(dim, dim) / n
    ritz = second - np.outer(first, first)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, vectors = np.maximum(values[::-1], 0.0), basis @ turn[:, ::-1]
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = np.abs(vectors).argmax(axis=0)
    vectors *= np.where(vectors[largest, np.arange(dim)] < 0, -1.0, 1.0)
    return Whitening(n, total, values, vectors, float(np.trace(ritz)))


def identity_error(embeddings: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    shown, dim = model.shown, len(model.total)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, first, second = 0, np.zeros(shown), np.zeros((shown, shown))
        for batch in batches:
            w = model.project(integers(batch.column("embedding"), dim)[1])
            count, first, second = count + len(w), first + w.sum(axis=0), second + w.T @ w
        if count:
            yield _packed(TaskContext.get().partitionId(), [first, second])

    added = _tree(_rows(embeddings).mapInArrow(products, PACKED), lambda parts: np.sum(parts, axis=0), "identity")
    first, second = added[:shown] / model.n, added[shown:].reshape(shown, shown) / model.n
    away = np.abs(second - np.outer(first, first) - np.eye(shown))
    return None if np.isnan(away).all() else float(np.nanmax(away))


SCHEMA = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame) -> DataFrame:
    """One row per usable vector and component."""
    spark, model = embeddings.sparkSession, fit(embeddings)
    rows = _rows(embeddings)
    schema = SCHEMA.format(id=rows.schema["vec_id"].dataType.simpleString())
    if model is None:
        return spark.createDataFrame([], schema)
    error, dim, shown = identity_error(embeddings, model), len(model.total), model.shown
    explained = [float(v / model.trace) if model.trace > 0 else None for v in model.values[:shown]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = integers(batch.column("embedding"), dim)
            deviation = pa.array(model.deviations(x), pa.int64())
            each, count = np.repeat(np.arange(len(at)), shown), len(at) * shown
            whitened = model.project(x).ravel()
            yield pa.record_batch(
                [
                    batch.column("vec_id").take(pa.array(at[each])), pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(count, model.n)), deviation.take(pa.array(each)), pa.array(whitened, mask=np.isnan(whitened)),
                    pa.array(explained * len(at), pa.float64()), pa.array([error] * count, pa.float64()),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
