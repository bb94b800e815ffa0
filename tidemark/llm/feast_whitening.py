"""Embedding whitening with components from FEAST contour integration.

1. Entries become whole numbers, so that sums and deviations are exact. Sums and the
   covariance of all fitted rows are added up per partition as d x d numbers and merged by
   grouped sums: what comes back depends on the dimension, never on the rows.
2. The spectrum from the top down is cut into intervals of few eigenvalues each.
   How many lie above a shift is the inertia of the shifted covariance: the signs of the
   pivots of its symmetric elimination (Sylvester).
3. Every interval is one Spark task. A circle around it is the contour; quadrature of
   complex shifted solves (z I - V) X = Q along it projects a seeded block onto the
   interval's eigenspace, and Rayleigh-Ritz takes the eigenpairs from the block. That is
   repeated until the residuals are at rounding level. The task must find as many pairs as
   the inertia counts say, so none is missed; if not, it fails instead of returning less.
4. One more Rayleigh-Ritz over all found vectors makes them orthogonal across intervals,
   and rows are projected in Arrow batches.

Defined cases: a vector that is null, has no entries, or holds a null or non-finite entry
takes no part; nor does one with an entry of 2^34 and more either way (beyond exact sums)
or of another length than most (ties: the longer). Zero vectors take part. Null ids and
rows that repeat are rows of their own. Directions without variance (eigenvalue up to
1e-10 of the covariance's norm) are no components, so one row or equal rows give no result
rows; nor does an empty table. Equal eigenvalues give some orthonormal basis of their
space, the same for all rows. A deviation beyond a long is null. Columns other than the
two named are not read; their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import Scratch

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 34)
COMPONENTS = 32
SLICE = 8  # eigenvalues an interval may hold before it is cut again
NODES = 12  # quadrature points on the half circle
ROUNDS = 30
TOLERANCE = 1e-13  # of residuals, against the norm of the covariance
RANK = 1e-10
NARROWEST = 1e-9  # an interval this narrow is a cluster and stays whole
WIDEST = 16  # highest over lowest end; wider ones are cut, so that what lies below is well outside the circle
SEED = 13


def fixed_point(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x): entries as whole numbers, of the vectors that take part."""
    fine = vectors.select("vec_id", F.col(vector).cast("array<double>").alias("v")).filter(
        F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    )
    lengths = fine.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("n")).limit(1).select("n")
    alike = fine.join(F.broadcast(usual), F.size("v") == F.col("n"))  # one row
    return alike.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, len(batch.column("x")[0]))
                place = np.arange(-1, x.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.append(len(x), x.sum(axis=0)))], names=["i", "s"])

    added = rows.select("x").mapInArrow(run, "i bigint, s bigint").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = {r["i"]: int(r["s"]) for r in added.collect()}  # one row per dimension
    return found.pop(-1, 0), [found[i] for i in sorted(found)]


@dataclass(frozen=True)
class Centre:
    """The mean as a whole part and the rest of each entry, so that centring loses no digits."""

    n: int
    total: list[int]

    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.total], dtype="int64")

    def rest(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.total])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole()) - self.rest()

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2 of each row; None where a long does not hold it."""
        off, rest = x - self.whole(), np.array([s % self.n for s in self.total], dtype=object)
        most = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if x.shape[1] * most**2 < 1 << 63:
            return ((self.n * off - rest.astype("int64")) ** 2).sum(axis=1).tolist()
        exact = ((off.astype(object) * self.n - rest) ** 2).sum(axis=1)
        return [int(s) if s < 1 << 63 else None for s in exact]


def covariance(rows: DataFrame, centre: Centre, onto: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor n) of the centred rows, or of their products with ``onto``."""
    d = len(centre.total) if onto is None else onto.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((d, d))
        for batch in batches:
            y = centre.centred(_matrix(batch, len(centre.total)))
            y = y if onto is None else y @ onto
            gram += y.T @ y
        i, j = np.divmod(np.arange(d * d), d)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(gram.ravel())], names=["i", "j", "s"])

    added = rows.select("x").mapInArrow(run, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    v = np.zeros((d, d))
    for r in added.collect():  # d x d numbers
        v[r["i"], r["j"]] = r["s"] / centre.n
    return (v + v.T) / 2


def above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``v`` above ``shift``: positive pivots of one or two rows (Bunch and Parlett)."""
    a, count = v - shift * np.eye(len(v)), 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        beside = np.abs(a)
        np.fill_diagonal(beside, 0.0)
        p, q = divmod(int(beside.argmax()), len(a))
        i = int(diagonal.argmax())
        if not max(diagonal[i], beside[p, q]):
            break
        if diagonal[i] >= (1 + 17**0.5) / 8 * beside[p, q]:
            pivot, count = [i], count + int(a[i, i] > 0)
        else:
            pivot, count = [p, q], count + 1  # such a block has one pivot of each sign
        others = np.setdiff1d(np.arange(len(a)), pivot)
        side = a[np.ix_(pivot, others)]
        a = a[np.ix_(others, others)] - side.T @ np.linalg.solve(a[np.ix_(pivot, pivot)], side)
    return count


def _cut(v: np.ndarray, low: float, high: float) -> tuple[float, int]:
    """A shift inside the interval with no eigenvalue next to it, and how many lie above it."""
    for part in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7):
        shift = low * (high / low) ** part if high > WIDEST * low else low + part * (high - low)
        margin = min(shift - low, high - shift) / 200
        upper, lower = above(v, shift + margin), above(v, shift - margin)
        if upper == lower:
            break
    return shift, above(v, shift)


def intervals(v: np.ndarray, wanted: int, slice_size: int = SLICE) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues in it): disjoint intervals that hold the ``wanted`` largest."""
    top = float(np.abs(v).sum(axis=1).max(initial=0.0)) * 1.001
    if top == 0.0:
        return []
    floor = RANK * top
    total, out = above(v, floor), []
    todo = [(floor, top, 0, total)]
    while todo:
        low, high, before, upto = todo.pop()
        if upto == before or before >= wanted:
            continue
        if (upto - before <= slice_size and high <= WIDEST * low) or high - low <= NARROWEST * top:
            out.append((low, high, upto - before))
            continue
        shift, count = _cut(v, low, high)
        todo += [(low, shift, count, upto), (shift, high, before, count)]
    return out


def feast(v: np.ndarray, low: float, high: float, count: int, nodes: int = NODES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of ``v`` in the interval and their unit vectors as columns."""
    d = len(v)
    norm = float(np.abs(v).sum(axis=1).max())
    block = np.random.default_rng(seed).standard_normal((d, min(d, 2 * count + 8)))
    x, weights = np.polynomial.legendre.leggauss(nodes)
    circle = (high - low) / 2 * np.exp(0.5j * np.pi * (x + 1))  # the upper half; the lower is its mirror image
    for _ in range(ROUNDS):
        projected = np.zeros_like(block)
        for z, w in zip(circle, weights):
            projected += 0.5 * w * np.real(z * np.linalg.solve(((low + high) / 2 + z) * np.eye(d) - v, block))
        basis = np.linalg.qr(projected)[0]
        e, u = np.linalg.eigh(basis.T @ v @ basis)  # Rayleigh-Ritz on the block
        block = basis @ u
        off = np.sqrt(((v @ block - block * e) ** 2).sum(axis=0))
        inside = (e > low) & (e <= high) & (off <= TOLERANCE * norm)
        if inside.sum() == count:
            return e[inside], block[:, inside]
    raise ArithmeticError(f"{int(inside.sum())} of {count} eigenpairs found between {low} and {high}")


def components(spark: SparkSession, v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns. One task per interval."""
    parts = intervals(v, wanted)
    if not parts:
        return np.zeros(0), np.zeros((len(v), 0))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                _, u = feast(v, part["low"], part["high"], part["n"])
                yield pa.RecordBatch.from_arrays([pa.array(list(u.T), pa.list_(pa.float64()))], names=["u"])

    work = spark.createDataFrame(parts, "low double, high double, n bigint").repartition(len(parts))
    found = work.mapInArrow(solve, "u array<double>").collect()  # vectors of d numbers, no more than asked for and a slice
    basis = np.linalg.qr(np.array([r["u"] for r in found]).T)[0]
    e, u = np.linalg.eigh(basis.T @ v @ basis)  # across intervals
    u = (basis @ u)[:, ::-1][:, :wanted]
    u *= np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])])
    return e[::-1][:wanted], u


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    def scaled(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, wanted: int = COMPONENTS) -> Whitening:
    """From rows (vec_id, x) of ``fixed_point``; all of them are fitted."""
    n, total = sums(rows)
    if not n:
        return Whitening(Centre(1, []), 0.0, np.zeros(0), np.zeros((0, 0)))
    centre = Centre(n, total)
    v = covariance(rows, centre)
    return Whitening(centre, float(np.trace(v)), *components(rows.sparkSession, v, wanted))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, from the rows."""
    if not len(model.values):
        return 0.0
    return float(np.abs(covariance(rows, model.centre, model.scaled()) - np.eye(len(model.values))).max())


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened): whitened has one number per component."""
    d, scaled = len(model.centre.total), model.scaled()
    schema = rows.select("vec_id").limit(0).withColumn("deviation", F.lit(None).cast("bigint")).withColumn(
        "whitened", F.array().cast("array<double>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, d) if d else np.zeros((batch.num_rows, 0), dtype="int64")
            z = model.centre.centred(x) @ scaled if d else x.astype(float)
            ends = np.arange(len(x) + 1, dtype="int32") * z.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(model.centre.deviations(x), pa.int64()), pa.ListArray.from_arrays(ends, z.ravel())],
                names=["vec_id", "deviation", "whitened"],
            )

    return rows.select("vec_id", "x").mapInArrow(run, schema)


def whiten(vectors: DataFrame, wanted: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """(vec_id, n, deviation, whitened, explained, identity_error) of every vector that takes
    part; whitened and explained have one number per component, the strongest first."""
    rows = Scratch(vectors.sparkSession, "whitening").put(fixed_point(vectors, vector), "rows")
    model = fit(rows, wanted)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")
    return transform(rows, model).select(
        "vec_id", F.lit(model.centre.n).cast("bigint").alias("n"), "deviation", "whitened", shares.alias("explained"),
        F.lit(identity_error(rows, model)).alias("identity_error"),
    )
