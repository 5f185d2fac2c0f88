"""Embedding whitening by incremental eigendecomposition.

Every partition keeps the spectrum of the scatter matrix of the rows it has seen. A row enters by one
rank-one update, centred on the running mean: the new eigenvalues are the roots of the secular equation
``1 + rho * sum(z_j^2 / (l_j - m)) = 0``, one in each gap between the old ones; the new eigenvectors follow
from the roots. Deflation leaves out what does not change: equal eigenvalues are rotated so that only one
of them has a share in the update, and coordinates without a share stay as they are.

Spectra of partitions are combined in a tree of groups of FAN_IN: the eigenvectors of one spectrum enter the
other one by one, as rank-one updates weighted with their eigenvalues, then the difference of the two means.
A combined spectrum is a fixed number of bytes (d * d numbers), so nothing grows with the rows.

The final basis is refined by Rayleigh and Ritz: one distributed pass projects the centred rows on it and
adds up their products; the eigenvectors of that small matrix turn the basis into the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import pa_schema, query, table
from fieldlens.session import discard, stored

FAN_IN = 16
COMPONENTS = 8
# The whole number that stands for an entry c is floor(SCALE * c) + OFFSET, by the operator's contract.
SCALE, OFFSET = 1024, 100_000
_EPS = np.finfo(float).eps


def secular_roots(poles: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho * sum(z2_j / (poles_j - m))``: the root above each pole, and ``poles_j - root_i`` as [i, j].

    ``poles`` rise strictly, all of ``z2`` and ``rho`` are positive. Every root is sought as its distance from the
    nearer pole, so the differences lose no digits. Steps interpolate each side of the equation by a
    pole of its own; a step that leaves the bracket is a bisection instead.
    """
    k = len(poles)
    weight = rho * z2
    upper = np.append(poles[1:], poles[-1] + weight.sum())
    gap = upper - poles
    middle = gap / 2
    across = poles[None, :] - poles[:, None]
    at_middle = 1 + (weight / (across - middle[:, None])).sum(axis=1)
    # The last root has no pole above it: it is measured from its own.
    right = (at_middle < 0) & (np.arange(k) < k - 1)
    delta = across - np.where(right, gap, 0)[:, None]
    lo = np.where(right, -middle, np.where(at_middle < 0, middle, 0.0))
    hi = np.where(right, 0.0, np.where(at_middle < 0, gap, middle))
    tau = (lo + hi) / 2
    low_side = np.tri(k, dtype=bool)
    own = delta[np.arange(k), np.arange(k)]
    nxt = np.append(delta[np.arange(k - 1), np.arange(1, k)], np.inf)
    for _ in range(80):
        apart = delta - tau[:, None]
        share = weight / apart
        slope = share / apart
        value = 1 + share.sum(axis=1)
        size = 1 + np.abs(share).sum(axis=1)
        done = (np.abs(value) <= 4 * _EPS * size) | (hi - lo <= 2 * _EPS * np.abs(tau))
        if done.all():
            break
        below = value < 0
        lo, hi = np.where(below, tau, lo), np.where(below, hi, tau)
        psi = np.where(low_side, slope, 0).sum(axis=1)
        phi = slope.sum(axis=1) - psi
        d1, d2 = own - tau, nxt - tau
        d2[-1] = 1.0
        c = value - d1 * psi - d2 * phi
        a = (d1 + d2) * value - d1 * d2 * (psi + phi)
        b = d1 * d2 * value
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = d1[-1] + d1[-1] ** 2 * psi[-1] / (value[-1] - d1[-1] * psi[-1])
        new = tau + step
        outside = ~((new > lo) & (new < hi))
        tau = np.where(done, tau, np.where(outside, (lo + hi) / 2, new))
    return poles + np.where(right, gap, 0) + tau, delta - tau[:, None]


@dataclass
class Spectrum:
    """``n`` vectors' sums, mean, and scatter matrix as rising eigenvalues and eigenvectors in columns."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of_none(cls, d: int) -> Spectrum:
        return cls(0, np.zeros(d, np.int64), np.zeros(d), np.zeros(d), np.eye(d))

    def update(self, x: np.ndarray, rho: float) -> None:
        """Scatter matrix plus ``rho * x x^T``."""
        z = self.vectors.T @ x
        z2 = z * z
        bound = 8 * _EPS * max(self.values[-1], rho * z2.sum())
        if not bound:
            return
        equal = np.diff(self.values) <= bound
        if equal.any():
            self._gather(z, equal)
            z2 = z * z
        active = rho * np.abs(z) * np.sqrt(z2.sum()) > bound
        if active.all():
            self.values, turn = self._turned(self.values, z, z2, rho)
            self.vectors = self.vectors @ turn
        elif active.any():
            at = np.flatnonzero(active)
            values, turn = self._turned(self.values[at], z[at], z2[at], rho)
            self.values[at] = values
            self.vectors[:, at] = self.vectors[:, at] @ turn
            order = np.argsort(self.values, kind="stable")
            self.values, self.vectors = self.values[order], self.vectors[:, order]

    def _gather(self, z: np.ndarray, equal: np.ndarray) -> None:
        """Reflect every run of equal eigenvalues so that its last vector alone has a share in ``z``."""
        ends = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
        for a, b in zip(ends[::2], ends[1::2] + 1):
            part = z[a:b]
            norm = np.linalg.norm(part)
            if not norm:
                continue
            share = np.copysign(norm, part[-1])
            mirror = part.copy()
            mirror[-1] += share
            mirror /= np.linalg.norm(mirror)
            self.vectors[:, a:b] -= 2 * np.outer(self.vectors[:, a:b] @ mirror, mirror)
            z[a:b] = 0
            z[b - 1] = -share
            self.values[a:b] = self.values[a:b].mean()

    @staticmethod
    def _turned(poles: np.ndarray, z: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
        """Eigenvalues and eigenvectors of ``diag(poles) + rho * z z^T``.

        The vectors belong to the z that has the computed roots exactly, which keeps them orthogonal.
        """
        roots, apart = secular_roots(poles, z2, rho)
        between = poles[None, :] - poles[:, None]
        np.fill_diagonal(between, 1.0)
        exact = np.sqrt(np.abs(np.prod(apart / between, axis=0)))
        turn = (np.copysign(exact, z) / apart).T
        turn /= np.sqrt((turn * turn).sum(axis=0))
        return roots, turn

    def add(self, x: np.ndarray, times: int = 1) -> None:
        """``times`` equal rows."""
        if self.n:
            self.update(x - self.mean, self.n * times / (self.n + times))
        self.n += times
        self.sums += x * times
        self.mean = self.mean + (x - self.mean) * (times / self.n)

    def merge(self, other: Spectrum) -> None:
        """The spectrum of both sets of rows."""
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(vector, value)
        both = self.n + other.n
        self.update(other.mean - self.mean, self.n * other.n / both)
        self.sums = self.sums + other.sums
        self.mean = self.mean + (other.mean - self.mean) * (other.n / both)
        self.n = both


    def packed(self) -> bytes:
        numbers = np.concatenate([self.mean, self.values, self.vectors.ravel()])
        return np.append(self.sums, self.n).astype(np.int64).tobytes() + numbers.tobytes()

    @classmethod
    def unpacked(cls, state: bytes, d: int) -> Spectrum:
        whole = np.frombuffer(state, np.int64, d + 1)
        numbers = np.frombuffer(state, float, offset=8 * (d + 1)).copy()
        return cls(int(whole[d]), whole[:d].copy(), numbers[:d], numbers[d:2 * d], numbers[2 * d:].reshape(d, d))


@dataclass
class Moments:
    """``n`` rows of ``k`` numbers: their mean and the sum of products of their deviations from it."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def of_none(cls, k: int) -> Moments:
        return cls(0, np.zeros(k), np.zeros((k, k)))

    def add(self, rows: np.ndarray) -> None:
        mean = rows.mean(axis=0)
        apart = rows - mean
        self.merge(Moments(len(rows), mean, apart.T @ apart))

    def merge(self, other: Moments) -> None:
        both = self.n + other.n
        apart = other.mean - self.mean
        self.products = self.products + other.products + np.outer(apart, apart) * (self.n * other.n / both)
        self.mean = self.mean + apart * (other.n / both)
        self.n = both

    def packed(self) -> bytes:
        return np.concatenate([[float(self.n)], self.mean, self.products.ravel()]).tobytes()

    @classmethod
    def unpacked(cls, state: bytes, k: int) -> Moments:
        numbers = np.frombuffer(state, float).copy()
        return cls(int(numbers[0]), numbers[1:k + 1], numbers[k + 1:].reshape(k, k))


STATES = "part long, n long, state binary"


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _one_per_partition(rows: DataFrame, kind: type, k: int, enter: Callable[[Spectrum | Moments, np.ndarray], None],
                       d: int) -> DataFrame:
    """The state of every partition that has rows, named by the partition."""
    schema = pa_schema(rows.sparkSession, STATES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = kind.of_none(k)
        for batch in batches:
            if len(batch):
                enter(held, _matrix(batch.column(0), d))
        if held.n:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist([{"part": part, "n": held.n, "state": held.packed()}], schema=schema)

    return rows.select("x").mapInArrow(run, STATES)


def _combined(states: DataFrame, kind: type, k: int, label: str):
    """One state of all, or None: rounds of groups of FAN_IN, each written to the shared folder; the largest of
    a group takes the others in."""
    schema = pa_schema(states.sparkSession, STATES)

    def run(key: tuple, group: pa.Table) -> pa.Table:
        held = None
        for row in sorted(group.to_pylist(), key=lambda r: (-r["n"], r["part"])):
            state = kind.unpacked(row["state"], k)
            if held is None:
                held = state
            else:
                held.merge(state)
        return pa.Table.from_pylist([{"part": key[0].as_py(), "n": held.n, "state": held.packed()}], schema=schema)

    saved, n = stored(states, label)
    while n > 1:
        groups = saved.withColumn("part", F.shiftright("part", FAN_IN.bit_length() - 1)).groupBy("part")
        fewer, n = stored(groups.applyInArrow(run, STATES), label)
        discard(saved)
        saved = fewer
    row = saved.first()
    discard(saved)
    return row and kind.unpacked(row["state"], k)


def _enter_rows(held: Spectrum, x: np.ndarray) -> None:
    """Equal rows of a batch are one update of their weight."""
    x = np.ascontiguousarray(x)
    _, first, times = np.unique(x.view(f"V{x.shape[1] * 8}").ravel(), return_index=True, return_counts=True)
    for at, n in zip(first, times):
        held.add(x[at], int(n))


@dataclass
class Whitening:
    """What the rows of a fit list say: ``components`` in columns, of falling eigenvalue ``variances``."""

    n: int
    sums: np.ndarray
    variances: np.ndarray
    components: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray, k: int) -> np.ndarray:
        return self.projected(x, self.components[:, :k] / np.sqrt(self.variances[:k]))

    def projected(self, x: np.ndarray, basis: np.ndarray) -> np.ndarray:
        """Centred without rounding, then multiplied."""
        return ((x * self.n - self.sums) / self.n) @ basis

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum of squares of n * x - S, exact; beyond 64 bits it is an error."""
        apart = x * self.n - self.sums
        if len(apart) and (apart.astype(float) ** 2).sum(axis=1).max() >= 0.999 * 2.0 ** 63:
            raise OverflowError("the deviation of a row does not fit a long")
        return (apart * apart).sum(axis=1)


def whole_rows(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """Rows with a usable vector as whole numbers ``x``, and their dimension.

    Null vectors and vectors with null, NaN or infinite entries are left out. If the lengths differ, those of
    the commonest length are used (of several, the longest); vectors without entries never are.
    """
    c = F.col(vector)
    usable = F.coalesce(F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    length = vectors.filter(usable).groupBy(F.size(c).alias("d")).count().filter("d > 0").orderBy(
        F.desc("count"), F.desc("d")).first()
    d = length["d"] if length else 0
    x = F.transform(c, lambda v: F.floor(v.cast("double") * SCALE) + F.lit(OFFSET).cast("long"))
    return vectors.filter(usable & (F.size(c) == d)).withColumn("x", x), d


def fit(rows: DataFrame, d: int) -> Whitening | None:
    """The components of all ``rows`` (column x, ``d`` whole numbers each); None without rows.

    A direction in which the rows do not vary (its variance is below 1e-12 of all) is no component.
    """
    if not d:
        return None
    total = _combined(_one_per_partition(rows, Spectrum, d, _enter_rows, d), Spectrum, d, "spectra")
    if total is None:
        return None
    basis, _ = np.linalg.qr(total.vectors)
    known = Whitening(total.n, total.sums, total.values, basis, 0.0)
    ritz = _combined(_one_per_partition(rows, Moments, d, lambda held, x: held.add(known.projected(x, basis)), d),
                     Moments, d, "products")
    values, turn = np.linalg.eigh(ritz.products / ritz.n)
    trace = float(np.trace(ritz.products)) / ritz.n
    keep = values[::-1] > 1e-12 * trace
    return Whitening(total.n, total.sums, values[::-1][keep], (basis @ turn)[:, ::-1][:, keep], trace)


def identity_error(rows: DataFrame, d: int, model: Whitening, k: int) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured over all rows."""
    seen = _combined(_one_per_partition(rows, Moments, k, lambda held, x: held.add(model.whitened(x, k)), d),
                     Moments, k, "whitened")
    return float(np.abs(seen.products / seen.n - np.eye(k)).max())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable row of ``vectors`` and component, up to ``components`` of them.

    Columns: the key, component (from 1), n, deviation, whitened, explained, identity_error. Which rows are
    usable is said at ``whole_rows``, what a component is at ``fit``; an empty table, a single row or rows that
    are all alike have no component, so the result is empty. Repeated rows count and return as often as they
    stand; a null key stays null. Other columns are not read. Equal eigenvalues leave their components
    undetermined up to a rotation.
    """
    whole, d = whole_rows(vectors.select(F.col(key).alias("id"), F.col(vector).alias("v")), "v")
    rows = whole.select("id", "x")
    model = fit(rows.select("x"), d)
    k = min(components, len(model.variances)) if model else 0
    kind = vectors.schema[key].dataType.simpleString()
    out = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        return vectors.sparkSession.createDataFrame([], out)
    error = identity_error(rows, d, model, k)
    schema = pa_schema(vectors.sparkSession, out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            m = len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)), pa.array(np.repeat(model.deviations(x), k)),
                pa.array(model.whitened(x, k).ravel()), pa.array(np.tile(model.variances[:k] / model.trace, m)),
                pa.array(np.full(m * k, error))], schema=schema)

    return rows.mapInArrow(run, out)


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
