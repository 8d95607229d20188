"""Embedding whitening by incremental eigendecomposition.

The covariance of the fitted vectors is never gathered from rows; its spectrum is kept up to date while rows pass by:

1. Every partition starts from an empty spectrum. Each row, centred by the mean of the rows before it, is a rank-one change
   of the scatter matrix. In the basis of the present eigenvectors the changed eigenvalues are the roots of a secular
   equation, one between any two neighbours of the old ones. Directions the change does not touch, and all but one of
   directions with equal eigenvalues, are deflated: they stay as they are.
2. Spectra of partitions are combined in groups of ``FAN``, round by round: the directions of one, scaled by the roots of their
   eigenvalues, and the difference of the means are successive rank-one changes of the other.
3. The combined eigenvectors span the space of a last, distributed Rayleigh-Ritz step: the covariance is projected on
   them, one small matrix per partition, and solved there, which mends what rounding of many changes has cost.

A partition's spectrum holds dimension + 1 vectors, whatever its rows; that is also all that is shuffled, and what the final
basis sent to the tasks holds. Every partial result is staged, so a lost executor costs its tasks only.

Vectors that are null or hold null or non-finite entries are dropped. Entries x = floor(1024 c) + 100000 are whole numbers, held within
2**40 on both sides, so that rows and sums are exact; vectors shorter than the longest one have zeros in place of the
missing entries. Rows that are repeated count as often as they stand there. Components whose eigenvalue is zero but for
rounding cannot be whitened and are left out, so equal vectors, a single one, or none give no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamsight.llm.common import fresh, with_results
from roamsight.sources.staging import stage, unstage

FAN = 16
COMPONENTS = 8
BATCH = 4096
OFFSET, STEPS = 100_000, 1024
LARGEST = 1 << 40
EPS = float(np.finfo(np.float64).eps)


def secular_roots(poles: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z[i]**2 / (poles[i] - x)) for rising poles, and the matrix poles[i] - root[j] to full accuracy.

    Each root is sought from its nearer pole. Either side's sum is replaced by a constant and one pole that agree in value and
    slope, and the next guess solves that; guesses outside the bracket give way to its middle.
    """
    k = len(poles)
    weight = z * z
    width = np.append(poles[1:] - poles[:-1], weight.sum())
    gaps = poles[:, None] - poles[None, :]
    middle = 1 + (weight[:, None] / (gaps - width / 2)).sum(0)
    left = middle >= 0  # the root lies in the left half of its interval
    left[-1] = True
    origin = np.arange(k) + ~left
    delta = poles[:, None] - poles[origin][None, :]
    low, high = np.where(left, 0.0, -width / 2), np.where(left, width / 2, 0.0)
    high[-1] = width[-1]
    if middle[-1] < 0:
        low[-1] = width[-1] / 2
    below = np.tri(k, dtype=bool).T  # pole i is at or left of root j
    near = delta[np.arange(k), np.arange(k)]
    far = np.append(delta[np.arange(1, k), np.arange(k - 1)], np.inf)
    x = (low + high) / 2
    for _ in range(80):
        distance = delta - x
        terms = weight[:, None] / distance
        slopes = terms / distance
        value = 1 + terms.sum(0)
        done = np.abs(value) <= 4 * EPS * k * (1 + np.abs(terms).sum(0))
        if done.all():
            break
        low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
        psi, psi_slope = np.where(below, terms, 0.0).sum(0), np.where(below, slopes, 0.0).sum(0)
        phi, phi_slope = terms.sum(0) - psi, slopes.sum(0) - psi_slope
        a, b = near - x, np.where(np.isinf(far), 1.0, far - x)
        s, t = psi_slope * a * a, np.where(np.isinf(far), 0.0, phi_slope * b * b)
        c = 1 + (psi - psi_slope * a) + np.where(np.isinf(far), phi, phi - phi_slope * b)
        # c + s / (a - y) + t / (b - y) = 0 for the step y
        p, q = c * (a + b) + s + t, c * a * b + s * b + t * a
        root = np.sqrt(np.maximum(p * p - 4 * c * q, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(p >= 0, 2 * q / (p + root), (p - root) / (2 * c))
            step = np.where(np.isinf(far), a + s / c, step)
        guess = x + step
        inside = (guess > low) & (guess < high) & np.isfinite(guess)
        x = np.where(done, x, np.where(inside, guess, (low + high) / 2))
    return poles[origin] + x, delta - x


def _deflated(values: np.ndarray, vectors: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Which entries of z still count. Of directions with nearly equal values one takes over the others' share by a rotation."""
    tolerance = 8 * EPS * max(np.abs(values).max(initial=0.0), z @ z)
    size = np.sqrt(z @ z)
    counts = np.abs(z) * size > tolerance
    at = np.flatnonzero(counts)
    if len(at) > 1:
        a, b = z[at[:-1]], z[at[1:]]
        close = np.abs((values[at[1:]] - values[at[:-1]]) * a * b) <= tolerance * (a * a + b * b)
        if close.any():
            last = at[0]
            for i in at[1:]:
                r = np.hypot(z[last], z[i])
                c, s = z[i] / r, z[last] / r
                if abs((values[i] - values[last]) * c * s) <= tolerance:
                    u, v = vectors[:, last].copy(), vectors[:, i].copy()
                    vectors[:, last], vectors[:, i] = c * u - s * v, s * u + c * v
                    values[last], values[i] = (
                        c * c * values[last] + s * s * values[i],
                        s * s * values[last] + c * c * values[i],
                    )
                    z[last], z[i], counts[last] = 0.0, r, False
                last = i
    return counts


def rank_one(values: np.ndarray, vectors: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising eigenvalues and eigenvectors of the matrix with these ones plus the product of ``change`` with itself.

    The entries of ``change`` that belong to the found roots exactly are computed back from them, so that the new eigenvectors
    are orthogonal however close the roots are.
    """
    z = vectors.T @ change
    if not z.any():
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    at = np.flatnonzero(_deflated(values, vectors, z))
    if not len(at):
        return values, vectors
    at = at[np.argsort(values[at], kind="stable")]
    poles = values[at]
    roots, apart = secular_roots(poles, z[at])
    k = len(at)
    gaps = poles[:, None] - poles[None, :]
    ratio = np.ones((k, k))
    lower = np.tri(k, k, -1, dtype=bool)  # j < i
    np.divide(apart, gaps, out=ratio, where=lower)
    if k > 1:
        shifted = np.ones((k, k))
        np.divide(apart[:, :-1], gaps[:, 1:], out=shifted[:, :-1], where=~lower[:, :-1])
        ratio *= np.where(lower, 1.0, shifted)
    exact = np.sqrt(np.abs(ratio.prod(1) * apart[:, -1])) * np.sign(z[at])
    turn = exact[:, None] / apart
    turn /= np.linalg.norm(turn, axis=0)
    vectors[:, at] = vectors[:, at] @ turn
    values[at] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number of rows, their mean, and the eigenvalues (rising) and eigenvectors of their scatter matrix."""

    size: int
    n: int = 0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def __post_init__(self) -> None:
        if not self.n:
            self.mean, self.values, self.vectors = np.zeros(self.size), np.zeros(self.size), np.eye(self.size)

    def add(self, row: np.ndarray) -> None:
        """The scatter grows by the row centred by the mean so far, n / (n + 1) times."""
        centred = row - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, centred * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + centred / self.n

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        apart = other.mean - self.mean
        changes = [v * np.sqrt(value) for value, v in zip(other.values, other.vectors.T, strict=True) if value > 0]
        for change in [*changes, apart * np.sqrt(self.n * other.n / (self.n + other.n))]:
            self.values, self.vectors = rank_one(self.values, self.vectors, change)
        self.mean = self.mean + apart * (other.n / (self.n + other.n))
        self.n += other.n

    def row(self) -> dict:
        return {"n": self.n, "mean": self.mean, "values": self.values, "vectors": self.vectors.ravel()}

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        size = len(row["mean"])
        numbers = [np.asarray(row[name], np.float64) for name in ("mean", "values", "vectors")]
        return cls(size, int(row["n"]), *numbers[:2], numbers[2].reshape(size, size))


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    """Rows of whole numbers; missing entries are those of c = 0."""
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (lengths == size).all():
        return flat.reshape(len(lists), size)
    out = np.full((len(lists), size), OFFSET, np.int64)
    out[np.arange(size) < lengths[:, None]] = flat
    return out


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n. The difference is taken between whole numbers, where these fit."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if n * most < 1 << 61:
        return (n * x - sums) / n
    return x - sums / n


def whole_numbers(vector: Column) -> Column:
    """x = floor(1024 c) + 100000 of every entry, or null if the vector is null or holds null or non-finite entries."""
    double = F.transform(vector, lambda c: c.cast("double"))
    odd = F.exists(double, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    limit = F.lit(float(LARGEST))
    x = F.transform(double, lambda c: F.floor(F.greatest(F.least(c * STEPS, limit), -limit)) + F.lit(OFFSET).cast("bigint"))
    return F.when(vector.isNotNull() & ~odd, x)


def _spectra(size: int, sums: np.ndarray, n: int) -> Callable:
    """Spectrum of a partition's rows. Rows come relative to the mean of all, which keeps numbers small and changes no scatter."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found = Spectrum(size)
        for batch in batches:
            for row in _centred(_matrix(batch["x"], size), n, sums):
                found.add(row)
        if found.n:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), **found.row()}], _ARROW)

    return emit


_SPECTRUM = "part bigint, n bigint, mean array<double>, values array<double>, vectors array<double>"
_ARROW = pa.schema(
    [("part", pa.int64()), ("n", pa.int64()), *((name, pa.list_(pa.float64())) for name in ("mean", "values", "vectors"))]
)


def _combine(part: pd.DataFrame) -> pd.DataFrame:
    rows = part.sort_values("part").to_dict("records")
    found = Spectrum.of(rows[0])
    for row in rows[1:]:
        found.merge(Spectrum.of(row))
    return pd.DataFrame([{"part": rows[0]["part"] // FAN, **found.row()}])


def spectrum(rows: DataFrame, size: int, n: int, sums: np.ndarray) -> Spectrum:
    """Combined spectrum of the staged column ``x``. FAN spectra at a time become one, in as many rounds as that takes."""
    parts = stage(rows.mapInArrow(_spectra(size, sums, n), _SPECTRUM), "spectra")
    while (left := parts.count()) > 1:
        numbered = parts.withColumn("group", F.col("part") - F.col("part") % FAN)
        merged = stage(numbered.groupBy("group").applyInPandas(lambda g: _combine(g.drop(columns="group")), _SPECTRUM), "spectra")
        unstage(parts)
        parts = merged
        if left <= FAN and parts.count() > 1:  # few, but with numbers far apart
            parts = parts.withColumn("part", F.lit(0).cast("bigint"))
    return Spectrum.of(parts.first().asDict())


def _products(size: int, sums: np.ndarray, n: int, basis: np.ndarray, scale: np.ndarray) -> Callable:
    """A partition's sum of products of the centred rows, projected on the basis and scaled."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((basis.shape[1], basis.shape[1]))
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH):
                part = _centred(_matrix(batch["x"].slice(low, BATCH), size), n, sums) @ basis / scale
                total += part.T @ part
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(total.size)), "value": pa.array(total.ravel())})

    return emit


def projected_covariance(rows: DataFrame, n: int, sums: np.ndarray, basis: np.ndarray, scale: np.ndarray | None = None) -> np.ndarray:
    """Covariance, divisor n, of the rows projected on the columns of the basis and divided by the scale.

    Entries are added up between partitions by Spark; the driver gets one matrix.
    """
    size, k = basis.shape
    made = _products(size, sums, n, basis, np.ones(k) if scale is None else scale)
    entries = rows.mapInArrow(made, "at bigint, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(k * k)
    out[entries["at"].to_numpy()] = entries["value"].to_numpy()
    return out.reshape(k, k) / n


@dataclass
class Whitening:
    """n rows with sums per dimension; eigenvectors as columns, falling eigenvalues, and their shares of the variance."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit on the column ``x`` of staged rows."""
    size = rows.agg(F.max(F.size("x"))).first()[0] or 0
    missing = F.lit(OFFSET).cast("bigint")
    sums = [F.sum(F.coalesce(F.get("x", F.lit(i)), missing)).alias(f"s{i}") for i in range(size)]
    n, *totals = rows.agg(F.count("*").alias("n"), *sums).first()
    none = Whitening(n, np.zeros(size), np.zeros((size, 0)), np.zeros(0), np.zeros(0), 0.0)
    if not n or not size:
        return none
    total = np.array(totals, np.int64)
    found = spectrum(rows, size, n, total)
    basis = np.linalg.qr(found.vectors)[0]
    small = projected_covariance(rows, n, total, basis)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    trace = np.trace(small)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    kept = min(components, int((values > size * EPS * max(values[0], 0.0)).sum()))
    if not kept:
        return none
    vectors, values = np.ascontiguousarray(vectors[:, :kept]), values[:kept].copy()
    covariance = projected_covariance(rows, n, total, vectors, np.sqrt(values))
    error = float(np.abs(covariance - np.eye(kept)).max())
    return Whitening(n, total, vectors, values, values / trace, error)


def whitened(x: Column, model: Whitening) -> Column:
    """The whitened components of each row."""
    size, (n, sums), scale = len(model.sums), (model.n, model.sums), np.sqrt(model.values)

    @F.arrow_udf("array<double>")
    def project(lists: pa.Array) -> pa.Array:
        out = _centred(_matrix(lists, size), n, sums) @ model.vectors / scale if len(lists) else np.zeros((0, len(scale)))
        ends = np.arange(len(lists) + 1, dtype=np.int32) * np.int32(len(scale))
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(out).ravel()))

    return project(x)


def deviation(x: Column, model: Whitening) -> Column:
    """Sum over dimensions of (n x - S)**2, exact; null where that is beyond 64 bits."""
    size, (n, sums) = len(model.sums), (model.n, model.sums)

    @F.arrow_udf("bigint")
    def squares(lists: pa.Array) -> pa.Array:
        found = _matrix(lists, size)
        most = max((abs(n * int(v) - int(s)) for v, s in ((found.max(initial=0), sums.min()), (found.min(initial=0), sums.max()))), default=0)
        if size * most * most < 1 << 62:
            apart = n * found - sums
            return pa.array((apart * apart).sum(1))
        exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums.tolist(), strict=True)) for row in found.tolist()]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())

    return squares(x)


def whiten(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening]:
    """Rows with a usable vector, with ``whitened`` (array<double>) and ``deviation``, and the fitted model."""
    x = fresh(df, "x_")
    rows = df.withColumn(x, whole_numbers(F.col(vector_col))).where(F.col(x).isNotNull())
    rows = stage(rows, "whole_numbers")
    model = fit(rows.select(F.col(x).alias("x")), components)
    if not len(model.values):
        model.sums = np.zeros(0, np.int64)
        empty = {"whitened": F.lit(None).cast("array<double>"), "deviation": F.lit(None).cast("bigint")}
        return with_results(rows, empty).drop(x), model
    done = with_results(rows, {"whitened": whitened(F.col(x), model), "deviation": deviation(F.col(x), model)})
    return done.drop(x), model
