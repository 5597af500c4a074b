"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance V of n vectors is never formed. What the method needs of it are products VQ
with a few columns Q, and each is one pass over the centred vectors: every task adds up its
own XᵀXQ, and the sums of all tasks are added per dimension. Between the passes the driver
holds matrices of dimension by columns.

A round applies a Chebyshev polynomial of V to Q, by its three-term recurrence, one pass per
degree. The polynomial stays within ±1 on the unwanted spectrum, from a lower bound that a
few Lanczos steps give up to the least Ritz value of the block, and grows fast above it. Then
come QR and Rayleigh-Ritz. The block has more columns than are wanted; they keep the wanted
ones apart from the rest of the spectrum. The rounds end when the residuals |Vq - eq| certify
each wanted pair: an eigenvalue lies that near e. They are driven down to rounding error.

Entries are taken as whole numbers, floor(scale * c) + offset, so that sums and deviations
are exact. Each distinct vector counts once in the fit.

Defined results: a row whose vector is NULL or holds a NULL, NaN or infinite entry is left
out, as is one whose length is not the most frequent one (the longer of two). Repeated rows
are whitened one by one and counted once in the fit. A NULL id stays NULL. Entries beyond
2^40 / scale count as that. Components whose eigenvalue is rounding error have no whitened
values and are not returned, so a single vector gives no rows, nor does an empty table. A
deviation beyond 64 bits is NULL. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stored

_LARGEST = 1 << 40
#: Entries that a task turns into doubles at a time.
_CHUNK = 1 << 20


@dataclass(frozen=True)
class Settings:
    """What to find, and how. `seed` draws the first block."""

    components: int = 16
    scale: int = 64
    offset: int = 1_000_000
    guard: int = 16
    degree: int = 14
    lanczos_steps: int = 8
    tolerance: float = 1e-13
    rounds: int = 200
    seed: int = 11


@dataclass(frozen=True)
class Whitening:
    """Eigenvectors (columns) and eigenvalues of the fit, largest first.

    `sums` are exact and, like `mean`, those of the vectors less `settings.offset`.
    `residual` is the largest |Vq - eq| of the components, `identity_error` the largest entry
    of the whitened fit's covariance less the identity.
    """

    settings: Settings
    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.n


def _whole(entry: Column, settings: Settings) -> Column:
    scaled = entry.cast("double") * float(settings.scale)
    limited = F.least(F.greatest(scaled, F.lit(float(-_LARGEST))), F.lit(float(_LARGEST)))
    return F.floor(limited)


def whole_vectors(rows: DataFrame, settings: Settings, vector: str = "embedding") -> DataFrame:
    """Usable rows with their vector as whole numbers less the offset, `x`."""
    entries = F.col(vector)
    usable = F.forall(entries, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    found = rows.where(entries.isNotNull() & usable & (F.size(entries) > 0))
    return found.withColumn("x", F.transform(entries, lambda c: _whole(c, settings)))


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    """The vectors of a task as matrices of bounded size."""
    rows = max(1, _CHUNK // dims)
    for batch in batches:
        entries = batch.column("x").flatten().to_numpy().reshape(-1, dims)
        for at in range(0, len(entries), rows):
            yield entries[at : at + rows]


def _added_up(
    fit: DataFrame, dims: int, width: int, add: object, dtype: str = "double"
) -> np.ndarray:
    """The sum over all vectors of `add(matrix)`, whose results have `width` columns.

    A task sends one row per row of its sum. These are added by row, so the driver gets one
    sum however many tasks there are.
    """
    kind = pa.float64() if dtype == "double" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for matrix in _matrices(batches, dims):
            part = add(matrix)
            total = part if total is None else total + part
        if total is not None:
            columns = [pa.array(np.arange(len(total), dtype=np.int32))]
            columns += [pa.array(total[:, i], kind) for i in range(width)]
            names = ["at", *(f"c{i}" for i in range(width))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [f"c{i}" for i in range(width)]
    parts = fit.mapInArrow(run, ", ".join(["at int", *(f"{name} {dtype}" for name in names)]))
    summed = parts.groupBy("at").agg(*[F.sum(name).alias(name) for name in names])
    found = summed.coalesce(4).toArrow().sort_by("at")
    return np.column_stack([found.column(name).to_numpy() for name in names])


class _Covariance:
    """Products with the covariance of the fit, each a pass over it."""

    def __init__(self, fit: DataFrame, n: int, mean: np.ndarray):
        self.fit, self.n, self.mean = fit, n, mean

    def __matmul__(self, q: np.ndarray) -> np.ndarray:
        return self.with_squares(q)[0]

    def with_squares(self, q: np.ndarray) -> tuple[np.ndarray, float]:
        """VQ, and the trace of V."""
        mean, width = self.mean, q.shape[1]

        def add(matrix: np.ndarray) -> np.ndarray:
            centred = matrix - mean
            return np.column_stack([centred.T @ (centred @ q), (centred**2).sum(axis=0)])

        found = _added_up(self.fit, len(mean), width + 1, add) / self.n
        return found[:, :width], float(found[:, width].sum())

    def identity_error(self, vectors: np.ndarray, values: np.ndarray) -> float:
        """How far the covariance of the whitened fit is from the identity."""
        mean, whiten = self.mean, vectors / np.sqrt(values)

        def add(matrix: np.ndarray) -> np.ndarray:
            white = (matrix - mean) @ whiten
            return np.vstack([white.T @ white, white.sum(axis=0)])

        found = _added_up(self.fit, len(mean), len(values), add) / self.n
        centre = found[-1]
        error = found[:-1] - np.outer(centre, centre) - np.eye(len(values))
        return float(np.abs(error).max())


def _lower_bound(covariance: _Covariance, dims: int, steps: int, rng: np.random.Generator) -> float:
    """A bound below the spectrum, from the Lanczos process with full orthogonalisation.

    The least Ritz value less the last residual, which is below the least eigenvalue unless
    the random start has almost no share in its direction. If it is not, that end of the
    spectrum is damped less, which costs rounds but no accuracy.
    """
    q = rng.standard_normal((dims, 1))
    basis = q / np.linalg.norm(q)
    diagonal, beside = [], []
    for _ in range(min(steps, dims)):
        v = covariance @ basis[:, -1:]
        diagonal.append(float(basis[:, -1] @ v[:, 0]))
        for _ in range(2):
            v -= basis @ (basis.T @ v)
        beside.append(float(np.linalg.norm(v)))
        if beside[-1] <= 1e-12 * max(diagonal):
            break
        basis = np.column_stack([basis, v / beside[-1]])
    off = np.diag(beside[:-1], 1)
    least = np.linalg.eigvalsh(np.diag(diagonal) + off + off.T)[0]
    return max(0.0, float(least) - beside[-1])


def _growth(value: float, low: float, high: float) -> float:
    """How fast the polynomial grows with its degree at a value above [low, high]."""
    return float(np.arccosh(max(1.0, (2 * value - low - high) / (high - low))))


def _filtered(
    covariance: _Covariance, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float,
    degree: int,
) -> np.ndarray:
    """The Chebyshev polynomial of [low, high] in V applied to Q, scaled to 1 at `top`.

    `vq` is VQ, which the last Rayleigh-Ritz step has found, so the first degree is free.
    """
    middle, half = (high + low) / 2, (high - low) / 2
    first = ratio = half / (top - middle)
    before, now = q, (vq - middle * q) * (ratio / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - ratio)
        product = (covariance @ now) - middle * now
        before, now = now, product * (2 * following / half) - ratio * following * before
        ratio = following
    return now


def _top_pairs(
    covariance: _Covariance, dims: int, settings: Settings
) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Certified eigenvectors and eigenvalues, the trace, and the largest residual."""
    wanted = min(settings.components, dims)
    width = min(wanted + settings.guard, dims)
    rng = np.random.default_rng(settings.seed)
    low = 0.0
    if width < dims:
        low = _lower_bound(covariance, dims, settings.lanczos_steps, rng)
        q = np.linalg.qr(rng.standard_normal((dims, width)))[0]
    else:
        q = np.eye(dims)
    best = np.inf
    for _ in range(settings.rounds):
        vq, trace = covariance.with_squares(q)
        projected = q.T @ vq
        values, turn = np.linalg.eigh((projected + projected.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        residuals = np.linalg.norm(vq - q * values, axis=0)[:wanted]
        worst = float(residuals.max()) / max(float(values[0]), np.finfo(float).tiny)
        settled = worst <= settings.tolerance or (worst <= 1e-10 and worst > best / 2)
        if settled or width == dims:
            return q[:, :wanted], values[:wanted], trace, float(residuals.max())
        best = min(best, worst)
        high = max(float(values[-1]), low + 1e-9 * float(values[0]))
        # Columns that grow too far apart would lose the smaller ones in rounding.
        apart = _growth(float(values[0]), low, high) - _growth(float(values[wanted - 1]), low, high)
        degree = int(min(settings.degree, max(2.0, np.log(1e10) / max(apart, 1e-9))))
        q = _filtered(covariance, q, vq, low, high, float(values[0]), degree)
        q = np.linalg.qr(q)[0]
    raise RuntimeError(f"eigenvectors not certified after {settings.rounds} rounds: {worst:.1e}")


def fit_whitening(
    rows: DataFrame, settings: Settings | None = None, vector: str = "embedding"
) -> Whitening | None:
    """The whitening of all distinct usable vectors, or None if there is none to find."""
    settings = settings or Settings()
    vectors = whole_vectors(rows, settings, vector).select("x")
    lengths = vectors.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("dims")).first()
    if most is None:
        return None
    dims = most.dims
    fit = stored(vectors.where(F.size("x") == dims).dropDuplicates(), "whitening_fit", "zstd")

    def add(matrix: np.ndarray) -> np.ndarray:
        sums = np.append(matrix.sum(axis=0), len(matrix))
        return sums.reshape(-1, 1)

    *sums, n = _added_up(fit, dims, 1, add, "long")[:, 0].tolist()
    sums = np.array(sums, np.int64)
    covariance = _Covariance(fit, n, sums / n)
    q, values, trace, residual = _top_pairs(covariance, dims, settings)
    kept = values > 4 * dims * np.finfo(float).eps * max(float(values[0]), 0.0)
    if not kept.any():
        return None
    q, values = q[:, kept], values[kept]
    error = covariance.identity_error(q, values)
    return Whitening(settings, n, sums, q, values, trace, residual, error)


_DDL = "vec_id long, component int, n long, deviation long, whitened double"


def _deviations(entries: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum of (n * x - S)^2 of each row, NULL where 64 bits cannot hold it."""
    rough = ((n * entries.astype(float) - sums) ** 2).sum(axis=1)
    exact = ((n * entries - sums) ** 2).sum(axis=1)
    return [e if r < 9e18 else None for e, r in zip(exact.tolist(), rough.tolist(), strict=True)]


def whitened(
    rows: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """For each usable row and component, the row's whitened value and the fit's figures."""
    dims, width = model.vectors.shape
    mean, whiten = model.mean, model.vectors / np.sqrt(model.values)
    n, sums = model.n, model.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        component = np.arange(1, width + 1, dtype=np.int32)
        for batch in batches:
            entries = batch.column("x").flatten().to_numpy().reshape(-1, dims)
            ids = batch.column("vec_id")
            step = max(1, _CHUNK // max(dims, width))
            for at in range(0, len(entries), step):
                part = entries[at : at + step]
                each = np.repeat(np.arange(len(part)), width)
                deviation = pa.array(_deviations(part, n, sums), pa.int64())
                columns = [
                    ids.slice(at, len(part)).take(each),
                    np.tile(component, len(part)),
                    np.full(len(each), n),
                    deviation.take(each),
                    ((part - mean) @ whiten).ravel(),
                ]
                names = [field.split()[0] for field in _DDL.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    found = whole_vectors(rows, model.settings, vector).where(F.size("x") == dims)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return (
        found.select(F.col(vec_id).cast("long").alias("vec_id"), "x")
        .mapInArrow(run, _DDL)
        .withColumn("explained", F.get(shares, F.col("component") - 1))
        .withColumn("identity_error", F.lit(model.identity_error))
    )


def whiten(
    rows: DataFrame,
    settings: Settings | None = None,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """All usable rows, whitened by the components of their own distinct vectors."""
    model = fit_whitening(rows, settings, vector)
    if model is None:
        nothing = rows.sparkSession.createDataFrame([], _DDL)
        none = F.lit(None).cast("double")
        return nothing.withColumn("explained", none).withColumn("identity_error", none)
    return whitened(rows, model, vec_id, vector)
