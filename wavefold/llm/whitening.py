"""Embedding whitening: principal components by QDWH spectral divide and conquer.

The tasks add up whole numbers only: sums, then products of components around a whole centre, so the covariance is
exact before its last division and the same whatever the order of the tasks.  The covariance of d x d numbers
is split on the driver: the polar factor of ``V - shift`` (QR-based dynamically weighted Halley iteration) is the
matrix sign, its spectral projectors ``(I + U) / 2`` and ``(I - U) / 2`` give bases of the invariant subspaces above and below the
shift, and each is split again until it is a single component.  Components, a few vectors of length d, go to all tasks, which whiten the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavefold.llm.common import stage, table
from wavefold.llm.vectors import by_length, lengths, measured, whole
from wavefold.session import ship_package

SCALE = 256
COMPONENTS = 4
EPS = np.finfo(float).eps
EXACT = 2.0 ** 62
SEED = 7919


# ------------------------------------------------------ spectral divide and conquer

def polar(a: np.ndarray, steps: int = 40) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix: for a non-singular one its matrix sign.

    Dynamically weighted Halley iteration with a lower bound of the smallest singular value carried along; steps with large weights are
    done by QR of the stacked matrix, later ones by solving with ``I + c X'X``.
    """
    size = len(a)
    eye = np.eye(size)
    x = a / np.linalg.norm(a)
    low = EPS  # of the smallest singular value; a smaller one only costs steps
    for _ in range(steps):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square ** 2)
        wide = np.sqrt(1 + d)
        weight = wide + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * wide)))
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.concatenate([np.sqrt(c) * x, eye]))
            after = b / c * x + (weight - b / c) / np.sqrt(c) * q[:size] @ q[size:].T
        else:
            after = b / c * x + (weight - b / c) * np.linalg.solve(eye + c * x.T @ x, x.T).T
        after = (after + after.T) / 2
        low = min(1.0, low * (weight + b * square) / (1 + c * square))
        moved = np.linalg.norm(after - x)
        x = after
        if low > 1 - 10 * EPS and moved <= 10 * EPS * size:
            break
    return x


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Values between the smallest and the largest eigenvalue: between diagonal entries, those in the middle first, then their mean."""
    diagonal = np.sort(np.diag(a))
    gaps = np.arange(len(diagonal) - 1)
    for k in gaps[np.argsort(np.abs(gaps - (len(gaps) - 1) / 2), kind="stable")]:
        yield (diagonal[k] + diagonal[k + 1]) / 2
    yield float(diagonal.mean())


def _halves(a: np.ndarray, level: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None if ``a`` is a multiple of the identity."""
    size, rnd = len(a), np.random.default_rng(SEED)
    eye = np.eye(size)
    for shift in _shifts(a):
        off = a - shift * eye
        if np.linalg.norm(off) <= level:
            return None
        sign = polar(off)
        if np.linalg.norm(sign @ sign - eye) > 1e-10 * size:
            continue  # the shift is an eigenvalue: try another
        above = round((size + np.trace(sign)) / 2)
        if not 0 < above < size:
            continue
        parts = []
        for projector, rank in (((eye + sign) / 2, above), ((eye - sign) / 2, size - above)):
            basis, _ = np.linalg.qr(projector @ rnd.normal(size=(size, rank)))
            parts.append(np.linalg.qr(projector @ basis)[0])
        return parts[0], parts[1]
    return None




def spectral_components(a: np.ndarray, count: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix (all, if None) and unit eigenvectors as columns.

    Subspaces that can't hold any of them are not split further.  A subspace on which the matrix is a multiple of the identity has
    the basis found.
    """
    size = len(a)
    count = size if count is None else min(count, size)
    level = 4 * EPS * np.linalg.norm(a)
    values, vectors = [], []
    open_ = [np.eye(size)]  # the subspace with the largest values last
    while open_ and len(values) < count:
        basis = open_.pop()
        block = basis.T @ a @ basis
        block = (block + block.T) / 2
        halves = _halves(block, level) if len(block) > 1 else None
        if halves is None:
            values += np.diag(block).tolist()
            vectors += list(basis.T)
        else:
            open_ += [basis @ halves[1], basis @ halves[0]]
    order = np.argsort(-np.array(values), kind="stable")[:count]
    found = np.array(vectors).reshape(-1, size)[order].T
    found = found / np.linalg.norm(found, axis=0) if found.size else found
    return np.array(values)[order], found


# ------------------------------------------------------------------ whole-number sums

class Moments:
    """Count, sums and exact covariance of the distinct integer vectors of one length."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.centre = np.array([round(s / n) for s in sums], np.int64).reshape(len(sums))
        self.covariance = np.zeros((len(sums), len(sums)))

    def close(self, products: dict[tuple[int, int], int]) -> None:
        """``products`` of components less ``centre``; what the centre is off by is taken out exactly."""
        rest = [s - self.n * int(c) for s, c in zip(self.sums, self.centre, strict=True)]
        for (i, j), total in products.items():
            self.covariance[i, j] = self.covariance[j, i] = (self.n * total - rest[i] * rest[j]) / self.n ** 2

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: whole 64-bit numbers, Python integers beyond."""
        top = max([abs(s) for s in self.sums], default=0) + self.n * int(np.abs(x).max(initial=0))
        kind = np.int64 if len(self.sums) * float(top) ** 2 < EXACT else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)


def _moments(fit: DataFrame, dims: list[int], scale: int) -> dict[int, Moments]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {}
        for dim, batch in by_length(batches):
            x = batch.column("x").flatten().to_numpy().reshape(-1, dim)
            n, sums = totals.get(dim, (0, np.zeros(dim, np.int64)))
            totals[dim] = n + len(x), sums + x.sum(0)
        for dim, (n, sums) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dim + 1, dim), pa.int32()), pa.array(np.arange(-1, dim)), pa.array(np.append(n, sums))],
                names=["dim", "i", "total"])

    wide = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found = fit.mapInArrow(add, "dim int, i bigint, total bigint").groupBy("dim", "i").agg(wide).collect()
    values = {(r["dim"], r["i"]): int(r["total"]) for r in found}
    moments = {dim: Moments(values[dim, -1], [values[dim, i] for i in range(dim)]) for dim in dims}
    centres = {dim: m.centre for dim, m in moments.items()}

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, room = {}, {}
        for dim, batch in by_length(batches):
            y = batch.column("x").flatten().to_numpy().reshape(-1, dim) - centres[dim]
            most = float(np.abs(y).max(initial=0)) ** 2 * len(y)
            room[dim] = room.get(dim, 0.0) + most
            if room[dim] >= EXACT:  # beyond 64 bits: Python's whole numbers
                product = y.astype(object).T @ y.astype(object)
            else:
                # Below 2^53 every partial sum of the floating-point product is whole and exact.
                product = (y.T.astype(float) @ y.astype(float)).astype(np.int64) if most < 2.0 ** 53 else y.T @ y
            totals[dim] = totals.get(dim, 0) + product
        for dim, product in totals.items():
            i, j = np.triu_indices(dim)
            for at in range(0, len(i), 1 << 16):
                a, b = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
                total = pa.array(product[a, b].tolist(), pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), dim), pa.int32()), pa.array(a), pa.array(b), total], names=["dim", "i", "j", "total"])

    found = (fit.mapInArrow(multiply, "dim int, i bigint, j bigint, total decimal(38,0)").groupBy("dim", "i", "j").agg(wide).toArrow())
    products = {dim: {} for dim in dims}
    for dim, i, j, total in zip(*(found.column(c).to_pylist() for c in ("dim", "i", "j", "total")), strict=True):
        products[dim][i, j] = int(total)
    for dim in dims:
        moments[dim].close(products[dim])
    return moments


# ------------------------------------------------------------------ whitening

class Whitener:
    """Components of one vector length, scaled to unit variance."""

    def __init__(self, moments: Moments, count: int):
        self.moments = moments
        cov = moments.covariance
        self.values, self.components = spectral_components(cov, count)
        self.trace = float(np.trace(cov))
        # A component without variance (up to rounding) can't be whitened: its values are null.
        self.real = self.values > len(cov) * EPS * self.trace if len(cov) else np.zeros(0, bool)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.map = self.components / np.sqrt(np.where(self.real, self.values, np.nan))
            self.explained = np.where(self.trace > 0, self.values / self.trace, np.nan)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        off = (self.moments.deviations(x) / self.moments.n).astype(float)
        return off @ self.map


def _identity_errors(fit: DataFrame, whiteners: dict[int, Whitener]) -> dict[int, float]:
    """Largest absolute entry of the covariance of what is whitened, less the identity, measured over the fit list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {}
        for dim, batch in by_length(batches):
            w = whiteners[dim](batch.column("x").flatten().to_numpy().reshape(-1, dim))[:, whiteners[dim].real]
            totals[dim] = totals.get(dim, 0) + w.T @ w
        for dim, product in totals.items():
            i, j = np.indices(product.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(product.size, dim), pa.int32()), pa.array(i.ravel()), pa.array(j.ravel()), pa.array(product.ravel())],
                names=["dim", "i", "j", "total"])

    found = (fit.mapInArrow(run, "dim int, i bigint, j bigint, total double")
             .groupBy("dim", "i", "j").agg(F.sum("total").alias("total")).collect())
    errors = {}
    for row in found:
        off = abs(row["total"] / whiteners[row["dim"]].moments.n - (row["i"] == row["j"]))
        errors[row["dim"]] = max(errors.get(row["dim"], 0.0), off)
    return errors


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Whitened coordinates of every row of ``vectors(vec_id, embedding)`` with a finite vector, one row a component.

    ``vec_id, component, n, deviation, whitened, explained, identity_error``; a component x counts as ``floor(scale * x)``.  Mean and
    covariance are those of the distinct vectors (the fit list, of ``n``), so copies weigh nothing, but every row has its result, repeated
    rows and rows without an id too.  ``deviation`` is exact and null where 64 bits can't hold it.  A component without variance has a null in ``whitened``
    (all are where the fit list is one vector, ``explained`` is null then too).  Vectors of each length have a fit of their own and at most as many
    components as entries (empty ones have no rows).  Null vectors and those with null or non-finite entries are dropped; an empty table gives
    no rows.  Other columns are not read.  The driver and every worker hold a few d x d numbers for each length d.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = stage(measured(vectors, "vec_id").filter("dim > 0"), "whitening-rows")
    numbers = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    fit = stage(rows.select("dim", numbers.alias("x")).distinct(), "whitening-fit")
    dims = lengths(fit)
    whiteners = {dim: Whitener(m, components) for dim, m in _moments(fit, dims, scale).items()}
    errors = _identity_errors(fit, whiteners)
    most = np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, batch in by_length(batches):
            whitener = whiteners[dim]
            x = whole(batch.column("embedding"), dim, scale)
            off = whitener.moments.deviations(x)
            far = [v if v <= most else None for v in (off * off).sum(1).tolist()]
            count, size = len(whitener.values), len(x)
            each = np.repeat(np.arange(size), count)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1), size), pa.int32()),
                 pa.array(np.full(len(each), whitener.moments.n)), pa.array(far, pa.int64()).take(pa.array(each)),
                 pa.array(whitener(x).ravel(), from_pandas=True), pa.array(np.tile(whitener.explained, size), from_pandas=True),
                 pa.array([errors.get(dim)] * len(each), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = dict(rows.dtypes)["vec_id"]
    return rows.mapInArrow(run, f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of the whole ``embeddings`` table."""
    return whiten(table(spark, sf_dir, "embeddings"))
