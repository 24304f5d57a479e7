"""Whitening of embeddings along the leading eigenvectors of their covariance.

The eigenvectors come from a block Jacobi-Davidson iteration that never forms the
covariance: it is only met as a product with a few vectors, summed over centred rows by
tasks.  Every round takes the Rayleigh-Ritz pairs of a small subspace, locks the leading
ones whose residuals have reached double precision, and widens the subspace by corrections
of the others, which inner MINRES steps solve in the complement of what is locked or in work.
All columns take their steps together, so a step is one pass over the vectors.

The driver holds matrices of one row per dimension and a few columns per component.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, in_arrow, kept_table, pieces, read, to_batch

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
REACH = 1 << 40      # scaled entries stop here; exact in doubles, and far beyond any embedding
FAN = 64             # partial sums that the driver adds up itself
EPS = float(np.finfo(float).eps)

Product = Callable[[np.ndarray], np.ndarray]


# --- vectors as whole numbers --------------------------------------------------

def integer_vectors(rows: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, dim, x``: floor(scale * c) + shift of every entry, as bytes of longs.

    Vectors that are NULL or hold NULL or non-finite entries are left out.
    """
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("x", pa.binary())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            ids, dims, out = [], [], []
            column = batch.column(1)
            lengths = np.asarray(column.value_lengths().fill_null(0))
            ends = np.cumsum(lengths)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)  # NULL entries become NaN
            odd = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.floor(scale * flat)
            whole[~np.isfinite(flat)] = 0
            x = np.clip(whole, -REACH, REACH).astype(np.int64) + shift
            present = np.asarray(column.is_valid())
            for i, name in enumerate(batch.column(0).to_pylist()):
                start, end = ends[i] - lengths[i], ends[i]
                if present[i] and odd[end] == odd[start]:
                    ids.append(name)
                    dims.append(int(lengths[i]))
                    out.append(x[start:end].tobytes())
            yield to_batch(schema, ids, dims, out)

    plain = rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                        F.col("embedding").cast("array<double>").alias("embedding"))
    return in_arrow(plain, task, "vec_id long, dim int, x binary")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of longs; shorter vectors end with entries of 0."""
    cells = column.to_pylist()
    if all(len(c) == 8 * dim for c in cells):
        return np.frombuffer(b"".join(cells), np.int64).reshape(-1, dim)
    out = np.full((len(cells), dim), SHIFT, np.int64)
    for i, cell in enumerate(cells):
        out[i, :len(cell) // 8] = np.frombuffer(cell, np.int64)
    return out


@dataclass(frozen=True)
class Centre:
    """The mean S/n of n vectors, as whole parts and remainders over n: what is centred is rounded once."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    @property
    def dim(self) -> int:
        return len(self.whole)

    def centred(self, column: pa.Array) -> np.ndarray:
        return (_matrix(column, self.dim) - self.whole) - self.rest / self.n

    def deviations(self, column: pa.Array) -> list[int | None]:
        """The exact sum of (n*x - S)^2 of each row; NULL beyond the range of longs."""
        u = _matrix(column, self.dim) - self.whole
        most = int(np.abs(u).max(initial=0)) + 1
        rest = self.rest
        if most * max(most, self.n) * self.dim >= 1 << 62:
            u, rest = u.astype(object), rest.astype(object)
        squares, shared = (u * u).sum(1), (u * rest).sum(1)
        last = sum(int(r) ** 2 for r in self.rest)
        exact = (self.n ** 2 * int(a) - 2 * self.n * int(b) + last for a, b in zip(squares, shared))
        return [d if d < 1 << 63 else None for d in exact]


def centre(vectors: DataFrame) -> Centre | None:
    """The exact mean of ``vectors``; None if there are none, or none has entries."""
    dim = vectors.agg(F.max("dim")).first()[0]
    if not dim:
        return None
    schema = pa.schema([("i", pa.int32()), ("s", pa.decimal128(38, 0))])

    def task(batches: Batches) -> Batches:
        n, total = 0, [0] * dim
        for batch in batches:
            n += batch.num_rows
            total = [a + int(b) for a, b in zip(total, _matrix(batch.column(0), dim).sum(0))]
        yield to_batch(schema, list(range(-1, dim)), [Decimal(v) for v in (n, *total)])

    sums = dict(in_arrow(vectors.select("x"), task, "i int, s decimal(38,0)").groupBy("i").agg(
        F.sum("s").cast("decimal(38,0)")).collect())
    n = int(sums[-1])
    both = [divmod(int(sums[i]), n) for i in range(dim)]
    return Centre(n, np.array([q for q, _ in both], np.int64), np.array([r for _, r in both], np.int64))


# --- sums over all rows ---------------------------------------------------------

class Passes:
    """Sums of arrays over all rows of a table with a column ``x``."""

    def __init__(self, vectors: DataFrame):
        self.x = vectors.select("x")
        self.many = self.x.rdd.getNumPartitions() > FAN

    def sum(self, shape: tuple[int, ...], part: Callable[[pa.Array], np.ndarray]) -> np.ndarray:
        """The sum of ``part`` over all batches, in a fixed order.

        Each task sends one array.  Of many tasks the arrays are first added by other tasks, so
        the driver never gets more than ``FAN`` of them.
        """
        schema, ddl = pa.schema([("task", pa.int32()), ("total", pa.binary())]), "task int, total binary"

        def task(batches: Batches) -> Batches:
            total = np.zeros(shape)
            for batch in pieces(batches, 4096):
                if batch.num_rows:
                    total += part(batch.column(0))
            yield to_batch(schema, [TaskContext.get().partitionId()], [total.tobytes()])

        def add(batches: Batches) -> Batches:
            total, first = np.zeros(shape), None
            for batch in batches:
                for name, cell in zip(*(c.to_pylist() for c in batch.columns)):
                    first = name if first is None else first
                    total += np.frombuffer(cell).reshape(shape)
            if first is not None:
                yield to_batch(schema, [first], [total.tobytes()])

        sums = in_arrow(self.x, task, ddl)
        if self.many:
            sums = in_arrow(sums.repartition(FAN, "task").sortWithinPartitions("task"), add, ddl)
        total = np.zeros(shape)
        for _, cell in sorted(sums.collect()):
            total += np.frombuffer(cell).reshape(shape)
        return total


def covariance_product(passes: Passes, mean: Centre) -> Product:
    """W -> V W for the covariance V (divisor n) of the rows: one pass, V itself is never formed."""
    def product(w: np.ndarray) -> np.ndarray:
        def part(column: pa.Array) -> np.ndarray:
            rows = mean.centred(column)
            return rows.T @ (rows @ w)
        return passes.sum(w.shape, part) / mean.n
    return product


# --- eigenvectors -----------------------------------------------------------------

def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to ``bases``."""
    new = new / np.maximum(np.linalg.norm(new, axis=0), 1e-300)
    for _ in range(2):
        for basis in bases:
            new = new - basis @ (basis.T @ new)
    u, s, _ = np.linalg.svd(new, full_matrices=False)
    u = u[:, s > 1e-10]
    for basis in bases:
        u = u - basis @ (basis.T @ u)
    return np.linalg.qr(u)[0] if u.shape[1] else u


def minres(apply: Product, right: np.ndarray, steps: int, enough: float = 1e-2) -> np.ndarray:
    """Solve ``apply(x) = right`` for every column at once, symmetric systems, few steps.

    Stops early when every residual has come down to ``enough`` of its start.
    """
    norm = np.linalg.norm(right, axis=0)
    x, w, w_old, v_old = (np.zeros_like(right) for _ in range(4))
    v = right / np.where(norm > 0, norm, 1)
    beta, eta = norm.copy(), norm.copy()
    cos, cos_old, sin, sin_old = np.ones_like(norm), np.ones_like(norm), np.zeros_like(norm), np.zeros_like(norm)
    for _ in range(steps):
        image = apply(v)
        alpha = (v * image).sum(0)
        nxt = image - alpha * v - beta * v_old
        beta_new = np.linalg.norm(nxt, axis=0)
        delta = cos * alpha - cos_old * sin * beta
        rho1 = np.hypot(delta, beta_new)
        rho2, rho3 = sin * alpha + cos_old * cos * beta, sin_old * beta
        live = rho1 > 0
        safe = np.where(live, rho1, 1)
        cos_old, sin_old = cos, sin
        cos, sin = np.where(live, delta / safe, 1), np.where(live, beta_new / safe, 0)
        w_old, w = w, np.where(live, (v - rho3 * w_old - rho2 * w) / safe, 0)
        x = x + cos * eta * w
        eta = -sin * eta
        if (np.abs(eta) <= enough * norm).all():
            break
        v_old, v = v, nxt / np.where(beta_new > 0, beta_new, 1)
        beta = beta_new
    return x


def jacobi_davidson(product: Product, dim: int, wanted: int, steps: int = 8, rounds: int = 60,
                    seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of a symmetric product.

    A pair is done when its residual is ``16 * sqrt(dim)`` roundings of the largest eigenvalue.
    Raises if ``rounds`` do not get there.
    """
    wanted = min(wanted, dim)
    room = min(dim, 4 * wanted + 8)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, min(dim, wanted + 8))))[0]
    image = product(basis)
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    for _ in range(rounds):
        # Rayleigh-Ritz in the subspace, which is kept orthogonal to what is locked.
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        residual = image - basis * theta
        tolerance = 16 * EPS * np.sqrt(dim) * max(theta[0], values.max(initial=0))
        ready = np.linalg.norm(residual, axis=0) <= tolerance
        leading = int(np.argmin(ready)) if not ready.all() else len(ready)
        leading = min(leading, wanted - len(values))
        locked, values = np.column_stack([locked, basis[:, :leading]]), np.append(values, theta[:leading])
        basis, image, theta, residual = (m[..., leading:] for m in (basis, image, theta, residual))
        left = wanted - len(values)
        if not left:
            break
        if basis.shape[1] + left > room - len(values):
            keep = min(basis.shape[1], left + 8)
            basis, image = basis[:, :keep], image[:, :keep]
        near, shifts = np.column_stack([locked, basis[:, :left]]), theta[:left]

        def projected(block: np.ndarray) -> np.ndarray:
            return block - near @ (near.T @ block)

        def corrected(block: np.ndarray) -> np.ndarray:
            block = projected(block)
            return projected(product(block) - shifts * block)

        wider = minres(corrected, -projected(residual[:, :left]), steps)
        new = _orthonormal(projected(wider), locked, basis)
        if not new.shape[1]:  # nothing to add: what is left is rounding of the products
            new = _orthonormal(np.random.default_rng(seed + len(values)).standard_normal((dim, left)), locked, basis)
        if new.shape[1]:
            basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
        else:  # the subspace is the whole space: take the products afresh
            image = product(basis)
    else:
        raise RuntimeError(f"{wanted - len(values)} of {wanted} eigenvectors did not settle in {rounds} rounds")
    # One last Rayleigh-Ritz over all locked vectors evens out what locking one by one left.
    locked = np.linalg.qr(locked)[0]
    small = locked.T @ product(locked)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], locked @ turn[:, ::-1]


# --- the operator -----------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """``axes`` are unit eigenvectors as columns, ``values`` their eigenvalues, ``trace`` the whole variance."""

    mean: Centre
    values: np.ndarray
    axes: np.ndarray
    trace: float

    def whitened(self, column: pa.Array) -> np.ndarray:
        return (self.mean.centred(column) @ self.axes) / np.sqrt(self.values)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of :func:`integer_vectors`; None if they do not differ at all.

    Components without variance (an eigenvalue within rounding of 0) are left out.
    """
    mean = centre(vectors)
    if mean is None:
        return None
    passes = Passes(vectors)
    trace = float(passes.sum((mean.dim,), lambda c: (mean.centred(c) ** 2).sum(0)).sum() / mean.n)
    if trace == 0:
        return None
    values, axes = jacobi_davidson(covariance_product(passes, mean), mean.dim, components)
    some = values > 1e-12 * values[0]
    axes = axes[:, some]
    # The largest entry of each axis is positive, so that fits can be compared.
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    return Whitening(mean, values[some], axes, trace)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """How far the covariance of the whitened rows is off the identity, at most."""
    k, n, passes = len(model.values), model.mean.n, Passes(vectors)
    middle = passes.sum((k,), lambda c: model.whitened(c).sum(0)) / n

    def part(column: pa.Array) -> np.ndarray:
        rows = model.whitened(column) - middle
        return rows.T @ rows
    return float(np.abs(passes.sum((k, k), part) / n - np.eye(k)).max())


_ROWS = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                   ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: its whitened coordinate, and what the fit is worth.

    Components without variance (an eigenvalue within rounding of 0) are left out.

    Vectors that are NULL or hold NULL or non-finite entries give no rows.  Shorter vectors
    count as ending with entries of 0; entries beyond 2^40 / 64 count as that.  A deviation
    beyond the range of longs is NULL.  Without two different vectors there is no component,
    so an empty table, one vector and copies of one vector give no rows.  NULL and repeated ids
    are rows like others; other columns are ignored.
    """
    vectors = kept_table(integer_vectors(rows), "whitening-vectors")
    model = fit(vectors, components)
    if model is None:
        return rows.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, "
                "identity_error double")
    off, k, n = identity_error(vectors, model), len(model.values), model.mean.n
    shares = model.values / model.trace

    def task(batches: Batches) -> Batches:
        for batch in pieces(batches, 1024):
            m = batch.num_rows
            if m:
                # Every row k times: one for each component.
                ids = batch.column(0).take(pa.array(np.repeat(np.arange(m), k)))
                far = pa.array(model.mean.deviations(batch.column(1)), pa.int64()).take(
                    pa.array(np.repeat(np.arange(m), k)))
                yield to_batch(_ROWS, ids, np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, n), far,
                               model.whitened(batch.column(1)).ravel(), np.tile(shares, m), np.full(m * k, off))

    return in_arrow(vectors.select("vec_id", "x"), task,
                    ", ".join(f"{f.name} {t}" for f, t in zip(_ROWS, (
                        "long", "int", "long", "long", "double", "double", "double"))))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(read(spark, folder, "embeddings"))
