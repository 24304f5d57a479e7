"""Principal components of sparse rows, for vocabularies too long for a dense covariance.

A block subspace iteration: the covariance is only met as a product with a few columns.  A task
multiplies its rows, still sparse, and sends sums per slice of terms; other tasks add the slices.
The driver holds a few columns of one number per term.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .clusters import cached_points

SLICE = 8192          # terms added up by one task
ENTRIES = 1 << 18     # entries multiplied at a time


def _entries(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(row, term, value) of many rows at a time, and how many rows; columns ``at`` and ``at + 1`` hold the lists."""
    for batch in batches:
        starts = 0
        while starts < batch.num_rows:
            lengths = batch.column(at).value_lengths().to_numpy(zero_copy_only=False)[starts:]
            n = max(1, int(np.searchsorted(np.cumsum(lengths), ENTRIES)))
            part = batch.slice(starts, n)
            rows = np.repeat(np.arange(part.num_rows), lengths[:part.num_rows])
            yield rows, part.column(at).flatten().to_numpy(), part.column(at + 1).flatten().to_numpy(), part.num_rows
            starts += n


def sparse_rows(vectors: DataFrame, *keep: str, features: str = "features") -> DataFrame:
    """ML vectors as arrays ``indices`` and ``values``; a dense one lists all its places."""
    inner = F.unwrap_udt(F.col(features))
    places = F.when(F.size(inner["values"]) > 0, F.sequence(F.lit(0), F.size(inner["values"]) - 1)).otherwise(
        F.array().cast("array<int>"))
    return vectors.select(*keep, F.coalesce(inner["indices"], places).alias("indices"), inner["values"].alias("values"))


def _multiplied(rows: np.ndarray, terms: np.ndarray, values: np.ndarray, n: int, block: np.ndarray) -> np.ndarray:
    """The sparse rows times a few columns."""
    return np.column_stack([np.bincount(rows, values * block[terms, j], minlength=n) for j in range(block.shape[1])])


def _total(rows: DataFrame, n_terms: int, width: int, part: Callable) -> np.ndarray:
    """Sum of ``part(rows, terms, values, n)``, an array of ``n_terms`` x ``width``, over all rows."""
    ship_package(rows.sparkSession)
    schema, ddl = pa.schema([("slice", pa.int32()), ("total", pa.binary())]), "slice int, total binary"

    def send(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for s in range(0, n_terms, SLICE):
            yield pa.RecordBatch.from_arrays([pa.array([s // SLICE], pa.int32()),
                                              pa.array([total[s:s + SLICE].tobytes()], pa.binary())], schema=schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_terms, width))
        for entries in _entries(batches, 0):
            part(total, *entries)
        yield from send(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, cell in zip(*(c.to_pylist() for c in batch.columns)):
                sums[s] = sums[s] + np.frombuffer(cell) if s in sums else np.frombuffer(cell)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                              pa.array([v.tobytes() for v in sums.values()], pa.binary())], schema=schema)

    partial = rows.select("indices", "values").mapInArrow(task, ddl)
    out = np.zeros((n_terms, width))
    for s, cell in partial.repartition("slice").mapInArrow(add, ddl).collect():  # the columns, once
        out[s * SLICE:(s + 1) * SLICE] = np.frombuffer(cell).reshape(-1, width)
    return out


class SparsePCA:
    """``k`` leading components of ``rows`` (``indices``, ``values``): ``axes`` as columns, ``variances``, ``mean``.

    The subspace grows by the residuals of what has not settled and starts again from its best columns when
    it gets wide.  A component is settled when its residual is ``tolerance`` of the largest variance.
    """

    def __init__(self, rows: DataFrame, n_terms: int, k: int = 2, tolerance: float = 1e-9, rounds: int = 60,
                 seed: int = 42):
        self.n = rows.count()
        k = min(k, n_terms)

        def add_up(total: np.ndarray, r: np.ndarray, terms: np.ndarray, values: np.ndarray, n: int) -> None:
            total[:, 0] += np.bincount(terms, values, minlength=n_terms)

        self.mean = _total(rows, n_terms, 1, add_up)[:, 0] / max(self.n, 1)
        width = min(n_terms, k + 6)
        basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))[0]
        image = self._product(rows, basis)
        self.passes = 1
        for _ in range(rounds):
            small = basis.T @ image
            theta, turn = np.linalg.eigh((small + small.T) / 2)
            order = np.argsort(-theta)
            theta, basis, image = theta[order], basis @ turn[:, order], image @ turn[:, order]
            residual = image[:, :width] - basis[:, :width] * theta[:width]
            if (np.linalg.norm(residual[:, :k], axis=0) <= tolerance * max(theta[0], 1e-300)).all():
                break
            if basis.shape[1] + width > 6 * width:
                basis, image = basis[:, :2 * width], image[:, :2 * width]
            new = residual
            for _ in range(2):
                new = new - basis @ (basis.T @ new)
            new, size, _ = np.linalg.svd(new, full_matrices=False)
            new = new[:, size > 1e-13 * max(theta[0], 1e-300)]
            if not new.shape[1]:
                break
            new = np.linalg.qr(new - basis @ (basis.T @ new))[0]
            basis, image = np.column_stack([basis, new]), np.column_stack([image, self._product(rows, new)])
            self.passes += 1
        else:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
        axes = basis[:, :k]
        # The largest loading is positive, as in the dense twin.
        self.axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
        self.variances = np.maximum(theta[:k], 0)

    def _product(self, rows: DataFrame, block: np.ndarray) -> np.ndarray:
        n_terms, width = block.shape

        def multiply(total: np.ndarray, r: np.ndarray, terms: np.ndarray, values: np.ndarray, n: int) -> None:
            through = _multiplied(r, terms, values, n, block)
            for j in range(width):
                total[:, j] += np.bincount(terms, values * through[r, j], minlength=n_terms)

        return _total(rows, n_terms, width, multiply) / max(self.n, 1) - np.outer(self.mean, self.mean @ block)

    def project(self, rows: DataFrame, key: str) -> DataFrame:
        """``key, pca_1, pca_2, ...`` of every row, centred."""
        axes, shift = self.axes, self.mean @ self.axes
        k = axes.shape[1]
        names = [f"pca_{j + 1}" for j in range(k)]

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                place = 0
                for r, terms, values, n in _entries(iter([batch]), 1):
                    points = _multiplied(r, terms, values, n, axes) - shift
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(place, n), *[pa.array(points[:, j]) for j in range(k)]], names=[key, *names])
                    place += n

        kind = rows.schema[key].dataType.simpleString()
        return rows.select(key, "indices", "values").mapInArrow(
            task, ", ".join([f"`{key}` {kind}", *[f"{n} double" for n in names]]))


def sparse_pca(vectors: DataFrame, n_terms: int, key: str = "job_hash", k: int = 2) -> tuple[SparsePCA, DataFrame]:
    """The model of ``features`` in ``vectors`` and their projection by ``key``.

    Every pass of the iteration reads all rows: they are kept for it, not derived again each time.
    """
    rows = sparse_rows(vectors, key)
    with cached_points(rows.select("indices", "values")) as points:
        model = SparsePCA(points, n_terms, k)
    return model, model.project(rows, key)
