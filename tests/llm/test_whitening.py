"""Whitening: the iteration against a dense solver, the query against plain arithmetic, odd tables."""

import numpy as np
import pytest

from vacancylens.llm import whitening as q
from vacancylens.llm.common import read

FOLDER = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<double>"


def plain(vectors, components=32):
    """Whole vectors, means, whitened rows and eigenvalues by a dense solver."""
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors], np.int64)
    rows = x - x.sum(0) / len(x)
    values, axes = np.linalg.eigh(rows.T @ rows / len(x))
    values, axes = values[::-1], axes[:, ::-1]
    return x, rows @ axes[:, :components] / np.sqrt(values[:components]), values


@pytest.mark.parametrize("dim, spectrum", [
    (64, np.linspace(2, 1, 64)), (300, 0.9 ** np.arange(300)), (200, np.r_[np.full(20, 5.0), np.ones(180)]),
    (40, np.r_[np.ones(5), np.zeros(35)]), (5, np.arange(5, 0, -1.0)), (1, np.ones(1))])
def test_eigenvectors_reach_double_precision(dim, spectrum):
    turn = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))[0]
    matrix = (turn * spectrum) @ turn.T
    passes = []

    def product(block):
        passes.append(block.shape[1])
        return matrix @ block

    values, axes = q.jacobi_davidson(product, dim, 32)
    wanted = np.sort(spectrum)[::-1][:32]
    assert np.abs(values - wanted).max() < 1e-14 * spectrum.max() * dim
    assert np.linalg.norm(matrix @ axes - axes * values, axis=0).max() < 32 * q.EPS * np.sqrt(dim) * spectrum.max()
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13
    assert len(passes) < 60 and max(passes) <= 40


def test_minres_solves_every_column():
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    matrix = (turn * np.r_[np.linspace(-3, -1, 10), np.linspace(1, 2, 20)]) @ turn.T
    right = rng.standard_normal((30, 4))
    right[:, 2] = 0
    got = q.minres(lambda v: matrix @ v, right, 60, 1e-13)
    assert np.abs(matrix @ got - right).max() < 1e-10


def test_query_equals_plain_arithmetic(spark):
    rows = q.op12_embedding_whitening(spark, FOLDER).toPandas()
    source = read(spark, FOLDER, "embeddings").select("vec_id", "embedding").collect()
    x, white, values = plain([r[1] for r in source])
    place = {r[0]: i for i, r in enumerate(source)}
    got = np.zeros_like(white)
    got[rows.vec_id.map(place), rows.component - 1] = rows.whitened
    assert np.abs(got * np.sign((got * white).sum(0)) - white).max() < 1e-9
    shares = rows.groupby("component").explained.agg(["min", "max"])
    assert (shares["min"] == shares["max"]).all()
    assert np.abs(shares["min"] - values[:32] / values.sum()).max() < 1e-12
    assert rows.identity_error.nunique() == 1 and rows.identity_error[0] < 1e-9
    exact = [sum(int(len(x) * a - s) ** 2 for a, s in zip(v, x.sum(0).tolist())) for v in x.tolist()]
    assert (rows.deviation == rows.vec_id.map(lambda i: exact[place[i]])).all() and (rows.n == len(x)).all()
    assert len(rows) == 32 * len(x)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [i % 7 / 3, (i * i) % 11 / 5, 1.0]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 1.0, 1.0]), (103, [inf, 0.0, 0.0])]
    short = [(200, [2.0]), (201, []), (None, [0.5, 0.5, 1.0]), (7, [0.25, 0.5, 1.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in good + bad + short], SCHEMA + ", whitened string")
    rows = q.whiten(table).toPandas()
    kept = [v for _, v in good] + [[2.0, 0, 0], [0, 0, 0], [0.5, 0.5, 1.0], [0.25, 0.5, 1.0]]
    _, white, values = plain(kept)
    assert len(rows) == 3 * len(kept) and set(rows.component) == {1, 2, 3}
    assert not set(rows.vec_id) & {100.0, 101.0, 102.0, 103.0} and rows.vec_id.isna().sum() == 3
    assert np.abs(np.sort((rows[rows.component == 1].whitened ** 2)) - np.sort(white[:, 0] ** 2)).max() < 1e-10
    assert rows.identity_error[0] < 1e-10


def test_tables_without_spread(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        assert q.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0
    flat = spark.createDataFrame([(i, [1.0, float(i), 2.0 * i]) for i in range(9)], SCHEMA)
    assert {r[0] for r in q.whiten(flat).select("component").collect()} == {1}  # one direction varies


def test_deviations_stay_exact_or_become_null(spark):
    wide = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 0.5]), (4, [2.0 ** 20, 3.0])], SCHEMA)
    got = {r["vec_id"]: r["deviation"] for r in q.whiten(wide).filter("component = 1").collect()}
    assert got[1] is None and got[2] is None
    x = [[2 ** 40 + 10 ** 6, 10 ** 6], [-2 ** 40 + 10 ** 6, 64 + 10 ** 6], [10 ** 6, 32 + 10 ** 6],
         [2 ** 26 + 10 ** 6, 192 + 10 ** 6]]
    for i in (3, 4):
        assert got[i] == sum((4 * x[i - 1][d] - sum(v[d] for v in x)) ** 2 for d in (0, 1))


def test_many_partial_sums_are_added_by_tasks(spark):
    table = spark.createDataFrame([(i, [float(i % 5), float(i % 3)]) for i in range(300)], SCHEMA).repartition(100)
    vectors = q.integer_vectors(table)
    passes = q.Passes(vectors)
    mean = q.centre(vectors)
    assert passes.many and mean.n == 300
    plainly = plain([[i % 5, i % 3] for i in range(300)])[0]
    rows = plainly - plainly.mean(0)
    assert np.allclose(q.covariance_product(passes, mean)(np.eye(2)), rows.T @ rows / 300, rtol=1e-12)
