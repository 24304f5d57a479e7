"""Sketches, proven top lists, bitmaps, sparse components, long title lists: against exact or plain versions."""

import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from vacancylens.operators import analytics as A
from vacancylens.operators import bitmaps, clean, clusters, sketches
from vacancylens.operators.sparse_pca import SparsePCA, sparse_pca, sparse_rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Sketches

@pytest.fixture(scope="module")
def active(spark):
    rows = spark.range(20_000).select(
        F.concat(F.lit("c"), (F.col("id") % 3000).cast("string")).alias("company"),
        F.when(F.col("id") % 10 > 0, (F.col("id") % 700).cast("string")).alias("location"),
        F.array(F.concat(F.lit("s"), (F.col("id") % 41).cast("string")), F.lit("")).alias("skills"),
        F.when(F.col("id") % 50 > 0, F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 300)).cast("timestamp_ntz").alias("date_first_seen"))
    return rows.cache()


def near(got, exact):
    return abs(got - exact) <= 4 * sketches.relative_error() * exact + 1


def test_days_merge_to_the_summary_of_any_span(active):
    days = sketches.daily_sketches(active).cache()
    assert days.count() == active.select(F.to_date("date_first_seen")).distinct().count()
    for span, cond in ((None, "true"), (F.col("day") < "2023-12-01", "date_first_seen < '2023-12-01'"),
                       (F.col("day").isNull(), "date_first_seen IS NULL")):
        got, exact = sketches.span_summary(days, span).first(), A.load_summary(active.filter(cond)).first()
        assert got["jobs"] == exact["jobs"] and (got["first_seen"], got["last_seen"]) == (exact["first_seen"], exact["last_seen"])
        assert near(got["companies"], exact["companies"]) and near(got["locations"], exact["locations"])
    assert sketches.span_summary(days, F.lit(False)).first()["companies"] == 0
    assert near(sketches.span_summary(days).first()["skills"], 41)


def test_runs_over_different_postings_merge_by_day(active):
    halves = [sketches.daily_sketches(active.filter(c)) for c in ("company < 'c2'", "company >= 'c2'")]
    merged = sketches.merged_days(halves[0].unionAll(halves[1]))
    assert merged.count() == merged.select("day").distinct().count()
    got = sketches.span_summary(merged).first()
    assert got["jobs"] == 20_000 and near(got["companies"], 3000)


# Top lists

@pytest.mark.parametrize("shape", ["skewed", "flat", "ties", "few"])
@pytest.mark.parametrize("capacity", [8, 4096])
def test_proven_top_equals_value_counts(spark, shape, capacity):
    rng = random.Random(3)
    values = {"skewed": [f"v{int(rng.paretovariate(0.7)) % 5000}" for _ in range(8000)],
              "flat": [f"v{i % 2500}" for i in range(5000)], "ties": [f"v{i % 10}" for i in range(1000)] + ["w"] * 5,
              "few": ["a", "a", "b", None, "", " "]}[shape]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    for top, drop in ((10, True), (3, False)):
        want = A.value_counts(df, "v", top, drop).collect()
        assert sketches.proven_top(df, "v", top, drop, capacity=capacity).collect() == want


def test_counters_keep_what_they_may_have_lost(spark):
    values = [f"v{i}" for i in range(20_000)] + ["hot"] * 5000
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(4)
    rows = sketches.heavy_candidates(df, "v", 50)
    found = {r["value"]: r["n"] for r in rows.collect()}
    lost = rows.filter("value IS NULL").first()["lost"]
    exact = Counter(values)
    assert lost > 0 and len(found) < 4 * 101 + 2
    for v, n in exact.items():
        assert found.get(v, 0) <= n <= found.get(v, 0) + lost


# Bitmaps

def plain_pairs(rows, top):
    multi = [r for r in rows if r and len(r) >= 2]
    ranked = sorted(Counter(s for r in multi for s in r).items(), key=lambda e: (-e[1], e[0]))[:top]
    names = [s for s, _ in ranked]
    counts = Counter(p for r in multi for p in permutations(r, 2))
    return {(a, b): counts[a, b] for a in names for b in names}


@pytest.mark.parametrize("top", [1, 15, 200])
def test_bitmap_pairs_equal_plain_counts(spark, top):
    rng = random.Random(top)
    rows = [[f"s{min(int(rng.expovariate(0.05)), 260)}" for _ in range(rng.randint(0, 9))] for _ in range(700)] + [None, ["x", "x", "x"]]
    df = spark.createDataFrame([(r,) for r in rows], "skills array<string>").repartition(3)
    got = bitmaps.skill_pairs(df, top)
    assert {(r["skill_1"], r["skill_2"]): r["n"] for r in got.collect()} == plain_pairs(rows, top)
    assert "CartesianProduct" not in plan_of(got)
    if top == 15:
        assert got.collect() == A.skill_cooccurrence(df, top).collect()


def test_bitmaps_of_many_blocks_and_of_nothing(spark):
    many = spark.range(3 * bitmaps.BLOCK // 2).select(F.array(F.lit("a"), F.lit("b"), (F.col("id") % 3).cast("string")).alias("skills")).coalesce(1)
    got = {(r[0], r[1]): r[2] for r in bitmaps.skill_pairs(many).collect()}
    assert got["a", "b"] == 3 * bitmaps.BLOCK // 2 and got["a", "1"] == bitmaps.BLOCK // 2 and got["a", "a"] == 0
    assert bitmaps.skill_pairs(spark.createDataFrame([(["a"],), (None,)], "skills array<string>")).count() == 0


# Sparse components

def test_sparse_components_equal_dense_ones(spark):
    rng = np.random.default_rng(4)
    x = rng.random((300, 40)) * (rng.random((300, 40)) < 0.2) * np.linspace(3, 0.5, 40)
    rows = [(i, Vectors.sparse(40, [(j, v) for j, v in enumerate(r) if v]) if i % 3 else Vectors.dense(r)) for i, r in enumerate(x)]
    vectors = spark.createDataFrame(rows, ["job_hash", "features"]).repartition(4)
    model, projected = sparse_pca(vectors, 40, k=2)
    centred = x - x.mean(0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    assert np.allclose(model.variances, values[::-1][:2], rtol=1e-9)
    assert np.abs(np.abs((axes[:, ::-1][:, :2] * model.axes).sum(0)) - 1).max() < 1e-9
    got = {r["job_hash"]: (r["pca_1"], r["pca_2"]) for r in projected.collect()}
    assert np.allclose([got[i] for i in range(300)], centred @ model.axes)
    dense = {r["job_hash"]: (r["pca_1"], r["pca_2"]) for r in clusters.pca_2d(vectors).collect()}
    assert np.allclose([got[i] for i in range(300)], [dense[i] for i in range(300)], atol=1e-7)


def test_a_hundred_thousand_terms(spark):
    n = 100_000
    rows = spark.range(2000).select(F.col("id").alias("job_hash"), F.array(
        (F.col("id") % 2).cast("int"), F.lit(2) + (F.col("id") % 3).cast("int"), (F.lit(10) + F.col("id") * 49).cast("int")).alias("indices"),
        F.array(F.lit(3.0), F.lit(1.0), F.lit(0.1)).alias("values"))
    model = SparsePCA(rows, n, 2, tolerance=1e-7)
    # The first component tells odd from even rows, the second (one of two alike) the remainders by three.
    assert np.isclose(model.variances[0], 4.5, rtol=1e-3) and np.isclose(model.variances[1], 1 / 3, rtol=2e-2)
    assert set(np.argsort(-np.abs(model.axes[:, 0]))[:2]) == {0, 1} and model.axes.shape == (n, 2)


def test_odd_sparse_rows(spark):
    same = spark.createDataFrame([(i, Vectors.sparse(3, {})) for i in range(4)], ["job_hash", "features"])
    assert [r["indices"] for r in sparse_rows(same, "job_hash").collect()] == [[]] * 4
    model, projected = sparse_pca(same, 3)
    assert model.variances.tolist() == [0, 0] and all(r["pca_1"] == 0 for r in projected.collect())
    one, _ = sparse_pca(spark.createDataFrame([(1, Vectors.dense([1.0])), (2, Vectors.dense([3.0]))], ["job_hash", "features"]), 1)
    assert np.allclose(one.variances, [1.0])


# Title lists

def test_a_million_listed_titles(spark):
    listed = spark.range(1_000_000).select(F.concat(F.lit(" Title "), F.col("id").cast("string"), F.lit(" ")).alias("title"))
    rows = spark.createDataFrame([(1, "title 5"), (2, "TITLE 999999 "), (3, "title 1000000"), (4, None), (5, "title 5")],
                                 "seq long, title string")
    assert sorted(r["seq"] for r in clean.drop_listed_titles(rows, listed).collect()) == [3, 4]


def test_a_short_list_equals_the_fixed_rule(spark):
    names = clean.CleanConfig().non_job_titles
    titles = spark.createDataFrame([(t,) for t in names] + [(None,)], "title string")
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*names, "Data Engineer", names[0].upper(), f"{names[0]} x"])],
                                 "seq long, title string")
    want = rows.filter(~F.lower(F.trim("title")).isin([t.lower() for t in names]))
    assert sorted(clean.drop_listed_titles(rows, titles).collect()) == sorted(want.collect())
