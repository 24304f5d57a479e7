"""Invariants of the fitted models, and TF-IDF against plain Python."""

import math
import re
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vacancylens.operators import clusters as K

GROUPS = [["python", "SQL", "Spark"], ["React", "Node.js", "CSS"], ["Java", "Spring", "Kafka"]]


@pytest.fixture(scope="module")
def posted(spark):
    rows = [(f"j{i}", GROUPS[i % 3][: 2 + i % 2] + (["R"] if i % 5 == 0 else [])) for i in range(90)]
    rows += [("only_r", ["R", "C"]), ("none", None), ("empty", [])]
    return spark.createDataFrame(rows, "job_hash string, skills array<string>").cache()


def expected(rows, max_terms):
    docs = {k: re.findall(r"\b\w\w+\b", " ".join(s).lower()) for k, s in rows if s}
    total, df = Counter(), Counter()
    for tokens in docs.values():
        total.update(tokens)
        df.update(set(tokens))
    terms = [t for t, _ in sorted(total.items(), key=lambda e: (-e[1], e[0]))[:max_terms]]
    out = {}
    for k, tokens in docs.items():
        x = {t: n * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in Counter(tokens).items() if t in terms}
        norm = math.sqrt(sum(v * v for v in x.values()))
        out |= {(k, t): v / norm for t, v in x.items()}
    return out


@pytest.mark.parametrize("max_terms", [100, 4])
def test_tfidf_matches_plain_python_and_the_vectors(spark, posted, max_terms):
    want = expected([tuple(r) for r in posted.collect()], max_terms)
    got = {(r["job_hash"], r["term"]): r["weight"] for r in K.tfidf_skills(posted, max_terms=max_terms).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)
    terms = K.read_terms(posted, max_terms)
    vectors = K.tfidf_vectors(posted, terms).select("job_hash", vector_to_array("features").alias("v")).collect()
    dense = {(r["job_hash"], t): x for r in vectors for (t, _), x in zip(terms, r["v"]) if x}
    assert dense.keys() == want.keys()
    assert all(math.isclose(dense[k], want[k], rel_tol=1e-12) for k in want)
    assert len(vectors) == 91  # a posting without any token is a zero vector


def test_role_clusters(spark, posted):
    before = posted.count() and spark.sparkContext._jsc.getPersistentRDDs().size()
    model = K.RoleModel(posted, k=3)
    out = model.assign(posted).collect()
    assert len(out) == 91 and {r["cluster"] for r in out} <= {0, 1, 2}
    assert min(model.costs) == pytest.approx(model.model.summary.trainingCost) and len(model.costs) == 10
    by_group = {}
    for r in out:
        if r["job_hash"].startswith("j"):
            by_group.setdefault(int(r["job_hash"][1:]) % 3, set()).add(r["cluster"])
    assert all(len(c) == 1 for c in by_group.values()) and len(set.union(*by_group.values())) == 3
    top = model.top_terms(posted, 2).collect()
    assert [(r["cluster"], r["rank"]) for r in top] == [(c, r) for c in range(3) for r in (1, 2)]
    assert K.RoleModel(posted.limit(2), k=3).assign(posted.limit(2)).count() == 2  # few points are points too
    with pytest.raises(ValueError):
        K.RoleModel(posted.limit(0), k=3)
    assert not spark.sparkContext._jsc.getPersistentRDDs().size() - before


def test_weighted_fit_costs_what_the_full_fit_costs(spark, posted):
    model = K.RoleModel(posted, k=3)
    every = K.tfidf_vectors(posted, model.terms)
    assert model.model.summary.trainingCost == pytest.approx(
        sum(r[0] for r in model.model.transform(every).select(
            F.aggregate(F.zip_with(vector_to_array("features"), F.element_at(F.lit([
                [float(x) for x in c] for c in model.model.clusterCenters()]), F.col("cluster") + 1),
                lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)).collect()), rel=1e-9)


def test_pca_is_centred_ordered_and_signed(spark, posted):
    vectors = K.tfidf_vectors(posted, K.read_terms(posted))
    first, again = (K.pca_2d(vectors).select("job_hash", "pca_1", "pca_2").orderBy("job_hash").collect()
                    for _ in range(2))
    assert first == again and len(first) == 91
    for c in ("pca_1", "pca_2"):
        assert sum(r[c] for r in first) == pytest.approx(0, abs=1e-9)
    spread = [sum(r[c] ** 2 for r in first) for c in ("pca_1", "pca_2")]
    assert spread[0] >= spread[1] > 0
    assert sum(r["pca_1"] * r["pca_2"] for r in first) == pytest.approx(0, abs=1e-6)


def test_company_segments(spark):
    rows = [(f"c{i}", f"t{j}", "x" if i % 2 else "y") for i in range(12) for j in range(1 + i)]
    df = spark.createDataFrame(rows, "company string, title string, career_level string")
    out = K.company_segments(df, ["x", "y"])
    got = out.collect()
    assert len(got) == 10 and {r["segment"] for r in got} <= {0, 1, 2} and min(r["total_jobs"] for r in got) == 3
    assert K.segment_plot_data(out).columns == ["company", "total_jobs", "first_level_jobs", "segment"]
    few = K.company_segments(df.filter("company IN ('c2', 'c3')"), ["x", "y"]).collect()
    assert len(few) == 2
    found = K.company_segments(df)  # levels of the data
    assert found.columns == out.columns and found.count() == 10
