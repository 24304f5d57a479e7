"""The checks of model fits pass for right fits and fail for trivial ones."""

import pytest
from pyspark.sql import functions as F

from vacancylens.operators import clusters as K
from vacancylens.plans import fits

GROUPS = [["python", "sql", "spark"], ["react", "node", "css"], ["java", "spring", "kafka"]]


@pytest.fixture(scope="module")
def posted(spark):
    rows = [(f"j{i}", GROUPS[(i > 29) + (i > 49)][: 2 + i % 2]) for i in range(60)]  # 30, 20 and 10 of a kind
    return spark.createDataFrame(rows, "job_hash string, skills array<string>").cache()


@pytest.fixture(scope="module")
def weights(posted):
    return K.tfidf_skills(posted).withColumnRenamed("weight", "x").cache()


def judged(points):
    centres = points.groupBy(F.col("own").alias("cluster"), "term").agg(F.sum("x").alias("s")).join(
        points.select(F.col("own").alias("cluster"), "job_hash").distinct().groupBy("cluster").count(), "cluster").select(
        "cluster", "term", (F.col("s") / F.col("count")).alias("x"))
    near = fits.distances(points, centres, "job_hash", "own")
    figures = fits.clustering(points, "job_hash", "own").first()
    return near.filter("NOT nearest").count(), figures["n_clusters"], figures["tighter"], figures["total"]


def test_a_right_clustering_passes(posted, weights):
    own = K.RoleModel(posted, k=3).assign(posted).select("job_hash", F.col("cluster").alias("own"))
    wrong, n, tighter, total = judged(weights.join(own, "job_hash"))
    assert (wrong, n, tighter) == (0, 3, True) and 0 < total < 1


@pytest.mark.parametrize("own, fails", [("0", "all"), ("CAST(substr(job_hash, 2) AS INT) % 2", "count"),
                                        ("CAST(crc32(job_hash) % 3 AS INT)", "nearest")])
def test_a_trivial_clustering_fails(weights, own, fails):
    wrong, n, tighter, _ = judged(weights.withColumn("own", F.expr(own)))
    assert wrong > 0 if fails == "nearest" else n != 3 and (fails == "count" or not tighter)


def test_projections(spark, posted, weights):
    right = K.pca_2d(K.tfidf_vectors(posted, K.read_terms(posted)))
    row = fits.projection(right, weights, "job_hash").first()
    assert row["widest"] and row["ordered"] and (row["mean_1"], row["mean_2"], row["shared"], row["n"]) == (0, 0, 0, 60)
    for flat in (right.withColumns({"pca_1": F.lit(0.0), "pca_2": F.lit(0.0)}),
                 right.withColumn("pca_1", F.col("pca_1") / 3), right.withColumn("pca_1", F.col("pca_1") * 9)):
        assert not fits.projection(flat, weights, "job_hash").first()["widest"]


def test_listed_terms(spark):
    means = spark.createDataFrame([(0, "a", 0.5), (0, "b", 0.3), (0, "c", 0.1), (1, "a", 0.2)], "cluster int, term string, mean double")

    def heaviest(rows):
        listed = spark.createDataFrame(rows, "cluster int, term string, weight double")
        return {r["cluster"]: r["heaviest"] for r in fits.heaviest(listed, means).collect()}
    assert heaviest([(0, "a", 0.5), (0, "b", 0.3), (1, "a", 0.2), (1, "x", 0.0)]) == {0: True, 1: True}
    assert heaviest([(0, "a", 0.5), (0, "c", 0.1), (1, "x", 0.0)]) == {0: False, 1: False}
