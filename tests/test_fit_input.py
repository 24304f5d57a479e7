"""What a fit reads: derived once, and in no more tasks than its points fill."""

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancylens.operators import clusters, sparse_pca
from vacancylens.plans import catalog


def points(spark, n, different):
    schema = T.StructType([T.StructField("job_hash", T.StringType()), T.StructField("features", VectorUDT())])
    return spark.createDataFrame([(str(i), Vectors.dense([float(i % different), 1.0])) for i in range(n)], schema)


def test_few_points_are_one_task(spark):
    scattered = points(spark, 90, 7).repartition(40)
    with clusters.cached_points(scattered) as packed:
        assert packed.rdd.getNumPartitions() == 1 and packed.count() == 90
    with clusters.cached_points(scattered, per_task=30) as packed:
        assert packed.rdd.getNumPartitions() == 3 and packed.count() == 90
    assert not packed.storageLevel.useMemory and not scattered.storageLevel.useMemory


def test_different_points_hidden_behind_many_copies(spark):
    hidden = points(spark, 600, 1).unionByName(points(spark, 3, 3)).coalesce(1)
    assert clusters._different_points(hidden, 5) == 3 and clusters._different_points(hidden, 2) == 2


def test_skills_are_read_from_their_own_folder(spark, tmp_path):
    rows = [("a", "active", ["x"], 1), ("a", "active", None, 2), (None, "inactive", ["y"], 3)]
    spark.createDataFrame(rows, "job_hash string, status string, skills array<string>, n int").write.parquet(f"{tmp_path}/p")
    kept = catalog._skilled(spark.read.parquet(f"{tmp_path}/p"))
    assert sorted(map(str, kept.collect())) == sorted(map(str, [r for r in spark.createDataFrame(
        [("a", ["x"]), ("a", None)], "job_hash string, skills array<string>").collect()]))
    assert not any(str(tmp_path) in f for f in kept.inputFiles())


def test_rows_of_the_iteration_are_kept(spark, monkeypatch):
    levels = []

    class Watched(sparse_pca.SparsePCA):
        def __init__(self, rows, *more):
            levels.append(rows.storageLevel.useMemory)
            super().__init__(rows, *more)

    monkeypatch.setattr(sparse_pca, "SparsePCA", Watched)
    _, projected = sparse_pca.sparse_pca(points(spark, 30, 5), 2)
    assert levels == [True] and projected.filter(F.col("pca_1").isNotNull()).count() == 30
