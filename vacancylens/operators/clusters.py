"""TF-IDF weights, role clusters, 2-D projection, company segments (Spark ML)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .analytics import company_features, min_volume, scale_features

MAX_ITERATIONS = 300
N_STARTS = 10
SEED = 42
# Centres move until no point changes its cluster: each centre is then the mean of its members.
TOLERANCE = 0.0
# A step of a fit does little with a point: fewer of them in a task and starting tasks takes longer than the step.
POINTS_PER_TASK = 1 << 15

_TOKEN = r"(?U)\b\w\w+\b"


def skill_tokens(skills: Column) -> Column:
    """Lower-case words of two or more word characters of the joined skills."""
    return F.regexp_extract_all(F.lower(F.array_join(skills, " ")), F.lit(_TOKEN), F.lit(0))


def _with_tokens(postings: DataFrame) -> DataFrame:
    return postings.filter(F.size("skills") > 0).withColumn("tokens", skill_tokens(F.col("skills")))


def vocabulary(postings: DataFrame, max_terms: int | None = None) -> DataFrame:
    """The terms, or the ``max_terms`` most frequent ones, with their inverse document frequency.

    One pass: an empty term stands once in every posting, so its count is the number
    of postings.  A term's first place in a posting is marked, so that both counts are sums.
    """
    docs = _with_tokens(postings)
    counted = (docs.select(F.posexplode(F.array_append("tokens", "")).alias("at", "term"), "tokens")
               .select("term", (F.array_position("tokens", F.col("term")) == F.col("at") + 1).alias("first"))
               .groupBy("term").agg(F.count("*").alias("corpus_tf"), F.count_if("first").alias("df")))
    n_docs = counted.agg(F.max(F.when(F.col("term") == "", F.col("corpus_tf")))).scalar()
    ranked = counted.filter("term <> ''").orderBy(F.desc("corpus_tf"), F.asc("term"))
    ranked = ranked if max_terms is None else ranked.limit(max_terms)
    return ranked.withColumn("idf", F.log((n_docs + 1) / (F.col("df") + 1)) + 1)


def tfidf_skills(postings: DataFrame, key: str = "job_hash", max_terms: int | None = None) -> DataFrame:
    """(key, term, weight): tf x idf per posting, scaled to length 1.

    A posting's tokens stay in its row: the vocabulary arrives as one map from a
    scalar subquery, and nothing is shuffled per posting.
    """
    idf = vocabulary(postings, max_terms).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "idf")))).scalar()
    weighted = (_with_tokens(postings).select(key, "tokens").withColumn("_idf", idf)
                # A posting has a few tokens: counting each one over the list beats sorting it (18 s against 3).
                .withColumn("w", F.expr("""
                    transform(filter(array_distinct(tokens), t -> map_contains_key(_idf, t)),
                              t -> struct(t AS term, size(filter(tokens, u -> u = t)) * _idf[t] AS x))"""))
                .withColumn("_norm", F.sqrt(F.aggregate(
                    "w", F.lit(0.0), lambda acc, e: acc + e["x"] * e["x"]))))
    return (weighted.select(key, "_norm", F.inline("w"))
            .select(key, "term", (F.col("x") / F.col("_norm")).alias("weight")))


def tfidf_vectors(postings: DataFrame, terms: Sequence[tuple[str, float]]) -> DataFrame:
    """The same weights as sparse vectors in ``features``, by Spark ML stages.

    ``terms`` are (term, idf) pairs in the order of the vector's indices.
    """
    return _vectors(_with_tokens(postings), terms)


def _vectors(docs: DataFrame, terms: Sequence[tuple[str, float]]) -> DataFrame:
    names = [t for t, _ in terms]
    counted = CountVectorizerModel.from_vocabulary(names, inputCol="tokens", outputCol="_tf").transform(docs)
    weighted = ElementwiseProduct(scalingVec=Vectors.dense([w for _, w in terms]), inputCol="_tf",
                                  outputCol="_tfidf").transform(counted)
    scaled = Normalizer(p=2.0, inputCol="_tfidf", outputCol="features").transform(weighted)
    return scaled.drop("_tf", "_tfidf")


def read_terms(postings: DataFrame, max_terms: int | None = None) -> list[tuple[str, float]]:
    """The vocabulary on the driver, in term order: words of skill names, or ``max_terms`` of them."""
    return sorted((r["term"], r["idf"]) for r in vocabulary(postings, max_terms).collect())


@contextmanager
def cached_points(points: DataFrame, per_task: int = POINTS_PER_TASK) -> Iterator[DataFrame]:
    """The points of a fit, kept for its iterations and freed after it, ``per_task`` of them to a task.

    A cached table stays in the partitions it was computed in, hundreds after a shuffle however few rows
    they hold, and each step of a fit would start a task for each.  So the points are counted and packed.
    """
    loose = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        packed = loose.coalesce(max(1, -(-loose.count() // per_task))).persist(StorageLevel.MEMORY_AND_DISK)
        packed.count()
    finally:
        loose.unpersist()
    try:
        yield packed
    finally:
        packed.unpersist()


def _different_points(points: DataFrame, k: int) -> int:
    """The number of different points, or ``k`` if there are more.  A few of the points mostly show ``k``."""
    values = points.select(vector_to_array("features"))
    few = values.limit(100 * k).distinct().count()
    return min(k, few if few >= k else values.distinct().count())


def best_kmeans(points: DataFrame, k: int, seed: int = SEED, starts: int = N_STARTS,
                weight: str | None = None, parallelism: int = N_STARTS,
                iterations: int = MAX_ITERATIONS) -> tuple[KMeansModel, list[float]]:
    """The model with the lowest cost out of several starts, and all costs.

    Fewer different points than ``k`` make as many clusters; there must be two at least.

    The starts are independent Spark jobs on the same cached points, submitted
    side by side: one start alone leaves most of a cluster idle between steps.
    """
    k = _different_points(points, k)
    if k < 2:
        raise ValueError("clustering needs two different points")

    def fit(start: int) -> KMeansModel:
        kmeans = KMeans(k=k, seed=seed + start, maxIter=iterations, tol=TOLERANCE, featuresCol="features",
                        predictionCol="cluster")
        return (kmeans.setWeightCol(weight) if weight else kmeans).fit(points)

    with ThreadPool(min(parallelism, starts)) as pool:
        models = pool.map(inheritable_thread_target(points.sparkSession)(fit), range(starts))
    costs = [m.summary.trainingCost for m in models]
    return models[costs.index(min(costs))], costs


class RoleModel:
    """Clusters of postings by the skills they ask for.

    Postings with the same tokens are one point, so the model is fitted on the
    distinct token lists, weighted by their number of postings.  The objective
    is the same; the data is as small as the variety of skill sets.  Assigning
    a posting to its cluster needs no shuffle.
    """

    def __init__(self, postings: DataFrame, k: int = 5, max_terms: int | None = None, seed: int = SEED,
                 starts: int = N_STARTS, iterations: int = MAX_ITERATIONS):
        self.terms = read_terms(postings, max_terms)
        token_sets = (_with_tokens(postings).groupBy(F.array_sort("tokens").alias("tokens"))
                      .agg(F.count("*").cast("double").alias("weight")))
        with cached_points(_vectors(token_sets, self.terms).select("features", "weight")) as points:
            self.model, self.costs = best_kmeans(points, k, seed, starts, weight="weight", iterations=iterations)

    def assign(self, postings: DataFrame) -> DataFrame:
        """Postings that have skills, with ``features`` and ``cluster``."""
        return self.model.transform(tfidf_vectors(postings, self.terms)).drop("tokens")

    def top_terms(self, postings: DataFrame, n: int = 7) -> DataFrame:
        """The heaviest terms of each cluster centre (k x n rows)."""
        rows = []
        for cluster, centre in enumerate(self.model.clusterCenters()):
            order = sorted(range(len(self.terms)), key=lambda i: (-centre[i], self.terms[i][0]))[:n]
            rows += [(cluster, rank, self.terms[i][0], float(centre[i])) for rank, i in enumerate(order, 1)]
        return postings.sparkSession.createDataFrame(
            rows, "cluster int, rank int, term string, weight double")


def pca_2d(vectors: DataFrame, features: str = "features") -> DataFrame:
    """Two principal components of centred vectors as ``pca_1`` and ``pca_2``.

    Spark's projection does not centre, and centring first would make sparse
    vectors dense.  Projection is linear: subtracting the mean of the projected
    values is the same.  Each component's largest loading is made positive.
    """
    with cached_points(vectors.select(features)) as points:  # the fit reads them several times
        model = PCA(k=2, inputCol=features, outputCol="_pca").fit(points)
    loadings = model.pc.toArray()
    signs = [float(np.sign(loadings[np.argmax(np.abs(loadings[:, j])), j]) or 1.0) for j in range(2)]
    projected = model.transform(vectors).withColumn("_pca", vector_to_array("_pca")).withColumns({
        f"pca_{j + 1}": F.col("_pca")[j] * signs[j] for j in range(2)}).drop("_pca")
    means = projected.agg(F.struct(F.avg("pca_1").alias("m1"), F.avg("pca_2").alias("m2"))).scalar()
    return projected.withColumn("_m", means).withColumns({
        "pca_1": F.col("pca_1") - F.col("_m.m1"), "pca_2": F.col("pca_2") - F.col("_m.m2")}).drop("_m")


def company_segments(active: DataFrame, levels: Sequence[str] | None = None, k: int = 3, least_jobs: int = 3,
                     seed: int = SEED, starts: int = N_STARTS, iterations: int = MAX_ITERATIONS) -> DataFrame:
    """Companies of some size, with their counts and a ``segment`` number.

    Levels are those of the data unless named.
    """
    features = min_volume(company_features(active, levels), least_jobs)
    columns = [c for c in features.columns if c != "company"]
    scaled = scale_features(features, columns, "_z")
    points = (VectorAssembler(inputCols=[f"{c}_z" for c in columns], outputCol="features").transform(scaled)
              .select("company", *[f"`{c}`" for c in columns], "features"))
    with cached_points(points) as cached:
        model, _ = best_kmeans(cached, k, seed, starts, iterations=iterations)
    return model.transform(points).withColumnRenamed("cluster", "segment").drop("features")


def segment_plot_data(segments: DataFrame) -> DataFrame:
    """Company, volume, the first level column and the segment."""
    first_level = segments.columns[2]
    return segments.select("company", "total_jobs", F.col(f"`{first_level}`").alias("first_level_jobs"), "segment")
