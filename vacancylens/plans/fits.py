"""What a model fit must show.  A fit has no unique result; these figures hold for every right one and fail for trivial ones.

Points and centres are long: a row per term that is not 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distances(points: DataFrame, centres: DataFrame, key: str, own: str) -> DataFrame:
    """(key, nearest): whether the centre of a point's own cluster is as near as any other.

    ``points`` (key, own, term, x) and ``centres`` (cluster, term, x).
    """
    norms = centres.groupBy("cluster").agg(F.sum(F.col("x") * F.col("x")).alias("c2"))
    assigned = points.select(key, own).distinct()
    dots = (points.join(centres.select("cluster", "term", F.col("x").alias("c")), "term")
            .groupBy(key, "cluster").agg(F.sum(F.col("x") * F.col("c")).alias("dot")))
    every = assigned.withColumn("cluster", F.explode(norms.agg(F.sort_array(F.collect_list("cluster"))).scalar()))
    # |x - c|^2 without the part that all centres share.
    far = (every.join(norms, "cluster").join(dots, [key, "cluster"], "left")
           .withColumn("far", F.col("c2") - 2 * F.coalesce("dot", F.lit(0.0))))
    return far.groupBy(key).agg((F.min(F.when(F.col(own) == F.col("cluster"), F.col("far"))) <=
                                 F.min("far") + 1e-6).alias("nearest"))


def clustering(points: DataFrame, key: str, own: str) -> DataFrame:
    """One row: ``n_clusters`` that are not empty, the mean squared distance ``total`` from the middle of all
    points, and whether the one from the middles of the clusters is ``tighter``.
    """
    members = points.select(key, own).distinct()
    sums = points.groupBy(own, "term").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    inside = sums.join(members.groupBy(own).agg(F.count("*").alias("n")), own).agg(
        F.countDistinct(own).alias("k"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("of_own"))
    whole = sums.groupBy("term").agg(F.sum("s").alias("s")).agg(F.sum(F.col("s") * F.col("s"))).scalar()
    n = members.agg(F.count("*")).scalar()
    total, within = (F.col("q") - F.col("_w") / F.col("_n")) / F.col("_n"), (F.col("q") - F.col("of_own")) / F.col("_n")
    return inside.withColumns({"_w": whole, "_n": n}).select(
        F.col("k").alias("n_clusters"), F.round(total, 9).alias("total"), (within < 0.999 * total).alias("tighter"))


def with_figures(rows: DataFrame, figures: DataFrame) -> DataFrame:
    """Every row with the one row of figures."""
    return rows.withColumn("_f", figures.agg(F.first(F.struct(*figures.columns))).scalar()).select(*rows.columns, "_f.*")


def heaviest(listed: DataFrame, means: DataFrame) -> DataFrame:
    """(cluster, heaviest): whether no term outside the list of a cluster weighs more than one on it.

    ``listed`` (cluster, term, weight), ``means`` (cluster, term, mean) of the members.
    """
    both = means.join(listed, ["cluster", "term"], "left").groupBy("cluster").agg(
        F.max(F.when(F.col("weight").isNull(), F.col("mean"))).alias("best_outside"))
    least = listed.groupBy("cluster").agg(F.min("weight").alias("least"), F.max("weight").alias("most"))
    return least.join(both, "cluster", "left").select(
        "cluster", ((F.col("most") > 0) & (F.col("least") >= F.coalesce("best_outside", F.lit(0.0)) - 1e-6)).alias("heaviest"))


def projection(projected: DataFrame, points: DataFrame, key: str) -> DataFrame:
    """One row about two projected columns of points (key, term, x), whose postings ``projected`` holds all.

    ``total`` is the variance of the points, ``largest`` that of their widest term.  The first
    component is at least as wide as any term, both together as any two, and no wider than all.
    """
    n = F.col("_n")
    terms = points.groupBy("term").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    spread = (terms.withColumn("_n", projected.agg(F.count("*")).scalar())
              .select((F.col("q") / n - (F.col("s") / n) * (F.col("s") / n)).alias("v")))
    known = spread.agg(F.struct(F.sum("v").alias("total"), F.sort_array(F.collect_list("v"), asc=False).alias("all"))).scalar()
    row = projected.agg(
        F.count("*").alias("n"), F.avg("pca_1").alias("m1"), F.avg("pca_2").alias("m2"),
        F.var_pop("pca_1").alias("v1"), F.var_pop("pca_2").alias("v2"), F.covar_pop("pca_1", "pca_2").alias("cov"))
    two = F.try_element_at("_k.all", F.lit(1)) + F.coalesce(F.try_element_at("_k.all", F.lit(2)), F.lit(0.0))
    return row.withColumn("_k", known).select(
        "n", (F.round("m1", 6) + 0.0).alias("mean_1"), (F.round("m2", 6) + 0.0).alias("mean_2"),
        (F.col("v1") >= F.col("v2")).alias("ordered"), (F.round("cov", 6) + 0.0).alias("shared"),
        F.round("_k.total", 9).alias("total"), F.round(F.try_element_at("_k.all", F.lit(1)), 9).alias("largest"),
        ((F.col("v1") >= F.try_element_at("_k.all", F.lit(1)) - 1e-9) & (F.col("v1") + F.col("v2") >= two - 1e-9)
         & (F.col("v1") + F.col("v2") <= F.col("_k.total") + 1e-9)).alias("widest"))
