"""Reports over the active postings.

Totals and top-k lists enter a plan as scalar subqueries: one value, computed
once, without a join and without a driver round trip.  Wide results name their
columns from an explicit list, which saves the extra job ``pivot`` would run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import NO_SALARY
from ..functions.text import has_text


def value_counts(df: DataFrame, column: str, top: int | None = None, drop_empty: bool = True,
                 out: str = "n") -> DataFrame:
    """Rows per value, most frequent first, ties by value; NULLs never count."""
    keep = has_text(F.col(column)) if drop_empty else F.col(column).isNotNull()
    counts = (df.filter(keep).groupBy(column).agg(F.count("*").alias(out))
              .orderBy(F.desc(out), F.asc(column)))
    return counts if top is None else counts.limit(top)


def preview(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """First ``n`` rows of a total order; plans as one top-n, not as a full sort."""
    return df.orderBy(*order).limit(n)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share in percent, ties to the even digit; NULL for an empty whole."""
    return F.bround(part * 100 / F.nullif(whole, F.lit(0)), digits)


def schema_report(df: DataFrame) -> DataFrame:
    """Column, type and non-null count, from one pass over the data."""
    counts = df.agg(*[F.count(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(df.schema)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"c{i}").alias("non_null"))
        for i, f in enumerate(df.schema)])
    return counts.select(F.inline(rows))


def quality_audit(df: DataFrame) -> DataFrame:
    """Per column: rows, non-null values, empty strings, share of useful values."""
    def empties(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.StringType):
            return F.count_if(F.col(f"`{f.name}`") == "")
        return F.lit(0).cast("bigint")

    counts = df.agg(F.count("*").alias("total"), *[
        F.struct(F.count(f"`{f.name}`").alias("non_null"), empties(f).alias("empty")).alias(f"c{i}")
        for i, f in enumerate(df.schema)])
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.col("total"), F.col(f"c{i}.non_null"),
                 F.col(f"c{i}.empty").alias("empty_strings"))
        for i, f in enumerate(df.schema)])
    return counts.select(F.inline(rows)).withColumn(
        "useful_pct", percent(F.col("non_null") - F.col("empty_strings"), F.col("total")))


def load_summary(active: DataFrame) -> DataFrame:
    """Rows, distinct companies and locations, first and last day."""
    return active.agg(
        F.count("*").alias("jobs"), F.countDistinct("company").alias("companies"),
        F.countDistinct("location").alias("locations"),
        F.min("date_first_seen").alias("first_seen"), F.max("date_first_seen").alias("last_seen"))


def exploded_skills(df: DataFrame, *keep: str) -> DataFrame:
    """One row per non-empty skill, with the columns to keep."""
    return df.select(*keep, F.explode("skills").alias("skill")).filter(has_text(F.col("skill")))


def top_skills(active: DataFrame, top: int = 25) -> DataFrame:
    """Most frequent skills with their share of all active postings."""
    total = active.agg(F.count("*")).scalar()
    return value_counts(exploded_skills(active), "skill", top, out="frequency").withColumn(
        "pct_of_jobs", percent(F.col("frequency"), total))


def skill_stats(active: DataFrame) -> DataFrame:
    """Distinct skills, distinct frequencies, mean skills per posting (empty lists count)."""
    counts = exploded_skills(active).groupBy("skill").agg(F.count("*").alias("n"))
    mean = active.agg(F.avg(F.when(F.col("skills").isNotNull(), F.size("skills")))).scalar()
    return (counts.agg(F.count("*").alias("n_skills"), F.countDistinct("n").alias("n_distinct_frequencies"))
            .withColumn("avg_skills_per_job", mean))


def share_by(df: DataFrame, column: str) -> DataFrame:
    """Counts and shares over the non-empty values of a column.

    The total sums the per-value counts again; adaptive execution reuses their
    shuffle, and no window pulls all values into one task.
    """
    counts = df.filter(has_text(F.col(column))).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share_pct", percent(F.col("n"), total)).orderBy(F.desc("n"), F.asc(column))


def hiring_trend(active: DataFrame) -> DataFrame:
    """New postings per present day and their running total.

    The window has no partition key, but it sees one row per calendar day.
    """
    daily = (active.filter(F.col("date_first_seen").isNotNull())
             .groupBy(F.to_date("date_first_seen").alias("day")).agg(F.count("*").alias("new_jobs")))
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("total_jobs", F.sum("new_jobs").over(running)).orderBy("day")


def trend_stats(active: DataFrame) -> DataFrame:
    """First day, last day and mean postings per present day."""
    daily = (active.filter(F.col("date_first_seen").isNotNull())
             .groupBy(F.to_date("date_first_seen").alias("day")).agg(F.count("*").alias("n")))
    return daily.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"),
                     F.avg("n").alias("avg_jobs_per_day"))


def has_salary(c: Column) -> Column:
    """A salary text that says something."""
    return c.isNotNull() & ~c.isin(*NO_SALARY)


def salary_coverage(active: DataFrame) -> DataFrame:
    """Postings with and without a salary text."""
    n = active.agg(F.count("*").alias("total"), F.count_if(has_salary(F.col("salary"))).alias("with_salary"))
    return n.select("total", "with_salary", (F.col("total") - F.col("with_salary")).alias("without_salary"),
                    percent(F.col("with_salary"), F.col("total")).alias("pct"))


def salary_sample(active: DataFrame, order: Sequence[Column | str], n: int = 15) -> DataFrame:
    """Title, company and salary of the first ``n`` postings with a salary text."""
    return preview(active.filter(has_salary(F.col("salary"))), order, n).select("title", "company", "salary")


def _top_list(counts: DataFrame, column: str) -> Column:
    """The values of a short ranked list as one sorted array (a scalar subquery)."""
    return counts.agg(F.sort_array(F.collect_list(column))).scalar()


def skill_cooccurrence(active: DataFrame, top: int = 15) -> DataFrame:
    """How often two of the top skills stand in one posting; symmetric and dense.

    Only postings with two or more skills count, for the ranking too.  Postings
    are first counted per *set* of top skills, so pairs are made once per set
    (at most 2^top of them), not once per posting.
    """
    multi = active.filter(F.size("skills") >= 2)
    ranked = value_counts(multi.select(F.explode("skills").alias("skill")), "skill", top, drop_empty=False)
    sets = (multi.select("skills").withColumn("_top", _top_list(ranked, "skill"))
            .select(F.array_sort(F.expr("filter(skills, s -> array_contains(_top, s))")).alias("s"))
            .filter(F.size("s") >= 2).groupBy("s").agg(F.count("*").alias("n")))
    left = sets.select("s", "n", F.posexplode("s").alias("i", "skill_1"))
    pairs = left.select("n", "i", "skill_1", F.posexplode("s").alias("j", "skill_2")).filter("i <> j")
    counts = pairs.groupBy("skill_1", "skill_2").agg(F.sum("n").alias("n"))
    # Every cell once with weight 0: the frame of the dense top x top result.
    # It is made from the list the postings were reduced by, so the ranking runs once.
    frame = (active.sparkSession.range(1).select(_top_list(ranked, "skill").alias("_top"))
             .select("_top", F.explode("_top").alias("skill_1"))
             .select("skill_1", F.explode("_top").alias("skill_2"), F.lit(0).cast("bigint").alias("n")))
    dense = counts.unionByName(frame).groupBy("skill_1", "skill_2").agg(F.sum("n").alias("n"))
    # A skill listed twice in a posting pairs with itself in both directions.
    return dense.orderBy("skill_1", "skill_2")


def cooccurrence_matrix(active: DataFrame, skills: Sequence[str] | None = None, top: int = 15) -> DataFrame:
    """Wide form; ``skills`` names the columns, by default the top skills.

    The default reads the ``top`` names first, the one small job a wide result
    cannot do without.
    """
    if skills is None:
        multi = active.filter(F.size("skills") >= 2).select(F.explode("skills").alias("skill"))
        skills = sorted(r["skill"] for r in value_counts(multi, "skill", top, drop_empty=False).collect())
    return (skill_cooccurrence(active, top).groupBy("skill_1").pivot("skill_2", list(skills))
            .agg(F.first("n")).orderBy("skill_1"))


def skill_by_level(active: DataFrame, top: int = 10) -> DataFrame:
    """Top skills by career level, zero-filled, in long form."""
    base = exploded_skills(active.filter(has_text(F.col("career_level"))), "career_level")
    cells = base.groupBy("skill", "career_level").agg(F.count("*").alias("n"))
    ranked = (cells.groupBy("skill").agg(F.sum("n").alias("total"))
              .orderBy(F.desc("total"), F.asc("skill")).limit(top))
    kept = cells.join(F.broadcast(ranked.select("skill")), "skill", "left_semi")  # at most `top` rows
    # Every level once per top skill with weight 0; only the short skill list is collected.
    frame = (kept.select("career_level").distinct().withColumn("_top", _top_list(ranked, "skill"))
             .select(F.explode("_top").alias("skill"), "career_level", F.lit(0).cast("bigint").alias("n")))
    return (kept.unionByName(frame).groupBy("skill", "career_level").agg(F.sum("n").alias("n"))
            .orderBy("skill", "career_level"))


def skill_level_crosstab(active: DataFrame, levels: Sequence[str] | None = None, top: int = 10) -> DataFrame:
    """Wide form of ``skill_by_level``: one column per level of the data, or per named level."""
    if levels is None:
        levels = [v for v in career_levels(active.filter(F.size("skills") > 0)) if v]
    return (skill_by_level(active, top).groupBy("skill").pivot("career_level", list(levels))
            .agg(F.first("n")).na.fill(0).orderBy("skill"))


def kpi_summary(active: DataFrame) -> DataFrame:
    """The closing totals in one row."""
    skills = exploded_skills(active).groupBy("skill").agg(F.count("*").alias("n"))
    skill_kpis = skills.agg(F.struct(
        F.count("*").alias("n_skills"), F.countDistinct("n").alias("n_freq"))).scalar()
    row = active.agg(
        F.count("*").alias("jobs"), F.countDistinct("company").alias("companies"),
        F.countDistinct("location").alias("locations"),
        F.count_if(has_salary(F.col("salary"))).alias("with_salary"),
        F.count_if(has_text(F.col("career_level"))).alias("with_career_level"))
    return row.withColumn("_s", skill_kpis).select(
        "jobs", "companies", "locations", F.col("_s.n_skills").alias("skills"),
        F.col("_s.n_freq").alias("distinct_skill_frequencies"),
        "with_salary", percent(F.col("with_salary"), F.col("jobs")).alias("salary_pct"),
        "with_career_level", percent(F.col("with_career_level"), F.col("jobs")).alias("career_level_pct"))


def level_column(level: str) -> str:
    """Name of the count column of a career level."""
    return f"level_{level}"


def career_levels(active: DataFrame) -> list[str]:
    """All career levels, '' included: the columns of a wide result, so the driver has to know them."""
    rows = active.filter(F.col("career_level").isNotNull()).select("career_level").distinct().collect()
    return sorted(r[0] for r in rows)


def level_counts(active: DataFrame) -> DataFrame:
    """(company, career_level, n): the same counts in long form, for any number of levels."""
    return (active.filter(F.col("company").isNotNull() & F.col("career_level").isNotNull())
            .groupBy("company", "career_level").agg(F.count("*").alias("n")))


def company_features(active: DataFrame, levels: Sequence[str] | None = None) -> DataFrame:
    """Per company: titles and one count per career level, in one aggregation."""
    levels = career_levels(active) if levels is None else levels
    return active.filter(F.col("company").isNotNull()).groupBy("company").agg(
        F.count("title").alias("total_jobs"),
        *[F.count_if(F.col("career_level") == v).alias(level_column(v)) for v in levels])


def min_volume(features: DataFrame, least: int = 3) -> DataFrame:
    """Companies with enough postings to segment."""
    return features.filter(F.col("total_jobs") >= least)


def scale_features(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """z-scores with the population deviation; a constant column becomes 0."""
    stats = df.agg(F.struct(*[
        F.struct(F.avg(f"`{c}`").alias("mean"), F.stddev_pop(f"`{c}`").alias("std")).alias(f"c{i}")
        for i, c in enumerate(columns)])).scalar()
    scaled = {
        f"{c}{suffix}": F.coalesce(
            (F.col(f"`{c}`") - F.col(f"_stats.c{i}.mean")) / F.nullif(F.col(f"_stats.c{i}.std"), F.lit(0.0)),
            F.lit(0.0))
        for i, c in enumerate(columns)}
    return df.withColumn("_stats", stats).withColumns(scaled).drop("_stats")
