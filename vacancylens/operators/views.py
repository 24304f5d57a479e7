"""The nine reporting views over the posting table.

Order is by count and then by name, so that ties have one answer.  Skill and
job-type views filter before they explode; the filters reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_text


def _active(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == "active")


def _count_by(df: DataFrame, column: str, out: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(out)).orderBy(F.desc(out), F.asc(column))


def job_types_expanded(postings: DataFrame) -> DataFrame:
    """One row per comma part of the job type, blank parts included."""
    return (_active(postings).filter(has_text(F.col("job_type")))
            .select("job_hash", F.explode(F.split("job_type", ",")).alias("part"))
            .select("job_hash", F.trim("part").alias("job_type_individual")))


def job_skills_expanded(postings: DataFrame) -> DataFrame:
    """Bridge table of postings and skills."""
    return _active(postings).select("job_hash", F.explode("skills").alias("skill"))


def skill_frequency(postings: DataFrame) -> DataFrame:
    return _count_by(_active(postings).select(F.explode("skills").alias("skill")), "skill", "frequency")


def hiring_trends(postings: DataFrame) -> DataFrame:
    """New postings per day, whatever their status."""
    return (postings.groupBy(F.to_date("date_first_seen").alias("scrape_date"))
            .agg(F.count("*").alias("new_jobs")).orderBy("scrape_date"))


def top_companies(postings: DataFrame) -> DataFrame:
    return _count_by(_active(postings), "company", "open_positions")


def _breakdown(column: str) -> Callable[[DataFrame], DataFrame]:
    def view(postings: DataFrame) -> DataFrame:
        return _count_by(_active(postings).filter(has_text(F.col(column))), column, "count")
    return view


job_type_breakdown = _breakdown("job_type")
career_level_distribution = _breakdown("career_level")
location_distribution = _breakdown("location")


def location_hierarchy(postings: DataFrame) -> DataFrame:
    """Country, city and area of each distinct location text.

    Distinct comes first: the parsing then runs once per text, not per posting.
    """
    def level(k: int):
        return F.trim(F.try_element_at("parts", F.lit(-k)))

    return (_active(postings).filter(has_text(F.col("location"))).select("location").distinct()
            .withColumn("parts", F.split("location", ","))
            .select("location", level(1).alias("country"),
                    F.coalesce(level(2), F.lit("Unknown")).alias("city"),
                    F.coalesce(level(3), F.lit("Unknown")).alias("area")))


VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "v_job_types_expanded": job_types_expanded,
    "v_job_skills_expanded": job_skills_expanded,
    "v_skill_frequency": skill_frequency,
    "v_hiring_trends": hiring_trends,
    "v_top_companies": top_companies,
    "v_job_type_breakdown": job_type_breakdown,
    "v_career_level_distribution": career_level_distribution,
    "v_location_distribution": location_distribution,
    "v_location_hierarchy": location_hierarchy,
}


def register_views(postings: DataFrame) -> None:
    """Make the table and all views known to ``spark.sql`` under their names."""
    postings.createOrReplaceTempView("job_postings")
    for name, view in VIEWS.items():
        view(postings).createOrReplaceTempView(name)
