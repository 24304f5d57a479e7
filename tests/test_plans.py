"""The plans are the ones the operators promise."""

import re

from pyspark.sql import functions as F

from vacancylens.functions.skills import tag_skills
from vacancylens.operators import analytics as A
from vacancylens.operators import clean, clusters, dedup, extract, upsert, views
from vacancylens.plans import catalog
from vacancylens.sources.readers import scan_active
from vacancylens.session import work_folder

import pytest


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark):
    path = work_folder(spark, "plans")
    rows = [(f"h{i}", "t", f"c{i % 3}", "x, y", "1", "Full", "s", "l", ["a", "b"], "active") for i in range(20)]
    (spark.createDataFrame(rows, "job_hash string, title string, company string, location string, experience string, "
                                 "job_type string, salary string, career_level string, skills array<string>, status string")
     .withColumns({c: F.lit("2024-01-01").cast("timestamp_ntz") for c in ("date_first_seen", "date_last_seen")})
     .write.parquet(path))
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def raw(spark):
    path = work_folder(spark, "plans_raw")
    (spark.range(20).select(F.col("id").alias("seq"), *[F.lit("some text").alias(c) for c in (
        "title", "company", "location", "description", "url", "date_posted", "scraped_at")]).write.parquet(path))
    return spark.read.parquet(path)


def test_filters_and_columns_reach_the_scan(table):
    plan = plan_of(views.skill_frequency(table))
    assert "EqualTo(status,active)" in plan
    assert re.search(r"ReadSchema: struct<skills:array<string>,status:string>", plan)
    plan = plan_of(views.top_companies(scan_active(table, ordered=False)))
    assert "EqualTo(status,active)" in plan and "ReadSchema: struct<company:string,status:string>" in plan


def test_only_the_scan_itself_sorts_everything(table):
    assert "rangepartitioning" in plan_of(scan_active(table))
    assert "rangepartitioning" not in plan_of(scan_active(table, ordered=False))
    assert "TakeOrderedAndProject" in plan_of(A.preview(table, ["job_hash"]))
    assert "TakeOrderedAndProject" in plan_of(A.value_counts(table, "company", 5))


def test_first_row_rules_limit_groups_before_the_shuffle(raw):
    for df in (dedup.dedup_url(raw), dedup.dedup_key(raw)):
        assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*WindowGroupLimit[^\n]*Partial", plan_of(df))


def test_folding_combines_before_the_shuffle(raw):
    rows = tag_skills(clean.clean_postings(raw))
    plan = plan_of(upsert.upsert_postings(None, rows, F.lit("2024-01-01").cast("timestamp_ntz")))
    assert plan.count("Exchange") == 1 and plan.count("partial_min_by") == 1


def test_rejects_find_copies_on_two_columns(raw):
    plan = plan_of(clean.label_rejects(raw))
    assert "Window" not in plan and "partial_min" in plan
    # What is shuffled or broadcast for the flag never holds a description.
    for line, below in re.findall(r"((?:Broadcast)?Exchange[^\n]*)\n([^\n]*)", plan):
        assert "description" not in below


def test_no_query_uses_a_cartesian_product_or_row_python(spark):
    folder = "/root/testdata/sf0.001"
    fits = {"role_clusters", "cluster_terms", "pca_2d", "pca_sparse", "company_segments", "segment_plot_data"}
    writes = {n for n in catalog.queries() if n.startswith(("stream_", "csv_", "upsert_sink", "ingest_pages", "live_views"))}
    for name, query in catalog.queries().items():
        if name in fits | writes:
            continue
        plan = plan_of(query(spark, folder))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_tfidf_shuffles_only_the_vocabulary(table):
    plan = clusters.tfidf_skills(table)._jdf.queryExecution().executedPlan()
    main = plan.toString().split("Subquery")[0]
    assert "Exchange hashpartitioning" not in main


def test_no_page_is_shuffled(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = plan_of(extract.extract_postings(pages, pages, cards=catalog.PAGE_CARDS, details=catalog.PAGE_POSTING))
    assert plan.count("MapInArrow") == 2
    for shuffled in re.findall(r"Exchange[^\n]*\n[^\n]*", plan):
        assert "html" not in shuffled


def test_pages_are_read_once(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = plan_of(extract.card_fields(extract.extract_cards(pages)))
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan
