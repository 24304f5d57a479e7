"""Counting views kept current: after every batch they equal the views of the table."""

import pytest
from pyspark.sql import functions as F

from vacancylens.operators.views import VIEWS
from vacancylens.session import work_folder
from vacancylens.sources.live_views import COUNTED, LiveViews, counts_of
from vacancylens.sources.table import PostingTable
from vacancylens.streaming import ingest

SCHEMA = ("seq long, title string, company string, location string, job_type string, career_level string, "
          "description string, skills array<string>, url string, scraped_at string, date_posted string")


def rows(spark, *postings):
    """(title, company, job type, level, skills) each."""
    return spark.createDataFrame([
        (i, t, c, "Cairo", j, level, "text", s, f"u{i}", "2024-01-20 00:00:00", "today")
        for i, (t, c, j, level, s) in enumerate(postings)], SCHEMA)


def ts(day):
    return F.lit(f"2024-02-0{day} 00:00:00").cast("timestamp_ntz")


BATCHES = [
    [("a", "x", "Full", "Senior", ["sql", "python"]), ("b", "x", "Part", "", ["sql"]), ("c", None, " ", None, None)],
    [("a", "x", "Part", "Junior", ["java"]), ("d", "y", "Full", "Senior", []), ("a", "x", None, None, ["sql"])],
    [("b", "x", "Full", "Senior", None), ("c", None, "Full", "Senior", ["sql", "sql"])],
    [("a", "x", "Full", "Senior", ["sql", "python"])]]


def equal(live):
    table = live.table.read()
    for view in COUNTED:
        got, want = live.read(view), VIEWS[view](table)
        assert got.columns == want.columns and got.collect() == want.collect(), view


@pytest.mark.parametrize("merge_after", [(), (0, 1), (0, 1, 2, 3)])
def test_views_equal_recomputation_after_every_batch(spark, merge_after):
    live = LiveViews(PostingTable(spark, work_folder(spark, "live"), digits=1, buckets=2))
    for i, batch in enumerate(BATCHES):
        assert live.append(rows(spark, *batch), ts(i + 1), ("feed", i)) == i
        assert live.append(rows(spark, *batch), ts(9), ("feed", i)) is None
        if i in merge_after:
            live.compact()
        equal(live)
        if i == 2:
            live.roll_up()
            equal(live)


def test_inactive_rows_count_for_days_only(spark):
    table = spark.createDataFrame([("2024-01-01 00:00:00", "x", "l", "Full", "s", ["a"], "inactive"),
                                   ("2024-01-01 00:00:00", "x", "l", "Full", "s", ["a"], None)],
                                  "date_first_seen string, company string, location string, job_type string, "
                                  "career_level string, skills array<string>, status string")
    assert [tuple(r) for r in counts_of(table).collect()] == [("v_hiring_trends", "2024-01-01", 2)]


def test_a_batch_reads_its_own_prefixes_without_a_shuffle_of_the_base(spark):
    live = LiveViews(PostingTable(spark, work_folder(spark, "live_plan"), digits=1, buckets=2))
    live.append(rows(spark, *BATCHES[0]), ts(1))
    live.compact()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seq = live.table.append(rows(spark, *BATCHES[2][:1]), ts(2))
        plan = live.changes(seq)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(line for line in plan.splitlines() if "Bucketed: true" in line)
    assert "description" not in scan and scan.count("prefix=") <= 2 and "prefix" in scan.split("PartitionFilters")[1]
    above = plan.splitlines()[:plan.splitlines().index(scan)]
    join = max(i for i, line in enumerate(above) if "SortMergeJoin" in line)
    side = [line for line in above[join:] if "Exchange" in line]
    assert len(side) <= 1 and all("hashpartitioning(job_hash" in line for line in side)  # the batch alone


def test_a_table_merged_without_its_views_is_counted_anew(spark):
    live = LiveViews(PostingTable(spark, work_folder(spark, "live_late"), digits=1, buckets=2))
    live.append(rows(spark, *BATCHES[0]), ts(1))
    live.table.append(rows(spark, *BATCHES[1]), ts(2))
    live.table.compact()
    assert live.refresh() == [1]
    equal(live)
    live.append(rows(spark, *BATCHES[2]), ts(3))
    equal(live)


def test_a_stream_keeps_its_views_current(spark):
    folder = work_folder(spark, "live_stream")
    live = LiveViews(PostingTable(spark, f"{folder}/table", digits=1, buckets=2))
    for i, batch in enumerate(BATCHES[:2]):
        rows(spark, *batch).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
        ingest.stream_upsert(stream, live, f"{folder}/state", ts(1)).awaitTermination()
        equal(live)
