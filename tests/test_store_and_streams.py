"""CSV files, the posting table, and streams against their batch twins."""

from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from vacancylens.config import CleanConfig
from vacancylens.functions.skills import tag_skills
from vacancylens.operators import clean, dedup, upsert
from vacancylens.operators.views import hiring_trends
from vacancylens.schema import CSV_COLUMNS
from vacancylens.session import work_folder
from vacancylens.sources import csv_files
from vacancylens.sources.table import PostingTable
from vacancylens.streaming import ingest

NOW = "2024-02-01 00:00:00"


def ts(s=NOW):
    return F.lit(s).cast("timestamp_ntz")


def feed(spark, n=40):
    rows = [(i, f"Role {i % 7} of data", f"c{i % 3}", "Cairo", f"u{i % 11}", f"python {i}", f"{i} days ago",
             "2024-01-20 00:00:00") for i in range(n)]
    return spark.createDataFrame(rows, "seq long, title string, company string, location string, url string, "
                                       "description string, date_posted string, scraped_at string")


def content(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def files(df, folder, parts=4):
    n = df.count()
    for i in range(parts):
        df.filter(F.col("seq").between(i * n // parts, (i + 1) * n // parts - 1)).coalesce(1) \
            .write.mode("append").parquet(folder)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(stream, folder, mode="append"):
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state")
             .trigger(availableNow=True))
    query = query.foreachBatch(lambda b, n: b.write.mode("overwrite" if mode == "complete" else "append")
                               .parquet(f"{folder}/out")).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def test_csv_backup_appends_and_keeps_hard_texts(spark):
    folder = work_folder(spark, "csv")
    hard = ['a "quoted", text\nwith a second line\r\nand é \\ ', "", None, "\\N", "\\\\N", "\\N ", '""', " ", "N", '"\\N"']
    df = spark.createDataFrame([(i, "Role of data", "u", t) for i, t in enumerate(hard)],
                               "seq long, title string, url string, description string").withColumn("extra", F.lit(1))
    tagged = clean.stamp_scraped(df, ts())
    csv_files.csv_backup(tagged, folder, "2024-02-01", rows_per_file=1)
    csv_files.csv_backup(tagged, folder, "2024-02-01")
    csv_files.csv_backup(tagged, folder, "2024-02-02")
    back = csv_files.read_csv(spark, f"{folder}/run_date=2024-02-01")
    assert back.columns == list(CSV_COLUMNS)
    assert sorted(map(str, (r["description"] for r in back.collect()))) == sorted(map(str, hard * 2))
    first = spark.read.text(f"{folder}/run_date=2024-02-02").first()[0]
    assert first == ",".join(CSV_COLUMNS)


def test_csv_snapshot_overwrites(spark):
    folder = work_folder(spark, "snap")
    df = feed(spark, 3).withColumns({"skills": F.array(F.lit("a"), F.lit("b")), "status": F.lit("active")})
    path = csv_files.csv_snapshot(df, folder, "2024-02-01")
    assert csv_files.csv_snapshot(df.limit(2), folder, "2024-02-01") == path
    rows = csv_files.read_csv(spark, path, csv_files.SCAN_COLUMNS).collect()
    assert len(rows) == 2 and rows[0]["skills"] == "a, b" and rows[0]["salary"] is None


def store_at(spark, name):
    return PostingTable(spark, work_folder(spark, name), digits=1, buckets=3)


def tagged(df):
    return tag_skills(clean.clean_postings(df))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_equals_the_plain_upsert(spark):
    rows = tagged(feed(spark))
    parts = [rows.filter(F.col("seq").between(a, a + 9)) for a in (0, 10, 20, 30)]
    store = store_at(spark, "store")
    assert store.read().count() == 0 and store.compact() == 0
    want = None
    for i, part in enumerate(parts):
        now = ts(f"2024-02-0{i + 1} 00:00:00")
        want = upsert.upsert_postings(want, part, now)
        assert store.append(part, now, ("feed", i)) == i
        assert store.append(part, ts("2030-01-01 00:00:00"), ("feed", i)) is None  # a repeated batch does no harm
        assert content(store.read()) == content(want)
        if i == 1:
            assert store.compact() == 2
            assert content(store.read()) == content(want)
    store.append(parts[0], ts("2030-01-01 00:00:00"), ("feed", 0))  # merged long ago
    assert content(store.read()) == content(want)
    assert store.compact() == 2 and store.compact() == 0
    assert content(store.read()) == content(want)
    store.forget()
    again = PostingTable(spark, store.root, digits=1, buckets=3)  # another session finds what is there
    assert content(again.read()) == content(want)


def test_batch_names(spark):
    """Numbers that start again, come out of order or without a name lose nothing."""
    rows = tagged(feed(spark, 20)).withColumn("title", F.concat("title", F.col("seq").cast("string")))
    one = [rows.filter(F.col("seq") == i) for i in range(6)]
    store = store_at(spark, "names")
    store.upsert(one[0], ts(), ("a", 5))
    store.upsert(one[1], ts(), ("b", 5))  # another source, the same number
    store.upsert(one[2], ts(), ("a", 3))  # arrives after a later one was merged
    store.append(one[3], ts())            # nameless batches are always stored
    store.append(one[3], ts())
    store.append(one[4], ts(), ("a", 4))
    assert store.upsert(one[5], ts(), ("a", 3)).count() == 5  # the same batch again, whatever it holds
    assert sorted(map(tuple, store.batches().filter("source IS NOT NULL").collect())) == [
        (0, "a", 5), (1, "b", 5), (2, "a", 3), (5, "a", 4)]


def test_long_fields_are_stored_or_rejected_with_a_reason(spark):
    rows = tagged(feed(spark, 9)).withColumn(
        "company", F.when(F.col("seq") < 3, F.repeat(F.lit("x"), F.lit(300))).otherwise(F.col("company")))
    assert store_at(spark, "long").upsert(rows, ts()).filter("length(company) = 300").count() == 3
    strict = store_at(spark, "strict")
    assert strict.upsert(rows, ts(), cfg=CleanConfig(enforce_lengths=True)).filter("length(company) = 300").count() == 0
    lost = spark.read.parquet(f"{strict.root}/rejects")
    assert [r[0] for r in lost.select("reject_reason").collect()] == ["too_long:company"] * 3


def test_only_touched_prefixes_are_rewritten(spark):
    rows = tagged(feed(spark))
    store = store_at(spark, "prefixes")
    table = store.upsert(rows, ts())
    before, hashes = set(store.base().inputFiles()), content(table.select("job_hash"))
    one = table.limit(1).collect()[0]
    again = rows.filter((F.col("title") == one["title"]) & (F.col("company") == one["company"]))
    after = store.upsert(again, ts("2024-03-01 00:00:00"))
    assert {f.split("prefix=")[1][0] for f in before ^ set(store.base().inputFiles())} == {one["job_hash"][:1]}
    assert after.count() == table.count() and content(after.select("job_hash")) == hashes
    assert after.filter("date_last_seen > date_first_seen").count() == 1


def test_prefixes_can_be_merged_in_groups(spark):
    rows = tagged(feed(spark))
    store = PostingTable(spark, work_folder(spark, "groups"), digits=1, buckets=2, group=3)
    for i in range(2):
        store.append(rows.filter(F.col("seq") % 2 == i), ts(f"2024-02-0{i + 1} 00:00:00"))
    want = content(store.read())
    assert store.compact() == 2 and content(store.read()) == want


def test_steps_that_died_are_repeated_without_harm(spark):
    store, rows = store_at(spark, "torn"), tagged(feed(spark, 12))
    store.append(rows.filter("seq < 8"), ts())
    before = content(store.read())
    rows.limit(1).select("title").write.parquet(f"{store.root}/deltas/seq=1")  # written, its batch never named
    assert content(store.read()) == before
    store.append(rows.filter("seq >= 4"), ts("2024-02-02 00:00:00"), ("a", 0))  # takes that number
    want = content(store.read())
    store.compact()
    spark.createDataFrame([(-1,)], "seq long").coalesce(1).write.mode("overwrite").parquet(f"{store.root}/merged")
    assert store.waiting().count() == 2  # as if the merge had died before it was noted
    assert content(store.read()) == want
    assert store.compact() == 2 and content(store.read()) == want


def test_merging_shuffles_the_batch_only(spark):
    store, rows = store_at(spark, "plan"), tagged(feed(spark))
    store.upsert(rows, ts())
    store.append(rows, ts("2024-02-02 00:00:00"))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"  # put back
    plan = plan_of(store.merged([1], ["0", "1", "2"]))
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan
    base = plan[plan.index("SortMergeJoin"):].split("FileScan")[1]
    assert "Bucketed: true" in base and "PartitionFilters: [prefix" in base
    assert "Exchange" not in plan[:plan.index("Bucketed: true")]


def test_stream_clean_equals_batch(spark):
    folder = work_folder(spark, "s_clean")
    df = feed(spark)
    stream = ingest.stream_clean(files(df, f"{folder}/in"), run_ts=ts())
    assert content(run(stream, folder)) == content(tag_skills(clean.clean_postings(df, run_ts=ts())))


def test_stream_dedup_keeps_the_first_row_of_each_url(spark):
    df = feed(spark).repartition(4)
    folder = work_folder(spark, "s_dedup_first")
    out = run(ingest.stream_dedup(files(df, f"{folder}/in", 2)), folder)
    assert content(out.select(df.columns)) == content(dedup.dedup_url(df).select(df.columns))


def test_stream_dedup_remembers_urls_only(spark):
    sizes = {}
    for chars in (10, 20_000):
        df = feed(spark).withColumn("description", F.array_join(F.transform(
            F.sequence(F.lit(1), F.lit(chars // 10)), lambda i: F.substring(F.md5(F.concat("url", i.cast("string"))), 1, 10)), ""))
        folder = work_folder(spark, "s_dedup_state")
        assert run(ingest.stream_dedup(files(df, f"{folder}/in", 1)), folder).count() == 11
        sizes[chars] = sum(p.stat().st_size for p in Path(f"{folder}/state/state").rglob("*") if p.is_file())
    assert sizes[20_000] < sizes[10] + 11 * 200  # 11 descriptions of 20,000 characters would show


def test_stream_dedup_forgets_by_a_timer(spark):
    def day(n, url, seq):
        return seq, url, datetime(2024, 1, n)
    schema = "seq long, url string, at timestamp"
    folder = work_folder(spark, "s_dedup_timer")
    for rows in ([day(1, "a", 1), day(1, "b", 2), day(1, None, 3)], [day(2, "a", 4), day(9, "c", 5), day(2, None, 6)],
                 [day(9, "a", 7), day(9, "c", 8), day(1, "late", 9)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        out = run(ingest.stream_dedup(stream, watermark="at", delay="1 day", forget=timedelta(days=3)), folder)
    # a comes again a week later; c is still known; "late" lies before the watermark.
    assert sorted(r["seq"] for r in out.collect()) == [1, 2, 3, 5, 7]


def test_copies_of_a_hot_url_are_thinned_before_the_shuffle(spark):
    rows = spark.range(1000).select((1000 - F.col("id")).alias("seq"), F.lit("hot").alias("url")).coalesce(1)
    kept = ingest.thin(rows, "url", "seq").collect()
    assert len(kept) <= 3 and min(r["seq"] for r in kept) == 1
    pair = spark.createDataFrame([((2, 1), "u"), ((1, 9), "u"), (None, "v"), ((1, 1), "v")],
                                 "seq struct<a: long, b: long>, url string").coalesce(1)
    assert sorted((r["url"], r["seq"] and tuple(r["seq"])) for r in ingest.thin(pair, "url", "seq").collect()) == [
        ("u", (1, 9)), ("v", None)]


def test_stream_dedup_within_a_watermark(spark):
    df = feed(spark).withColumn("at", F.to_timestamp("scraped_at"))
    folder = work_folder(spark, "s_dedup_within")
    out = run(ingest.stream_dedup_within(files(df, f"{folder}/in"), "at", salts=4), folder)
    assert sorted(r["url"] for r in out.select("url").collect()) == sorted(
        r["url"] for r in dedup.dedup_url(df).select("url").collect())


def test_stream_upsert_equals_one_batch(spark):
    df = feed(spark)
    want = upsert.upsert_postings(None, tag_skills(clean.clean_postings(df, run_ts=ts())), ts())
    for every in (100, 2):
        folder = work_folder(spark, "s_upsert")
        store = PostingTable(spark, f"{folder}/store", digits=1, buckets=3)
        stream = ingest.stream_clean(files(df, f"{folder}/in"), run_ts=ts())
        ingest.stream_upsert(stream, store, f"{folder}/state", ts(), compact_every=every).awaitTermination()
        assert content(store.read()) == content(want)
        ingest.stream_upsert(stream, store, f"{folder}/state", ts()).awaitTermination()  # nothing new
        store.compact()
        assert content(store.read()) == content(want)
    # A new checkpoint numbers from 0 again and is another source: its rows are stored.
    more = df.withColumn("title", F.concat(F.lit("Other "), "title"))
    other = work_folder(spark, "s_upsert_more")
    ingest.stream_upsert(ingest.stream_clean(files(more, f"{other}/in"), run_ts=ts()), store, f"{other}/state",
                         ts()).awaitTermination()
    assert store.read().count() == 2 * want.count()


def test_stream_trend_equals_view(spark):
    folder = work_folder(spark, "s_trend")
    df = feed(spark).select("seq", F.to_timestamp_ntz(
        F.concat(F.lit("2024-01-0"), (F.col("seq") % 5 + 1).cast("string"), F.lit(" 01:00:00"))).alias("date_first_seen"))
    assert content(run(ingest.stream_trend(files(df, f"{folder}/in")), folder, "complete")) == \
        content(hiring_trends(df))
