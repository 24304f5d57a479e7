"""Pages as streams: meetings in any order, late pages, what the state lets go."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vacancylens.operators.extract import extract_postings
from vacancylens.plans.catalog import PAGE_CARDS, PAGE_POSTING
from vacancylens.session import work_folder
from vacancylens.sources import readers
from vacancylens.streaming.pages import settle_postings, stream_candidates

NOW = "2024-02-01 00:00:00"
SCHEMA = "page_id long, url string, html string, captured_at timestamp"


def listing(n, links, day=1):
    items = "".join(f'<li><a href="/p/{k}">Role {k}</a><span>c{k}, Cairo</span></li>' for k in links)
    return n, f"https://jobs.example.org/list/{n}", f"<nav><ul>{items}</ul></nav>", datetime(2024, 1, day)


def detail(n, k, text, day=1):
    return n, f"https://jobs.example.org/p/{k}", f"<article><h1>Senior {k}</h1><p>{text}</p></article>", datetime(2024, 1, day)


def content(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def run(spark, arrivals, **options):
    """Each arrival is (listings, details); the stream starts anew for each, from one checkpoint."""
    folder = work_folder(spark, "pages")
    progress = []
    for lists, pages in arrivals:
        for name, rows in (("listings", lists), ("details", pages)):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
        streams = [readers.stream_pages(spark, f"{folder}/{name}", at="captured_at") for name in ("listings", "details")]
        query = (stream_candidates(*streams, cards=PAGE_CARDS, details=PAGE_POSTING, **options)
                 .writeStream.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
                 .foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")).start())
        query.awaitTermination()
        progress.append(query.lastProgress)
    return settle_postings(spark.read.parquet(f"{folder}/out"), F.lit(NOW).cast("timestamp")), progress


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_gives_the_batch_result(spark, seed):
    lists = [listing(n, links) for n, links in enumerate([[1, 2, 3], [3, 1, 4], [2, 5], [1, 6]])]
    pages = [detail(n, k, f"text {n}") for n, k in enumerate([1, 2, 3, 1, 4, 2, 7])]  # some captured twice, one unknown
    stamp = F.lit(NOW).cast("timestamp")
    want = extract_postings(spark.createDataFrame(lists, SCHEMA), spark.createDataFrame(pages, SCHEMA), stamp,
                            PAGE_CARDS, PAGE_POSTING)
    random.Random(seed).shuffle(lists)
    random.Random(seed).shuffle(pages)
    got, _ = run(spark, [(lists[2:], pages[:1]), (lists[:2], pages[1:4]), ([], pages[4:])])
    assert content(got) == content(want) and got.count() == 4


def test_late_pages_are_dropped_and_state_is_let_go(spark):
    far = detail(9, 99, "far ahead", 28)
    got, progress = run(spark, [([listing(0, [1, 2], 1)], [detail(0, 1, "in time", 2)]),
                                ([listing(8, [98], 28)], [far]),           # moves both watermarks on
                                ([], [detail(1, 2, "too late", 1)])], apart="5 days", late="1 day")
    assert [r["url"][-1] for r in got.collect()] == ["1"]
    kept = [sum(s.numRowsTotal for s in p.stateOperators) for p in progress]
    assert kept[0] == 3 and kept[-1] == 2  # two cards and a page; later only what is far ahead


def test_pages_apart_do_not_meet(spark):
    got, _ = run(spark, [([listing(0, [1, 2], 1)], [detail(0, 1, "near", 3), detail(1, 2, "far", 9)])], apart="5 days",
                 late="20 days")
    assert [r["url"][-1] for r in got.collect()] == ["1"]


def test_written_time_stands_in_for_a_time_of_capture(spark):
    folder = work_folder(spark, "written")
    spark.createDataFrame([listing(0, [1])[:3]], "page_id long, url string, html string").write.parquet(folder)
    stream = readers.stream_pages(spark, folder, files_per_batch=1)
    assert stream.columns == ["page_id", "url", "html", "captured_at"] and stream.isStreaming
    out = work_folder(spark, "written_out")
    (stream.writeStream.option("checkpointLocation", f"{out}/state").trigger(availableNow=True)
     .foreachBatch(lambda b, n: b.write.mode("append").parquet(f"{out}/rows")).start().awaitTermination())
    at = spark.read.parquet(f"{out}/rows").first()["captured_at"]
    assert abs(datetime.now() - at) < timedelta(days=1)


def test_state_stays_out_of_the_heap_in_any_session(spark, tmp_path, monkeypatch):
    from vacancylens.plans import catalog
    from vacancylens.session import settings
    from vacancylens.streaming import ingest

    class Begun(Exception):
        pass

    def started(*_):
        raise Begun({key: spark.conf.get(key) for key in ingest.LARGE_STATE})

    monkeypatch.setattr(catalog, "_started", started)
    spark.createDataFrame([(1, "http://a.example/b", "<p></p>")], "page_id long, url string, html string").write.parquet(
        f"{tmp_path}/pages.parquet")
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    with settings(spark, dict.fromkeys(ingest.KEYED_STATE, plain)), pytest.raises(Begun) as begun:
        catalog.stream_pages(spark, str(tmp_path))
    assert begun.value.args[0] == ingest.LARGE_STATE and "RocksDB" in str(begun.value)
