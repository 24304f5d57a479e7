"""The ingest as a stream; every stage is the batch operator or its stateful twin."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..config import SKILLS, CleanConfig
from ..functions.skills import tag_skills
from ..operators.clean import clean_postings
from ..session import DEFAULTS, ship_package
from ..sources.live_views import LiveViews
from ..sources.table import PostingTable


def stream_clean(raw: DataFrame, cfg: CleanConfig = CleanConfig(), skills: Mapping[str, str] = SKILLS,
                 run_ts: Column | None = None) -> DataFrame:
    """Clean and tag; stateless."""
    return tag_skills(clean_postings(raw, cfg, run_ts), skills)


# Keyed state needs this store; ``build_session`` sets it for all streams.
KEYED_STATE = {key: DEFAULTS[key] for key in ("spark.sql.streaming.stateStore.providerClass",)}
# State that grows with the input stays out of the heap, and all stores of an executor share one allowance.
LARGE_STATE = KEYED_STATE | {key: DEFAULTS[key] for key in ("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage",
                                                            "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB")}


def _rank(value: object) -> tuple:
    """Sort key of an order value: NULL first, structs by their fields."""
    if value is None:
        return (False,)
    return True, tuple(value.values()) if isinstance(value, dict) else value


def thin(df: DataFrame, key: str, order: str) -> DataFrame:
    """The smallest ``order`` of each key of every Arrow batch.

    Stateless: a key that fills a third of a stream leaves each batch once, before anything is shuffled.
    """
    ship_package(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[object, tuple] = {}
            for i, (name, value) in enumerate(zip(batch.column(key).to_pylist(), batch.column(order).to_pylist())):
                rank = _rank(value)
                if name not in best or rank < best[name][0]:
                    best[name] = rank, i
            yield batch if len(best) == batch.num_rows else batch.take(pa.array(sorted(i for _, i in best.values())))

    return df.mapInArrow(task, df.schema)


def first_row(order: str, at: str | None, forget: int) -> StatefulProcessor:
    """Lets the first row of a key through and remembers that it was there, nothing else of it.

    The class travels by value: the process that prepares the state may not have this package.
    """
    class FirstRow(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle, self.seen = handle, handle.getValueState("seen", "there boolean")

        def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
            first = min(rows, key=lambda r: (r[order] is not None, r[order]))
            if not self.seen.exists():
                self.seen.update((True,))
                if at is not None and first[at] is not None:
                    self.handle.registerTimer(int(first[at].timestamp() * 1000) + forget)
                yield first

        def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
            self.seen.clear()
            return iter(())

        def close(self) -> None:
            pass

    return FirstRow()


def stream_dedup(postings: DataFrame, order: str = "seq", watermark: str | None = None, delay: str = "1 day",
                 forget: timedelta = timedelta(days=14)) -> DataFrame:
    """First row per URL for the whole stream, with all columns; *append* mode.

    A URL's row is the one with the smallest ``order`` of the first micro-batch that held it.  The
    state of a URL is the URL, whatever its rows hold.  Copies of a hot URL are thinned out by the
    tasks that read them.  With a ``watermark`` column (a timestamp) rows more than ``delay`` late
    are dropped, and a URL is forgotten ``forget`` after its first row: one that comes later is new.
    The session needs the settings of ``KEYED_STATE``.
    """
    keyed = thin(postings.withColumn("url", F.coalesce("url", F.lit(""))), "url", order)
    if watermark is not None:
        keyed = keyed.withWatermark(watermark, delay)
    first = first_row(order, watermark, int(forget.total_seconds() * 1000))
    return keyed.groupBy("url").transformWithState(first, keyed.schema, "Append", "None" if watermark is None else "EventTime")


def stream_dedup_within(postings: DataFrame, watermark: str, delay: str = "14 days", salts: int = 16,
                        spread: str = "seq") -> DataFrame:
    """One row per URL, forgotten ``delay`` after it was seen; rows that late are dropped.

    The state holds keys only.  Copies are first dropped per (URL, salt), the salt coming
    from ``spread``, so at most ``salts`` of them reach the task that owns the URL.  Which copy
    of one micro-batch stays is open.
    """
    keyed = (postings.withColumn("url", F.coalesce("url", F.lit(""))).withWatermark(watermark, delay)
             .withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts))))
    return (keyed.dropDuplicatesWithinWatermark(["url", "_salt"]).drop("_salt")
            .dropDuplicatesWithinWatermark(["url"]))


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a stream wrote into its checkpoint when it first started."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()[0]


def stream_upsert(postings: DataFrame, store: PostingTable | LiveViews, checkpoint: str, run_ts: Column | None = None,
                  cfg: CleanConfig = CleanConfig(), order: str = "seq", compact_every: int = 100) -> StreamingQuery:
    """Store each micro-batch once; stops when all present input is stored.

    A micro-batch is named by the id that its checkpoint was given and its number there, so
    a stream that starts again from a new checkpoint is a new source.  ``availableNow`` suits
    a scheduled run.  Call ``store.compact()`` after it; a long run also compacts every so
    many batches, which bounds what a reader merges.  With ``LiveViews`` as the store its views are
    current after every micro-batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        now = F.current_timestamp() if run_ts is None else run_ts
        source = checkpoint_id(batch.sparkSession, checkpoint)
        store.append(batch, now, (source, batch_id), cfg, order)
        if (batch_id + 1) % compact_every == 0:
            store.compact()

    return (postings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_trend(postings: DataFrame) -> DataFrame:
    """New postings per day, kept current (complete or update mode)."""
    return (postings.groupBy(F.to_date("date_first_seen").alias("scrape_date"))
            .agg(F.count("*").alias("new_jobs")))
