"""Session defaults and the shared working folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that hold at any scale.  Adaptive execution merges small shuffle
# partitions and splits skewed join partitions; it never adds partitions to an
# aggregation, so a large input must ask for enough of them (see below).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Pages are large: few rows per Arrow batch keep a Python worker small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    # Streaming state outgrows the heap long before it outgrows local disks.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A join has four stores in each partition: together they take this much of an executor, not each its own.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
}


def shuffle_partitions(input_bytes: int, per_task: int = 256 << 20) -> int:
    """Shuffle partitions for an input of a size: about ``per_task`` bytes each, 200 at least."""
    return max(200, -(-input_bytes // per_task))


def build_session(app: str = "vacancylens", master: str | None = None, input_bytes: int | None = None,
                  **extra: str) -> SparkSession:
    """A session with ``DEFAULTS``; ``extra`` keys use ``__`` for dots.

    ``input_bytes`` sizes the shuffles; keep it for a stream, whose state stays on
    the partitions it started with.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {} if input_bytes is None else {"spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes))}
    for key, value in {**DEFAULTS, **sized, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the writes inside; what was set before comes back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@lru_cache(maxsize=8)
def _ship(application_id: str) -> None:
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="vacancylens-zip-")) / package.name), "zip",
                                  package.parent, package.name)
    SparkSession.active().sparkContext.addPyFile(archive)


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per application.

    Page extraction runs in workers that may have neither it nor its folder.
    """
    _ship(spark.sparkContext.applicationId)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    A cluster must set that key.  Only a local session (tests) falls back to a
    machine-local temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="vacancylens-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
