"""Sources: posting tables (Parquet, JDBC) and captured pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CAPTURED_PAGE, SCAN_COLUMNS, ensure_columns

# Every column of an active scan that a source may lack.
SCAN_DEFAULTS: dict[str, tuple[str, str | None]] = {
    c: ("string", None) for c in SCAN_COLUMNS
    if c not in ("skills", "date_first_seen", "date_last_seen", "status")} | {
    "salary": ("string", "Not Specified"), "skills": ("array<string>", None)}


def scan_active(postings: DataFrame, ordered: bool = True) -> DataFrame:
    """The 15 report columns of active postings, newest first.

    Filter and projection reach a Parquet or JDBC source.  Reports do not care
    about order: they pass ``ordered=False`` and save a global sort.
    """
    active = (ensure_columns(postings, SCAN_DEFAULTS).filter(F.col("status") == "active")
              .select(*SCAN_COLUMNS))
    return active.orderBy(F.desc("date_first_seen")) if ordered else active


def hash_slices(slices: int) -> list[str]:
    """Conditions on ``job_hash`` that together take every row once, whatever its key.

    Inner bounds are evenly spaced hex keys; the first slice takes what is smaller and
    NULL, the last one what is larger.
    """
    bounds = [format(i * 16 ** 4 // slices, "04x") for i in range(1, slices)]
    if not bounds:
        return ["1 = 1"]
    inner = [f"job_hash >= '{a}' AND job_hash < '{b}'" for a, b in zip(bounds, bounds[1:])]
    return [f"job_hash < '{bounds[0]}' OR job_hash IS NULL", *inner, f"job_hash >= '{bounds[-1]}'"]


def read_postings_jdbc(spark: SparkSession, url: str, table: str = "job_postings", slices: int = 16,
                       **options: str) -> DataFrame:
    """A stored table over JDBC, read in parallel slices of its hash key (at most 65,536)."""
    return spark.read.jdbc(url, table, predicates=hash_slices(slices), properties=options)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages with their declared schema."""
    return spark.read.schema(CAPTURED_PAGE).parquet(path)


def stream_pages(spark: SparkSession, path: str, files_per_batch: int | None = None,
                 at: str | None = None) -> DataFrame:
    """Captured pages as they arrive in a folder, with the time of their capture in ``captured_at``.

    ``at`` names the timestamp column that holds it; without one it is the time the file was written.
    """
    schema = CAPTURED_PAGE if at is None else T.StructType([*CAPTURED_PAGE.fields, T.StructField(at, T.TimestampType())])
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select(*CAPTURED_PAGE.fieldNames(), F.col(
        "_metadata.file_modification_time" if at is None else at).alias("captured_at"))
