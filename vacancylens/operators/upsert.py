"""Upsert by ``job_hash``: fold a batch, then merge it into the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CleanConfig
from ..schema import POSTING, ensure_columns
from .clean import constraint_guard
from .dedup import job_hash

# Set once, by the first row of a hash.
KEPT = ("title", "company", "location", "date_posted", "keywords", "url", "date_first_seen")
# Set by every later row of the hash, NULLs included.
REFRESHED = ("experience", "job_type", "salary", "career_level", "description", "skills",
             "historical_date", "date_last_seen", "status")


def prepare_batch(df: DataFrame, run_ts: Column, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Cleaned, tagged rows -> storable rows with hash, times and status."""
    rows = ensure_columns(df)
    if cfg.enforce_lengths:
        rows = constraint_guard(rows, cfg)
    if cfg.strict_dates:
        rows = rows.filter(F.col("date_posted") != "")
    seen = run_ts.cast("timestamp_ntz")
    return rows.withColumns({
        "job_hash": job_hash(), "date_first_seen": seen, "date_last_seen": seen, "status": F.lit("active")})


def fold(df: DataFrame, order: str) -> DataFrame:
    """One row per hash: kept columns of the first row, refreshed ones of the last.

    Both are aggregates over structs, combined map-side before the shuffle; a
    struct carries NULLs that a plain ``min_by`` of one column would also keep.
    """
    folded = df.groupBy("job_hash").agg(
        F.min_by(F.struct(*KEPT), order).alias("_first"),
        F.max_by(F.struct(*REFRESHED), order).alias("_last"))
    return folded.select("job_hash", "_first.*", "_last.*").select(*POSTING.fieldNames())


def merge(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Full outer join of two sets that each hold a hash once.

    Never ``coalesce``: a refreshed NULL must replace the stored value.
    """
    t = target.select(F.lit(True).alias("_t"), *POSTING.fieldNames()).alias("t")
    b = batch.select(F.lit(True).alias("_b"), *POSTING.fieldNames()).alias("b")
    stored, arrived = F.col("_t").isNotNull(), F.col("_b").isNotNull()
    columns = {c: F.when(stored, F.col(f"t.{c}")).otherwise(F.col(f"b.{c}")) for c in KEPT}
    columns |= {c: F.when(arrived, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")) for c in REFRESHED}
    joined = t.join(b, "job_hash", "full_outer")
    return joined.select(*[
        F.col(c) if c == "job_hash" else columns[c].alias(c) for c in POSTING.fieldNames()])


def upsert_postings(target: DataFrame | None, rows: DataFrame, run_ts: Column,
                    cfg: CleanConfig = CleanConfig(), order: str = "seq") -> DataFrame:
    """The table after storing ``rows`` in ``order`` at ``run_ts``."""
    batch = fold(prepare_batch(rows, run_ts, cfg), order)
    return batch if target is None else merge(ensure_columns(target), batch)
