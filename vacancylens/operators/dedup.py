"""Keys and first-row deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_FIELDS = ("company", "title", "location")


def raw_key(fields: Sequence[str] = HASH_FIELDS) -> Column:
    """The fields joined by "_"; a NULL counts as "" (``concat_ws`` would skip it)."""
    return F.concat_ws("_", *[F.coalesce(F.col(c), F.lit("")) for c in fields])


def job_hash(fields: Sequence[str] = HASH_FIELDS) -> Column:
    """Identity of a posting in the table."""
    return F.md5(raw_key(fields))


def keep_first(df: DataFrame, keys: Sequence[str], order: str = "seq") -> DataFrame:
    """The row with the smallest ``order`` of each key; NULL keys count as "".

    ``rn = 1`` lets the optimizer put a per-task group limit before the shuffle,
    so a key that holds a third of all rows sends one row per map task.
    """
    w = Window.partitionBy(*[F.coalesce(F.col(k), F.lit("")) for k in keys]).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_url(df: DataFrame, order: str = "seq") -> DataFrame:
    """First row per URL in arrival order; the empty URL is a key like any other."""
    return keep_first(df, ["url"], order)


def dedup_key(df: DataFrame, order: str = "seq") -> DataFrame:
    """First row per joined company, title and location, as they came."""
    return keep_first(df.withColumn("_key", raw_key()), ["_key"], order).drop("_key")
