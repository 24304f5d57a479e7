"""Reports from small summaries: distinct counts per day that merge, and proven top lists."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_text
from ..session import ship_package
from .analytics import value_counts

# 2 ** 12 registers: a standard error of about 1.6 % and 4 KB for a sketch that is full.
REGISTERS = 12
_SKETCHED = ("companies", "locations", "skills")


def relative_error(registers: int = REGISTERS) -> float:
    """Standard error of a distinct count from a sketch."""
    return 1.04 / 2 ** (registers / 2)


def daily_sketches(active: DataFrame, registers: int = REGISTERS) -> DataFrame:
    """One row per day of first sight: postings, and sketches of companies, locations and skills.

    Rows without a day form a group of their own.  A day's row is a few kilobytes, however many
    postings it stands for; append one per run and merge any span of them.
    """
    day = F.to_date("date_first_seen").alias("day")
    plain = active.groupBy(day).agg(
        F.count("*").alias("jobs"), F.hll_sketch_agg("company", registers).alias("companies"),
        F.hll_sketch_agg("location", registers).alias("locations"),
        F.min("date_first_seen").alias("first_seen"), F.max("date_first_seen").alias("last_seen"))
    skills = (active.select(day, F.explode("skills").alias("skill")).filter(has_text(F.col("skill")))
              .groupBy("day").agg(F.hll_sketch_agg("skill", registers).alias("skills")))
    both = plain["day"].eqNullSafe(skills["day"])
    return plain.join(skills, both, "left").select(plain["day"], "jobs", *_SKETCHED, "first_seen", "last_seen")


def merged_days(days: DataFrame) -> DataFrame:
    """Several sketched rows per day (of several runs over different postings) as one."""
    return days.groupBy("day").agg(
        F.sum("jobs").alias("jobs"), *[F.hll_union_agg(c).alias(c) for c in _SKETCHED],
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def span_summary(days: DataFrame, span: Column | None = None) -> DataFrame:
    """The load summary of the days that ``span`` (a condition on ``day``) takes, all of them without it.

    ``jobs`` and the times are exact, the distinct counts are estimates.
    """
    taken = days if span is None else days.filter(span)
    return taken.agg(
        F.coalesce(F.sum("jobs"), F.lit(0).cast("long")).alias("jobs"),
        *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0).cast("long")).alias(c) for c in _SKETCHED],
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


# --- proven top lists -----------------------------------------------------------

def heavy_candidates(df: DataFrame, column: str, capacity: int) -> DataFrame:
    """``value, n, lost``: per value what tasks surely counted; a row with a NULL value holds what they may have lost.

    Each task keeps ``capacity`` counters.  When there are more it takes the count of the first
    one too many off all of them and drops what is left with nothing; that is all a value can
    lose.  What is shuffled is ``capacity`` rows a task, however many values there are.
    """
    ship_package(df.sparkSession)
    schema = pa.schema([("value", pa.string()), ("n", pa.int64()), ("lost", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, int] = {}
        lost = 0
        for batch in batches:
            for entry in pc.value_counts(batch.column(0)).to_pylist():
                counters[entry["values"]] = counters.get(entry["values"], 0) + entry["counts"]
            if len(counters) > 2 * capacity:
                off = sorted(counters.values(), reverse=True)[capacity]
                lost += off
                counters = {v: n - off for v, n in counters.items() if n > off}
        rows = [*counters.items(), (None, 0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v for v, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64()),
             pa.array([0] * len(counters) + [lost], pa.int64())], schema=schema)

    values = df.select(F.col(column).cast("string").alias("value")).filter("value IS NOT NULL")
    return (values.mapInArrow(task, "value string, n long, lost long")
            .groupBy("value").agg(F.sum("n").alias("n"), F.sum("lost").alias("lost")))


def proven_top(df: DataFrame, column: str, top: int, drop_empty: bool = True, out: str = "n",
               capacity: int = 4096) -> DataFrame:
    """The ``top`` most frequent values, exactly as ``value_counts`` gives them, without counting every value.

    One pass finds candidates, a second one counts them.  A value may have lost at most what all tasks
    lost; one that could not reach the smallest sure count of the list even so is no candidate.
    If the list is not sure to hold ``top`` values above that loss, all values are counted.
    """
    keep = has_text(F.col(column)) if drop_empty else F.col(column).isNotNull()
    rows = df.filter(keep)
    # At most `top` sure counts and one loss reach the driver.
    found = heavy_candidates(rows, column, max(capacity, 4 * top))
    best = found.orderBy(F.col("value").isNull().desc(), F.desc("n")).limit(top + 1).collect()
    lost = next((r["lost"] for r in best if r["value"] is None), 0)
    sure = sorted((r["n"] for r in best if r["value"] is not None), reverse=True)
    if lost and (len(sure) < top or sure[top - 1] <= lost):
        return value_counts(df, column, top, drop_empty, out)
    least = sure[top - 1] - lost if len(sure) >= top else 0
    candidates = found.filter(F.col("value").isNotNull() & (F.col("n") >= least)).select("value")
    counted = rows.join(candidates, rows[column].cast("string") == candidates["value"], "left_semi")
    return (counted.groupBy(column).agg(F.count("*").alias(out)).orderBy(F.desc(out), F.asc(column)).limit(top))
