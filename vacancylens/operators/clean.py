"""The cleaning stage: fields, rejects, defaults, posting dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CleanConfig
from ..functions import dates, text
from ..schema import ADDABLE_RAW, ensure_columns


def apply_defaults(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """A missing salary becomes the default text; an empty one stays empty."""
    return df.withColumn("salary", F.coalesce("salary", F.lit(cfg.default_salary)))


def stamp_scraped(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Set ``scraped_at`` to the run's time where it is missing."""
    now = F.current_timestamp() if run_ts is None else run_ts
    if "scraped_at" not in df.columns:
        return df.withColumn("scraped_at", now)
    if isinstance(df.schema["scraped_at"].dataType, T.StringType):
        now = F.date_format(now, "yyyy-MM-dd HH:mm:ss")
    return df.withColumn("scraped_at", F.coalesce("scraped_at", now))


def add_posting_date(df: DataFrame, cfg: CleanConfig = CleanConfig(),
                     run_ts: Column | None = None) -> DataFrame:
    """Add ``historical_date``, the posting day behind a relative date text."""
    now = F.current_timestamp() if run_ts is None else run_ts
    is_text = isinstance(df.schema["scraped_at"].dataType, T.StringType)
    base = dates.base_date(F.col("scraped_at"), now, is_text)
    return (df.withColumn("_base", base)
            .withColumn("historical_date", dates.relative_date(F.col("date_posted"), F.col("_base"), cfg.weeks))
            .drop("_base"))


def clean_fields(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Clean every text field, then scrub titles and locations; keeps all rows."""
    cleaned = {c: text.clean_text(F.col(c)) for c in cfg.cleaned_fields}
    cleaned["title"] = text.scrub_title(cleaned["title"], cfg)
    cleaned["location"] = text.clean_location(cleaned["location"])
    return ensure_columns(df, ADDABLE_RAW).withColumns(cleaned)


def clean_postings(df: DataFrame, cfg: CleanConfig = CleanConfig(),
                   run_ts: Column | None = None) -> DataFrame:
    """Cleaned postings without non-jobs; stateless, so it also serves streams."""
    jobs = clean_fields(df, cfg).filter(~text.non_job(F.col("title"), cfg))
    return add_posting_date(stamp_scraped(apply_defaults(jobs, cfg), run_ts), cfg, run_ts)


def title_key(title: Column) -> Column:
    """A title as lists of titles are compared: letter case and outer white space aside."""
    return F.lower(F.trim(title))


def drop_listed_titles(df: DataFrame, titles: DataFrame, title: str = "title") -> DataFrame:
    """Rows whose title does not stand in ``titles`` (column ``title``), a table of any length.

    The list first meets the distinct titles of the rows: neither the list nor the rows are
    shuffled for the other.  What they share is short as a rule, and adaptive execution
    broadcasts it if its size allows; if not, the rows are joined on the title.  A NULL title is on no list.
    """
    listed = titles.select(title_key(F.col("title")).alias("_listed")).filter("_listed IS NOT NULL").distinct()
    shared = (df.select(title_key(F.col(title)).alias("_title")).filter("_title IS NOT NULL").distinct()
              .join(listed, F.col("_title") == F.col("_listed"), "left_semi"))
    return df.join(shared, title_key(df[title]) == F.col("_title"), "left_anti")


def constraint_violation(cfg: CleanConfig = CleanConfig()) -> Column:
    """Name of the first column that is too long to store, else NULL."""
    return F.coalesce(*[F.when(F.length(c) > n, F.lit(f"too_long:{c}")) for c, n in cfg.max_lengths.items()])


def constraint_guard(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Rows that fit the declared column lengths; storing asks for it only with ``enforce_lengths``."""
    return df.filter(constraint_violation(cfg).isNull())


def label_rejects(df: DataFrame, cfg: CleanConfig = CleanConfig(), run_ts: Column | None = None,
                  key: str = "url", order: str = "seq", lengths: bool = True) -> DataFrame:
    """All rows, cleaned, with ``reject_reason`` (NULL for rows to store).

    Without ``lengths`` no row is too long.

    Later copies are found on two columns: the smallest ``order`` of each key is a grouped minimum,
    and rows of the key that are not it are the copies.  Only their (order, key) meets the whole rows
    again, so rows are not shuffled where copies are few enough to broadcast, and are dealt
    by both columns where they are not.  Rows that repeat both are one row that came twice: they
    get the same label.
    """
    cleaned = add_posting_date(stamp_scraped(apply_defaults(clean_fields(df, cfg), cfg), run_ts), cfg, run_ts)
    is_job = ~text.non_job(F.col("title"), cfg)
    # Copies only need the title and the key: the scan stays narrow.
    jobs = (ensure_columns(df, ADDABLE_RAW)
            .select(order, F.coalesce(key, F.lit("")).alias("_key"), text.scrub_title(text.clean_text(F.col("title")), cfg).alias("title"))
            .filter(is_job).select(F.col(order).alias("_order"), "_key"))
    winners = jobs.groupBy("_key").agg(F.min("_order").alias("_least"))
    copies = (jobs.join(winners, "_key").filter(~F.col("_order").eqNullSafe(F.col("_least")))
              .select("_order", "_key").distinct().withColumn("_copy", F.lit(True)))
    reason = F.when(~is_job, F.lit("non_job")).when(F.col("_copy").isNotNull(), F.lit("duplicate"))
    if cfg.strict_dates:
        reason = reason.when(F.col("date_posted") == "", F.lit("no_date"))
    same = cleaned[order].eqNullSafe(copies["_order"]) & (F.coalesce(cleaned[key], F.lit("")) == copies["_key"])
    reason = reason.otherwise(constraint_violation(cfg) if lengths else F.lit(None).cast("string"))
    return (cleaned.join(copies, same, "left").drop("_order", "_key")
            .withColumn("reject_reason", reason).drop("_copy"))
