"""Relative posting dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (DAY_WORD, DAYS_PER_MONTH, DAYS_PER_YEAR, MONTH_WORD, SAME_DAY_WORDS, TOO_OLD_WORDS, WEEK_WORD,
                      YEAR_WORD)
from .text import contains_any

_EASTERN_DIGITS = "".join(map(chr, (*range(0x0660, 0x066A), *range(0x06F0, 0x06FA))))


def base_date(scraped_at: Column, run_ts: Column, is_text: bool) -> Column:
    """Day of the scrape, or of the run where the stamp does not parse."""
    stamp = F.try_to_timestamp(scraped_at, F.lit("yyyy-M-d H:m:s")) if is_text else scraped_at
    return F.coalesce(stamp.cast("date"), run_ts.cast("date"))


def relative_date(posted: Column, base: Column, weeks: bool = False) -> Column:
    """"3 days ago" counted back from ``base``; NULL for an empty text.

    The first number counts, 1 if there is none.  A count that leaves the
    calendar (before year 1) gives NULL.
    """
    low = F.lower(posted)
    digits = F.regexp_extract(F.translate(low, _EASTERN_DIGITS, "01234567890123456789"), "[0-9]+", 0)
    # Seven digits already reach past year 1, so longer numbers need no exact value.
    count = F.when(digits == "", F.lit(1)) \
        .when(F.length(F.ltrim(digits, F.lit("0"))) > 7, F.lit(None).cast("int")) \
        .otherwise(digits.try_cast("int"))
    factor = (
        F.when(contains_any(low, SAME_DAY_WORDS), 0)
        .when(low.contains(DAY_WORD), 1))
    if weeks:
        factor = factor.when(low.contains(WEEK_WORD), 7)
    factor = (factor.when(low.contains(MONTH_WORD), DAYS_PER_MONTH)
              .when(low.contains(YEAR_WORD), DAYS_PER_YEAR).otherwise(0))
    back = F.when(factor == 0, F.lit(0)).otherwise(count.cast("bigint") * factor)
    reach = F.datediff(base, F.lit("0001-01-01").cast("date"))
    return F.when((posted != "") & (back <= reach), F.date_sub(base, back.cast("int")))


def too_old(date_text: Column) -> Column:
    """True where the text names 4 to 11 months, or a year."""
    return contains_any(F.lower(date_text), TOO_OLD_WORDS)
