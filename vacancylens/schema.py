"""Declared schemas and add-missing-columns evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()

# ---------------------------------------------------------------------------
# Column names, types and orders that results must agree with.
# ---------------------------------------------------------------------------

CAPTURED_PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", _S),
    T.StructField("html", _S),
])

RAW_POSTING = T.StructType([
    T.StructField("seq", T.LongType()),
    *[T.StructField(c, _S) for c in (
        "title", "company", "location", "experience", "job_type", "salary", "career_level",
        "date_posted", "keywords", "description", "url", "scraped_at")],
])

POSTING = T.StructType([
    T.StructField("job_hash", _S, False),
    T.StructField("title", _S, False),
    T.StructField("company", _S, False),
    *[T.StructField(c, _S) for c in (
        "location", "experience", "job_type", "salary", "career_level", "date_posted",
        "keywords", "description", "url")],
    T.StructField("skills", T.ArrayType(_S)),
    T.StructField("date_first_seen", T.TimestampNTZType()),
    T.StructField("date_last_seen", T.TimestampNTZType()),
    T.StructField("status", _S),
    T.StructField("historical_date", T.DateType()),
])

# Column order of the active scan, and of the CSV backup.
SCAN_COLUMNS = (
    "title", "company", "location", "experience", "job_type", "salary", "career_level",
    "date_posted", "keywords", "description", "url", "skills",
    "date_first_seen", "date_last_seen", "status",
)
CSV_COLUMNS = (
    "title", "company", "location", "experience", "job_type", "salary", "career_level",
    "date_posted", "keywords", "description", "url", "scraped_at", "skills",
)

# name -> (type, default) of every column a stored table may lack.
ADDABLE_COLUMNS: dict[str, tuple[str, str | None]] = {
    "experience": ("string", None),
    "job_type": ("string", None),
    "salary": ("string", "Not Specified"),
    "career_level": ("string", None),
    "date_posted": ("string", None),
    "keywords": ("string", None),
    "description": ("string", None),
    "skills": ("array<string>", None),
    "historical_date": ("date", None),
}
# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------

# The raw feed may lack any text field; ``url`` is only optional there.
ADDABLE_RAW = {c: ("string", None) for c in RAW_POSTING.fieldNames() if c not in ("seq", "title")}


def ensure_columns(df: DataFrame, wanted: dict[str, tuple[str, str | None]] | None = None) -> DataFrame:
    """Add the columns of ``wanted`` that ``df`` lacks, with type and default."""
    wanted = ADDABLE_COLUMNS if wanted is None else wanted
    have = set(df.columns)
    missing = {c: F.lit(default).cast(t) for c, (t, default) in wanted.items() if c not in have}
    return df.withColumns(missing) if missing else df
