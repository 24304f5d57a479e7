"""CSV backup and snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CSV_COLUMNS, SCAN_COLUMNS, ensure_columns

# Quotes are doubled, blanks at the ends of a text survive, and NULL is written as \N.
_FORMAT = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "nullValue": r"\N", "emptyValue": "",
           "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_LIKE_NULL, _LIKE_MARKED = r"^\\+N$", r"^\\\\+N$"
# A quoted text may hold line ends, so one task reads a whole file: files are kept small.
ROWS_PER_FILE = 100_000


def _flat(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as texts; a text that reads like the NULL mark gets one backslash more."""
    have = ensure_columns(df, {c: ("string", None) for c in columns})

    def flat(name: str) -> Column:
        c = F.col(name)
        said = F.array_join(c, ", ") if isinstance(have.schema[name].dataType, T.ArrayType) else c.cast("string")
        return F.when(said.rlike(_LIKE_NULL), F.concat(F.lit("\\"), said)).otherwise(said).alias(name)
    return have.select(*map(flat, columns))


def csv_backup(df: DataFrame, folder: str, run_date: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Append rows in the fixed column order below ``run_date=...``; other columns are left out."""
    (_flat(df, CSV_COLUMNS).withColumn("run_date", F.lit(run_date)).write.mode("append").partitionBy("run_date")
     .options(**{**_FORMAT, "emptyValue": '""'}, maxRecordsPerFile=rows_per_file).csv(folder))


def csv_snapshot(active: DataFrame, folder: str, run_date: str, rows_per_file: int = ROWS_PER_FILE) -> str:
    """Overwrite the day's snapshot of the active set; returns its folder."""
    path = f"{folder.rstrip('/')}/snapshot_{run_date}"
    (_flat(active, SCAN_COLUMNS).write.mode("overwrite")
     .options(**{**_FORMAT, "emptyValue": '""'}, maxRecordsPerFile=rows_per_file).csv(path))
    return path


def read_csv(spark: SparkSession, folder: str, columns: Sequence[str] = CSV_COLUMNS) -> DataFrame:
    """Read either back, all columns as text; NULL and empty texts come back as they were."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    back = spark.read.schema(schema).options(**_FORMAT).option("multiLine", True).csv(folder)
    return back.select(*[F.when(F.col(c).rlike(_LIKE_MARKED), F.substring(c, 2, 1 << 30)).otherwise(F.col(c)).alias(c)
                         for c in columns])
