"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package, work_folder

# The white space of every contract: [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"

Batches = Iterator[pa.RecordBatch]


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


# Documents can be long: few rows and bytes in a batch keep a Python worker small.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def in_arrow(df: DataFrame, task: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package on the workers, and small batches unless the session sets its own."""
    spark = df.sparkSession
    ship_package(spark)
    for key, value in BATCH.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return df.mapInArrow(task, schema)


def to_batch(schema: pa.Schema, *columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
         for c, f in zip(columns, schema)], schema=schema)


def pieces(batches: Batches, rows: int) -> Batches:
    """The same rows in slices of at most ``rows``."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """``df``, written below the shared folder and read again.

    Cuts the lineage: a lost executor costs no more than the tasks it ran.  The
    reader knows the size of what it reads, so joins can be planned by it.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
