"""The stored posting table: a bucketed Parquet table and the batches that wait to be merged into it.

Four Parquet folders below one root, each written by an ordinary Spark write:

``base``      the merged rows, partitioned by the first digits of the hash, bucketed by the hash
``deltas``    one folded batch per ``seq=N``, written as a whole, so writing it again replaces it
``batches``   ``seq, source, number`` of every batch stored; a row here makes its delta count
``merged``    ``seq`` of the batches that ``base`` holds

A batch costs as much as itself.  Merging joins the waiting deltas with the hash prefixes they
touch, bucket by bucket: only the deltas are shuffled, and dynamic partition overwrite replaces
those prefixes alone.  Every step may be repeated: a delta merged twice changes nothing, as the first
values of a hash stay and the refreshed ones are set again.  So a run that died is simply run
again.  One writer at a time; a reader whose files were replaced under it reads again.

A batch is named by its source and its number there.  Storing the same one again does nothing,
whatever was stored or merged in between; another source may use the same numbers.  A batch
without a name is always stored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CleanConfig
from ..operators.clean import constraint_violation
from ..operators.upsert import fold, merge, prepare_batch
from ..schema import POSTING, ensure_columns
from ..session import settings

Batch = tuple[str, int]

_COLUMNS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in POSTING)
_BATCHES, _MERGED = "seq long, source string, number long", "seq long"


class PostingTable:
    """Upsert target below one folder every executor can reach.

    ``digits`` of the hash make 16 ** digits prefixes, ``buckets`` split each of them.  Choose both so
    that one prefix is a comfortable rewrite and one bucket of the prefixes merged together a
    comfortable task, and keep them for the life of the table.  ``group`` limits how many
    prefixes one merging job takes; without it all touched ones are merged at once.
    """

    def __init__(self, spark: SparkSession, root: str, digits: int = 2, buckets: int = 16, group: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.digits, self.buckets, self.group = digits, buckets, group
        self.name = f"postings_{hashlib.md5(self.root.encode()).hexdigest()[:16]}"
        for part, schema, by in (("base", f"{_COLUMNS}, prefix string", ["prefix"]), ("batches", _BATCHES, []),
                                 ("merged", _MERGED, [])):
            spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*by).parquet(f"{self.root}/{part}")
        self.register()

    def register(self) -> None:
        """Tell the session's catalog what ``base`` holds; again if another session wrote to it."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({_COLUMNS}, prefix string) USING parquet "
            f"PARTITIONED BY (prefix) CLUSTERED BY (job_hash) SORTED BY (job_hash) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.root}/base'")
        self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.name)

    def forget(self) -> None:
        """Take the table out of the session's catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    # --- what is stored ------------------------------------------------------

    def batches(self) -> DataFrame:
        return self.spark.read.schema(_BATCHES).parquet(f"{self.root}/batches")

    def waiting(self) -> DataFrame:
        """Stored batches that are not merged yet."""
        return self.batches().join(self.spark.read.schema(_MERGED).parquet(f"{self.root}/merged"), "seq", "left_anti")

    def waiting_numbers(self) -> list[int]:
        return sorted(r[0] for r in self.waiting().select("seq").distinct().collect())  # few, once per merge

    def base(self) -> DataFrame:
        """The merged rows; a join on ``job_hash`` needs no shuffle of them."""
        return self.spark.table(self.name)

    def deltas(self, numbers: list[int]) -> DataFrame:
        """Folded batches with their ``seq``, the order in which they were stored."""
        return (self.spark.read.schema(f"{_COLUMNS}, seq long").option("basePath", f"{self.root}/deltas")
                .parquet(*[f"{self.root}/deltas/seq={n}" for n in numbers]))

    def folded(self, numbers: list[int]) -> DataFrame:
        """Some deltas as one batch."""
        rows = self.deltas(numbers)
        return fold(rows, "seq") if len(numbers) > 1 else rows.select(*POSTING.fieldNames())

    def prefix(self) -> Column:
        return F.substring("job_hash", 1, self.digits)

    # --- writing -------------------------------------------------------------

    def append(self, rows: DataFrame, run_ts: Column, batch: Batch | None = None,
               cfg: CleanConfig = CleanConfig(), order: str = "seq") -> int | None:
        """Store one batch of cleaned, tagged rows; returns its ``seq``, None if it was stored before.

        With ``cfg.enforce_lengths`` rows that are too long are not stored but written to
        ``rejects/seq=N`` with a ``reject_reason``.
        """
        source, number = batch or (None, None)
        known, last = self.batches().agg(
            F.count_if((F.col("source") == F.lit(source)) & (F.col("number") == F.lit(number))), F.max("seq")).first()
        if known:
            return None
        seq = 0 if last is None else last + 1
        if cfg.enforce_lengths:
            (ensure_columns(rows).withColumn("reject_reason", constraint_violation(cfg)).filter("reject_reason IS NOT NULL")
             .write.mode("overwrite").parquet(f"{self.root}/rejects/seq={seq}"))
        fold(prepare_batch(rows, run_ts, cfg), order).write.mode("overwrite").parquet(f"{self.root}/deltas/seq={seq}")
        (self.spark.createDataFrame([(seq, source, number)], _BATCHES).coalesce(1)
         .write.mode("append").parquet(f"{self.root}/batches"))
        return seq

    def merged(self, numbers: list[int], prefixes: list[str] | None = None) -> DataFrame:
        """The rows of some prefixes (all: None) with the named deltas merged in."""
        batch, base = self.folded(numbers), self.base()
        if prefixes is not None:
            batch, base = batch.filter(self.prefix().isin(prefixes)), base.filter(F.col("prefix").isin(prefixes))
        return merge(base.drop("prefix"), batch)

    def read(self) -> DataFrame:
        """The current table, waiting batches merged in."""
        numbers = self.waiting_numbers()
        return self.merged(numbers) if numbers else self.base().drop("prefix")

    def compact(self) -> int:
        """Merge the waiting batches into the prefixes they touch; returns how many there were."""
        numbers = self.waiting_numbers()
        if not numbers:
            return 0
        touched = sorted(r[0] for r in self.deltas(numbers).select(self.prefix()).distinct().collect())
        step = self.group or len(touched) or 1
        for i in range(0, len(touched), step):  # at most 16 ** digits prefixes
            rows = self.merged(numbers, touched[i:i + step])
            with settings(self.spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
                # The join leaves one task per bucket, so each prefix gets one file per bucket.
                rows.withColumn("prefix", self.prefix()).write.mode("overwrite").insertInto(self.name)
        (self.spark.createDataFrame([(n,) for n in numbers], _MERGED).coalesce(1)
         .write.mode("append").parquet(f"{self.root}/merged"))
        return len(numbers)

    def upsert(self, rows: DataFrame, run_ts: Column, batch: Batch | None = None,
               cfg: CleanConfig = CleanConfig(), order: str = "seq") -> DataFrame:
        """Store one batch, merge it, return the table."""
        self.append(rows, run_ts, batch, cfg, order)
        self.compact()
        return self.read()
