"""The counting views of a posting table, kept current batch by batch.

An upsert takes some rows of the table out and puts new ones in.  What that does to a count is a
signed change: minus one for what the old row counted for, plus one for what the new row counts
for.  A refreshed status or skill list so takes back what it no longer says.  Changes are
computed from the batch and the stored rows of its hashes, on the columns that views count, and
written as ``counts/seq=N``; a view is their sum.  ``totals/upto=N`` holds sums up to a batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_text
from ..operators.upsert import KEPT
from .table import PostingTable

# View -> its column, the name of its count, the column's type.
COUNTED = {
    "v_skill_frequency": ("skill", "frequency", "string"),
    "v_hiring_trends": ("scrape_date", "new_jobs", "date"),
    "v_top_companies": ("company", "open_positions", "string"),
    "v_job_type_breakdown": ("job_type", "count", "string"),
    "v_career_level_distribution": ("career_level", "count", "string"),
    "v_location_distribution": ("location", "count", "string"),
}
_READ = ("company", "location", "date_first_seen", "job_type", "career_level", "skills", "status")
_COUNT, _MARK = "view string, key string, n long", "seq long"
_ENTRIES = "array<struct<view: string, key: string>>"


def entries(c: Callable[[str], Column]) -> Column:
    """What one posting counts for: an array of (view, key); ``c`` gives its columns."""
    active = F.coalesce(c("status") == "active", F.lit(False))

    def one(view: str, key: Column, counts: Column) -> Column:
        return F.when(counts, F.struct(F.lit(view).alias("view"), key.cast("string").alias("key")))

    rows = F.array_compact(F.array(
        one("v_hiring_trends", F.to_date(c("date_first_seen")), F.lit(True)),
        one("v_top_companies", c("company"), active),
        *[one(view, c(column), active & has_text(c(column))) for view, column in (
            ("v_job_type_breakdown", "job_type"), ("v_career_level_distribution", "career_level"),
            ("v_location_distribution", "location"))]))
    skills = F.when(active, F.transform(c("skills"), lambda s: F.struct(F.lit("v_skill_frequency").alias("view"),
                                                                        s.alias("key"))))
    return F.concat(rows.cast(_ENTRIES), F.coalesce(skills.cast(_ENTRIES), F.array().cast(_ENTRIES)))


def _signed(rows: Column, sign: int) -> Column:
    return F.transform(rows, lambda e: F.struct(e["view"].alias("view"), e["key"].alias("key"),
                                                F.lit(sign).cast("long").alias("n")))


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy("view", "key").agg(F.sum("n").alias("n")).filter("n <> 0")


def counts_of(postings: DataFrame) -> DataFrame:
    """``view, key, n`` of a whole table."""
    return _summed(postings.select(F.explode(_signed(entries(F.col), 1)).alias("e")).select("e.*"))


class LiveViews:
    """Counting views of one table.  Use its ``append`` and ``compact`` in place of the table's.

    Every step may be repeated: a batch's changes replace themselves, and only batches noted
    in ``counted`` are taken as done.  If the table was merged without its views being
    counted first, they are counted anew from the whole table.
    """

    def __init__(self, table: PostingTable):
        self.table, self.spark, self.root = table, table.spark, table.root
        self.spark.createDataFrame([], _MARK).write.mode("ignore").parquet(f"{self.root}/counted")
        for part, key in (("counts", "seq"), ("totals", "upto")):
            self.spark.createDataFrame([], f"{_COUNT}, {key} long").write.mode("ignore").partitionBy(key).parquet(
                f"{self.root}/{part}")

    def append(self, *args, **named) -> int | None:
        """Store a batch as ``PostingTable.append`` does, and count it."""
        seq = self.table.append(*args, **named)
        self.refresh()
        return seq

    def compact(self) -> int:
        """Merge waiting batches; they are counted first."""
        self.refresh()
        return self.table.compact()

    # --- counting ------------------------------------------------------------

    def _narrow(self, df: DataFrame, name: str) -> DataFrame:
        return df.select("job_hash", F.lit(True).alias(f"_{name}"), *[F.col(c).alias(f"{name}_{c}") for c in _READ])

    def changes(self, seq: int) -> DataFrame:
        """``view, key, n``: what batch ``seq`` changed, given the batches before it.

        Reads the batch, the earlier waiting ones, and from the base only the prefixes the batch
        touches; the base is not shuffled.
        """
        batch = self.table.deltas([seq])
        touched = [r[0] for r in batch.select(self.table.prefix()).distinct().collect()]  # at most 16 ** digits
        rows = self._narrow(batch, "b").join(
            self._narrow(self.table.base().filter(F.col("prefix").isin(touched)), "s"), "job_hash", "left")
        earlier = [n for n in self.table.waiting_numbers() if n < seq]
        if earlier:
            rows = rows.join(self._narrow(self.table.folded(earlier), "e"), "job_hash", "left")
        else:
            rows = rows.withColumns({"_e": F.lit(None).cast("boolean"), **{
                f"e_{c}": F.lit(None).cast(batch.schema[c].dataType) for c in _READ}})
        stored, waits = F.col("_s").isNotNull(), F.col("_e").isNotNull()

        def old(c: str) -> Column:
            if c in KEPT:
                return F.when(stored, F.col(f"s_{c}")).otherwise(F.col(f"e_{c}"))
            return F.when(waits, F.col(f"e_{c}")).otherwise(F.col(f"s_{c}"))

        def new(c: str) -> Column:
            return F.when(stored | waits, old(c)).otherwise(F.col(f"b_{c}")) if c in KEPT else F.col(f"b_{c}")

        gone = F.when(stored | waits, _signed(entries(old), -1))
        both = F.concat(_signed(entries(new), 1), F.coalesce(gone, F.filter(_signed(entries(new), 1), lambda e: F.lit(False))))
        return _summed(rows.select(F.explode(both).alias("e")).select("e.*"))

    def _note(self, *numbers: int) -> None:
        (self.spark.createDataFrame([(n,) for n in numbers], _MARK).coalesce(1)
         .write.mode("append").parquet(f"{self.root}/counted"))

    def refresh(self) -> list[int]:
        """Count the batches that are not counted yet, in order; returns their numbers."""
        counted = self.spark.read.schema(_MARK).parquet(f"{self.root}/counted")
        todo = sorted(r[0] for r in self.table.batches().join(counted, "seq", "left_anti").select("seq").collect())
        if not set(todo) <= set(self.table.waiting_numbers()):
            return self.rebuild(todo)
        for seq in todo:
            self.changes(seq).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/counts/seq={seq}")
            self._note(seq)
        return todo

    def _write_totals(self, counts: DataFrame) -> None:
        last = self.table.batches().agg(F.max("seq")).first()[0]
        if last is not None:
            counts.write.mode("overwrite").parquet(f"{self.root}/totals/upto={last}")

    def rebuild(self, numbers: list[int]) -> list[int]:
        """Count the whole table; ``numbers`` are noted as counted."""
        self._write_totals(counts_of(self.table.read()))
        self._note(*numbers)
        return numbers

    def roll_up(self) -> None:
        """Sum the changes of all batches so far into one total, which later reads start from."""
        self.refresh()
        self._write_totals(self.counts())

    # --- reading -------------------------------------------------------------

    def counts(self) -> DataFrame:
        """``view, key, n`` of all views: the newest total and the changes after it."""
        totals = self.spark.read.schema(f"{_COUNT}, upto long").parquet(f"{self.root}/totals")
        changes = self.spark.read.schema(f"{_COUNT}, seq long").parquet(f"{self.root}/counts")
        upto = totals.agg(F.max("upto")).first()[0]
        if upto is not None:
            changes = changes.filter(F.col("seq") > upto).select("view", "key", "n").unionAll(
                totals.filter(F.col("upto") == upto).select("view", "key", "n"))
        return _summed(changes.select("view", "key", "n"))

    def read(self, view: str) -> DataFrame:
        """One view, in the columns and order of its twin in ``operators.views``."""
        column, count, kind = COUNTED[view]
        rows = self.counts().filter(F.col("view") == view).select(F.col("key").cast(kind).alias(column), F.col("n").alias(count))
        return rows.orderBy(column) if kind == "date" else rows.orderBy(F.desc(count), F.asc(column))
