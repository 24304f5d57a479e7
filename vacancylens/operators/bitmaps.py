"""Co-occurrence of many skills by bitmaps: one bit per posting, pairs by intersection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .analytics import value_counts

BLOCK = 1 << 14  # postings in one round of bitmaps


def intersections(planes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Number of common bits of every row of packed ``planes`` with every row of ``others``."""
    out = np.empty((len(planes), len(others)), np.int64)
    for i, row in enumerate(planes):  # a row against all: memory is that of the bitmaps
        out[i] = np.bitwise_count(row & others).sum(1)
    return out


def pair_counts(rows: np.ndarray, skills: np.ndarray, n_rows: int, n_skills: int) -> np.ndarray:
    """How often two skills stand in one posting, from (posting, skill) entries that may repeat.

    A skill has one bitmap per repetition: the k-th holds the postings that list it k times or
    more.  The product of two repetitions is then the sum of all intersections of their bitmaps.
    """
    entries, times = np.unique(rows.astype(np.int64) * n_skills + skills, return_counts=True)
    total = np.zeros((n_skills, n_skills), np.int64)
    planes = []
    for k in range(1, int(times.max(initial=0)) + 1):
        held = entries[times >= k]
        bits = np.zeros((n_skills, n_rows), bool)
        bits[held % n_skills, held // n_skills] = True
        packed = np.packbits(bits, axis=1)
        words = np.zeros((n_skills, -(-packed.shape[1] // 8) * 8), np.uint8)
        words[:, :packed.shape[1]] = packed
        planes.append(words.view(np.uint64))
    for a in planes:
        for b in planes:
            total += intersections(a, b)
    # A skill does not pair with itself at one place of the list.
    total[np.arange(n_skills), np.arange(n_skills)] -= np.bincount(skills, minlength=n_skills)
    return total


def skill_pairs(active: DataFrame, top: int = 200) -> DataFrame:
    """``skill_1, skill_2, n`` of the ``top`` skills, symmetric and dense: ``skill_cooccurrence`` for long lists.

    The top list (``top`` names) is read first.  Each task sets bits for its postings, block by
    block, and sends one count per pair; nothing is shuffled per posting or set of skills.
    """
    ship_package(active.sparkSession)
    multi = active.filter(F.size("skills") >= 2).select("skills")
    ranked = value_counts(multi.select(F.explode("skills").alias("skill")), "skill", top, drop_empty=False)
    names = sorted(r["skill"] for r in ranked.collect())
    n = len(names)
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("n", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {name: i for i, name in enumerate(names)}
        total = np.zeros((n, n), np.int64)
        held_rows: list[int] = []
        held_skills: list[int] = []
        at = 0
        for batch in batches:
            for skills in batch.column(0).to_pylist():
                for s in skills:
                    if s in place:
                        held_rows.append(at)
                        held_skills.append(place[s])
                at += 1
                if at == BLOCK:
                    total += pair_counts(np.array(held_rows, np.int64), np.array(held_skills, np.int64), at, n)
                    held_rows, held_skills, at = [], [], 0
        if at:
            total += pair_counts(np.array(held_rows, np.int64), np.array(held_skills, np.int64), at, n)
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                         schema=schema)

    counts = multi.mapInArrow(task, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    spark = active.sparkSession
    numbers = spark.createDataFrame([(i, name) for i, name in enumerate(names)], "i int, skill string")
    frame = spark.range(n * n).selectExpr(f"CAST(id DIV {n or 1} AS INT) AS i", f"CAST(id % {n or 1} AS INT) AS j")
    cells = frame.join(counts, ["i", "j"], "left").select("i", "j", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
    return (cells.join(numbers.withColumnRenamed("skill", "skill_1"), "i")
            .join(numbers.withColumnsRenamed({"i": "j", "skill": "skill_2"}), "j")
            .select("skill_1", "skill_2", "n").orderBy("skill_1", "skill_2"))
