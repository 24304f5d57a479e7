"""Mixing sources to target weights by the cube method.

Each source's target sets how often its documents are taken on average: some whole
number of times, and once more with a fractional probability.  Which documents get the
extra copy is drawn by balanced sampling: the probabilities of three documents at a
time move along the direction that changes neither the number of documents nor the
tokens expected, until one of them is 0 or 1.  At most two fractional documents are
left of each group; these are gathered and moved again, until one group is left of each
source.  Its last documents make the landing problem: of all ways to round them the one
nearest to the expected totals is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, Batches, in_arrow, kept_table, read, text_or_empty, to_batch

WEIGHTS, SHARE, MOST = (5.0, 2.0, 1.0), 1.5, 2.0
_EDGE = 1e-9
# Documents of a source that the last flight leaves to the landing, which tries all roundings of them.
LANDING = 12


def size_of(text: str = "text") -> Column:
    """Number of words of a text; NULL has none."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """``source, source_size, n_docs, target, ratio`` of each source (``sizes``: source, size).

    Sources in order of code points (NULL last) get the weights in turn and share
    ``share`` of all sizes.  A target stops at ``most`` times its source's size, and the
    excess is shared again by weight.  That is a water level: with sources in order of
    capacity by weight, one running sum finds how many are full.  These windows hold one
    row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    level = Window.orderBy("_fill", F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(turn) - 1) % len(weights) + 1).cast("int"))
    filled = (totals.withColumn("_w", w).withColumn("_cap", F.col("source_size") * most)
              .withColumn("_fill", F.col("_cap") / F.col("_w"))
              .withColumn("_goal", F.sum("source_size").over(everything) * share)
              .withColumn("_rest", F.col("_goal") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
              .withColumn("_left", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    # The level at the first source, in that order, which is not full; those before it are.
    full = F.col("_fill") <= F.col("_rest") / F.col("_left")
    at = F.min(F.when(~full, F.struct("_fill", F.col("source").isNull(), "source",
                                      (F.col("_rest") / F.col("_left")).alias("l")))).over(everything)["l"]
    target = F.when(full, F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_w") * at))
    return filled.withColumn("target", target).select(
        "source", "source_size", "n_docs", "target",
        F.when(F.col("source_size") > 0, F.least(F.lit(most), F.col("target") / F.col("source_size")))
        .otherwise(0.0).alias("ratio"))


def _luck(doc: int | None, size: int, turn: int, seed: int) -> float:
    return (xxhash.xxh64_intdigest(f"{doc}/{size}/{turn}", seed) >> 11) / (1 << 53)


def flight(sizes: np.ndarray, chances: np.ndarray, luck: np.ndarray, leave: int = 0) -> np.ndarray:
    """Chances after the flight: all but two, and the last ``leave``, are 0 or 1.

    The number of documents and the tokens expected stay as they were.  ``luck`` (0 to 1,
    one per document) decides each move, so equal input gives equal output.
    """
    out = chances.astype(float).tolist()
    sizes, luck = sizes.astype(float).tolist(), luck.tolist()
    held: list[int] = []
    for k in range(len(out) - leave):
        if out[k] <= _EDGE or out[k] >= 1 - _EDGE:
            out[k] = 0.0 if out[k] <= _EDGE else 1.0
            continue
        held.append(k)
        while len(held) == 3 or (len(held) == 2 and sizes[held[0]] == sizes[held[1]]):
            # The null space of the rows (1, 1, 1) and (sizes); of equal sizes two suffice.
            if len(held) == 2 or sizes[held[0]] == sizes[held[1]]:
                trio, u = held[:2], (1.0, -1.0)
            elif sizes[held[1]] == sizes[held[2]]:
                trio, u = held[1:], (1.0, -1.0)
            elif sizes[held[0]] == sizes[held[2]]:
                trio, u = held[::2], (1.0, -1.0)
            else:
                trio = held
                a, b, c = (sizes[i] for i in held)
                scale = max(abs(c - b), abs(a - c), abs(b - a))
                u = ((c - b) / scale, (a - c) / scale, (b - a) / scale)
            up = min((1 - out[i]) / v if v > 0 else out[i] / -v for i, v in zip(trio, u) if v)
            down = min(out[i] / v if v > 0 else (1 - out[i]) / -v for i, v in zip(trio, u) if v)
            step = up if luck[trio[0]] * (up + down) < down else -down
            luck[trio[0]] = (luck[trio[0]] * 1103515245.0 + 0.12345) % 1.0
            for i, v in zip(trio, u):
                out[i] += step * v
                if out[i] <= _EDGE or out[i] >= 1 - _EDGE:
                    out[i] = 0.0 if out[i] <= _EDGE else 1.0
            held = [i for i in held if 0.0 < out[i] < 1.0]
    return np.array(out)


def land(sizes: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Round the few open chances so that the tokens, and then the documents, come nearest to those expected."""
    open_, out = np.flatnonzero((chances > _EDGE) & (chances < 1 - _EDGE)), np.round(chances)
    ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    moved = ways - chances[open_]
    miss = np.abs(moved @ sizes[open_]) + np.abs(moved.sum(1)) * sizes[open_].sum() / (100 * max(1, len(open_)))
    out[open_] = ways[miss.argmin()]
    return out


def _fly(rows: DataFrame, group: int, seed: int, landing: bool) -> DataFrame:
    """One flight per (``source``, ``part``) group: rows with new chances."""
    schema = pa.schema([("source", pa.string()), ("doc_id", pa.int64()), ("size", pa.int64()), ("copy", pa.int64()),
                        ("chance", pa.float64())])

    def done(columns: list[list]) -> pa.RecordBatch:
        source, docs, sizes, copies, chances = columns
        luck = np.array([_luck(d, s, c, seed) for d, s, c in zip(docs, sizes, copies)])
        order = np.lexsort((np.array(copies), np.array([d or 0 for d in docs]), luck))
        n, c, x = np.array(sizes, np.int64)[order], np.array(chances, float)[order], luck[order]
        flown = flight(n, c, x, min(LANDING, len(n)) if landing else 0)
        if landing:
            flown = land(n, flown)
        result = np.empty(len(order))
        result[order] = flown
        return to_batch(schema, source, docs, sizes, copies, result)

    def task(batches: Batches) -> Batches:
        key, held = None, None
        for batch in batches:
            for *row_key, doc, size, turn, chance in zip(*(c.to_pylist() for c in batch.columns)):
                if row_key != key:
                    if held:
                        yield done(held)
                    key, held = row_key, [[], [], [], [], []]
                for column, value in zip(held, (row_key[0], doc, size, turn, chance)):
                    column.append(value)
        if held:
            yield done(held)

    parted = (rows.select("source", "part", "doc_id", "size", "copy", "chance").repartition("source", "part")
              .sortWithinPartitions("source", "part"))
    return in_arrow(parted, task, "source string, doc_id long, size long, copy long, chance double")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
        group: int = 4096, seed: int = 7) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, copies``.

    ``copies`` says how often the mix takes the document, at most ``most`` rounded up
    and never more than ``most`` times; ``taken`` is its words times that.  A source's
    taken words differ from its target by the rounding of its last few documents.  Draws
    are hashes of (doc_id, size, which of the rows that repeat both), so reruns agree
    whatever the partitioning.  A NULL source is a source of its own, a NULL text has no
    words, an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       size_of().alias("size"))
    # Rows that repeat id, source and size are numbered without gathering them.
    counted = kept_table(rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n")), "mix-sizes")
    expanded = counted.select("source", "doc_id", "size", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    goals = kept_table(targets(expanded, weights, share, most), "mix-targets")

    whole = F.floor("ratio")
    # Groups of a bounded size, dealt by hash: one flight each.
    part = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size", "copy"), F.ceil(F.col("n_docs") / group))
    joined = (expanded.join(goals, expanded["source"].eqNullSafe(goals["source"]))
              .select(expanded["source"], "doc_id", "size", "copy", part.alias("part"),
                      (F.col("ratio") - whole).alias("chance"), "n_docs"))
    rounds = 0
    largest = goals.agg(F.max("n_docs")).first()[0] or 0
    settled, parts = None, -(-largest // group)
    rows_left = joined
    while True:
        landing = parts <= 1
        flown = kept_table(_fly(rows_left, group, seed + rounds, landing), f"mix-flight{rounds}")
        fixed = flown.filter("chance = 0 OR chance = 1")
        settled = fixed if settled is None else settled.unionAll(fixed)
        if landing:
            break
        # Two documents are left of each group at most: the next groups are that much fewer.
        parts, rounds = -(-2 * parts // group), rounds + 1
        part = F.pmod(F.xxhash64(F.lit(seed + rounds), "doc_id", "size", "copy"), F.lit(parts))
        rows_left = flown.filter("chance > 0 AND chance < 1").withColumn("part", part)
    taken = (whole + F.col("chance")).cast("long")
    return (settled.join(goals, settled["source"].eqNullSafe(goals["source"]))
            .select("doc_id", "size", "source_size", "target", (taken * F.col("size")).alias("taken"),
                    taken.alias("copies"), settled["source"]))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all columns, whatever their names.

    Rows that repeat id, source and size are taken alike; NULL ids and sources match each other.
    """
    counts = kept_table(mix(docs).groupBy("doc_id", "source", "size").agg(F.max("copies").alias("copies"))
                        .filter("copies > 0"), "mix-copies")
    # Columns travel as one struct, so that none can clash with a key.
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
                        F.col("source").cast("string").alias("from"), size_of().alias("words"))
    match = (sized["id"].eqNullSafe(counts["doc_id"]) & sized["from"].eqNullSafe(counts["source"])
             & (sized["words"] == counts["size"]))
    return (sized.join(counts, match).select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("i"))
            .select("row.*"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(read(spark, folder, "documents"))
