"""SimHash near-dedup with pigeonhole blocks.

A fingerprint is cut into six blocks.  Two that differ in at most three bits agree on at
least three blocks, so they meet in one of the twenty keys made of three blocks; there
their Hamming distance is verified.  A key that gathers many fingerprints is refined:
its free bits are cut into six blocks again, and so on, until few bits are free.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, in_arrow, kept_table, read, text_or_empty, to_batch
from .components import components

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SEED, DISTANCE, BLOCKS = 42, 3, 6


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 without words.

    Words stand between white space and A-Z are lowered.  A text of fewer words is one
    shingle.  A bit is 1 if it is set in over half of the shingles' hashes.
    """
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    if len(words) < shingle:
        spans = [(0, len(joined))]
    else:
        starts = stops - lengths
        spans = zip(starts[:len(words) - shingle + 1].tolist(), stops[shingle - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[start:start + 8192], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp``; a fingerprint is a signed long of the same bits."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield to_batch(schema, batch.column(0), fps)

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), task,
                    "doc_id long, fp long")


def masks(free: tuple[int, ...]) -> list[tuple[int, tuple[int, ...]]]:
    """Keys over ``free`` bit positions: each mask of agreeing blocks, and the bits it leaves free.

    The positions are cut into six blocks; up to three differing bits leave three of
    them untouched.
    """
    cuts = [len(free) * i // BLOCKS for i in range(BLOCKS + 1)]
    blocks = [free[a:b] for a, b in zip(cuts, cuts[1:])]
    out = []
    for chosen in combinations(range(BLOCKS), BLOCKS - DISTANCE):
        mask = sum(1 << bit for i in chosen for bit in blocks[i])
        out.append((mask, tuple(bit for i in range(BLOCKS) if i not in chosen for bit in blocks[i])))
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _free_bits(path: int, level: int) -> tuple[int, ...]:
    """The bits a refined key leaves free; ``path`` holds one digit (base 20) per level."""
    free, digits = tuple(range(64)), []
    for _ in range(level):
        path, digit = divmod(path, 20)
        digits.append(digit)
    for digit in reversed(digits):
        free = masks(free)[digit][1]
    return free


def _refine(rows: DataFrame, level: int) -> DataFrame:
    """Rows of crowded keys, each under the twenty keys over the bits its key leaves free."""
    schema = pa.schema([("path", pa.int64()), ("key", pa.int64()), ("fp", pa.int64())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            paths, fps = (np.asarray(batch.column(i)) for i in (0, 2))
            for path in np.unique(paths).tolist():
                own = fps[paths == path]
                fixed = ~sum(1 << b for b in _free_bits(path, level)) & ((1 << 64) - 1)
                for i, (mask, _) in enumerate(masks(_free_bits(path, level))):
                    yield to_batch(schema, np.full(len(own), path * 20 + i),
                                   own & np.int64(_signed(mask | fixed)), own)

    return in_arrow(rows, task, "path long, key long, fp long")


def forest(fps: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links that connect the fingerprints of a key as all links within ``distance`` would."""
    bits, label, out = fps.view(np.uint64), np.arange(len(fps)), []
    for i in range(len(fps) - 1):
        near = np.flatnonzero(np.bitwise_count(bits[i + 1:] ^ bits[i]) <= distance) + i + 1
        near = near[label[near] != label[i]]
        if len(near):
            found, first = np.unique(label[near], return_index=True)
            out += [(int(fps[i]), int(fps[j])) for j in near[first]]
            label[np.isin(label, found)] = label[i]
    return out


def _links(crowd: DataFrame, distance: int) -> DataFrame:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for fps in batch.column(0):
                out += forest(np.sort(np.asarray(fps.values)), distance)
            if out:
                yield to_batch(schema, *(list(c) for c in zip(*out)))

    return in_arrow(crowd, task, "a long, b long")


def near_fingerprints(distinct: DataFrame, crowded: int = 2048, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: links that join all fingerprints (column ``fp``, each once) within ``distance`` bits, three at most.

    A key of up to ``crowded`` fingerprints is compared in one task.  Larger keys are refined
    level by level; after three levels a key leaves 8 free bits and holds 256 at most.
    """
    rows = distinct.select(F.explode(F.array(*[
        F.struct(F.lit(i).cast("long").alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"), "fp")
        for i, (mask, _) in enumerate(masks(tuple(range(64))))])).alias("r")).select("r.*")
    found, level = None, 1
    while True:
        counts = kept_table(rows.groupBy("path", "key").count().filter("count > 1"), f"simhash-keys{level}")
        last = level == 3
        small = rows.join(counts if last else counts.filter(F.col("count") <= crowded), ["path", "key"])
        links = kept_table(_links(small.groupBy("path", "key").agg(F.collect_list("fp").alias("fps")).select("fps"),
                                  distance).distinct(), f"simhash-links{level}")
        found = links if found is None else found.unionAll(links)
        large = counts.filter(F.col("count") > crowded)
        if last or large.isEmpty():
            return found
        held = kept_table(rows.join(large, ["path", "key"], "left_semi").select("path", "key", "fp"),
                          f"simhash-crowded{level}")
        rows, level = _refine(held, level).distinct(), level + 1


def simhash_dedup(docs: DataFrame, crowded: int = 2048, distance: int = DISTANCE, shingle: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Fingerprints of ``shingle`` words link at ``distance`` or fewer differing bits (three at most); ``component_id`` is the smallest
    doc_id reachable by links.  Equal fingerprints are one node, so copies cost nothing.  A
    NULL text counts as empty: such documents share fingerprint zero, which links like any
    other.  A NULL doc_id gets a row but is never the smallest unless it stands alone.
    Repeated rows are kept, other columns ignored, an empty table gives no rows.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"distance is 0 to {DISTANCE}: the keys do not bring together what differs in more bits")
    rows = kept_table(fingerprints(docs, shingle), "fingerprints")
    nodes = kept_table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = kept_table(components(near_fingerprints(nodes.select("fp"), crowded, distance), "simhash"), "simhash-roots")
    labelled = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = kept_table(labelled.join(least, "root").select("fp", "component_id"), "simhash-named")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component, the one with its smallest doc_id, with all columns of ``docs``."""
    ids = kept_table(simhash_dedup(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id"),
                     "simhash-kept")
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")


def op8_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup(read(spark, folder, "documents"))
