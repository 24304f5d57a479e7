"""Exact dedup with Patricia-trie owners.

A radix trie holds full byte strings; the terminal node of a text stores its owner.
Each task first inserts what it reads into a trie of its own, so a text that fills a
third of the corpus leaves each task once.  These partial owners are dealt by length
and content hash, and a second trie per partition settles them by full comparison.
Both tries spill whole subtrees when they grow past a byte budget.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settings
from .common import WHITE, Batches, in_arrow, kept_table, read, text_or_empty, to_batch

_DROP = WHITE.encode()
_NODE_BYTES = 600

# Texts travel in small batches: next to the tries, what a worker and its JVM hold is a few of these.
SMALL = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20)}


class _Node:
    __slots__ = ("edges", "owner")

    def __init__(self, owner=None):
        self.edges: dict[int, list] = {}
        self.owner = owner


def _agree(label: bytes, key: bytes, at: int) -> int:
    """How many leading bytes of ``label`` stand in ``key`` from ``at``."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == key[at + low:at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """Byte strings with an owner each; ``add`` merges owners of equal strings."""

    def __init__(self, merge: Callable):
        self.root, self.merge, self.bytes = _Node(), merge, 0
        self.sizes: dict[int, int] = {}  # bytes held below each first byte; -1: the empty string

    def add(self, key: bytes, owner) -> None:
        node, at, size = self.root, 0, self.bytes
        while at < len(key):
            edge = node.edges.get(key[at])
            if edge is None:
                child = _Node()
                node.edges[key[at]] = [key[at:], child]
                self.bytes += len(key) - at + _NODE_BYTES
                node, at = child, len(key)
                break
            label, child = edge
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _agree(label, key, at)
            middle = _Node()
            middle.edges[label[same]] = [label[same:], child]
            node.edges[key[at]] = [label[:same], middle]
            self.bytes += _NODE_BYTES
            node, at = middle, at + same
        node.owner = owner if node.owner is None else self.merge(node.owner, owner)
        first = key[0] if key else -1
        self.sizes[first] = self.sizes.get(first, 0) + self.bytes - size

    def take(self, first: int) -> Iterator[tuple[bytes, object]]:
        """Remove the subtree below a first byte and return its strings with their owners."""
        self.bytes -= self.sizes.pop(first)
        if first < 0:
            owner, self.root.owner = self.root.owner, None
            yield b"", owner
            return
        stack = [(b"", *self.root.edges.pop(first))]
        while stack:
            prefix, label, node = stack.pop()
            prefix += label
            if node.owner is not None:
                yield prefix, node.owner
            stack.extend((prefix, *edge) for edge in node.edges.values())

    def largest(self) -> int:
        return max(self.sizes, key=self.sizes.get)


# An owner is (-code points, id is null, id, rows of the text, rows like the owner): the smallest stays.
def _better(a: tuple, b: tuple) -> tuple:
    if a[:3] == b[:3]:
        return (*a[:3], a[3] + b[3], a[4] + b[4])
    first = min(a, b)
    return (*first[:3], a[3] + b[3], first[4])


_PARTIAL = pa.schema([("n_bytes", pa.int64()), ("hash", pa.int64()), ("norm", pa.binary()), ("chars", pa.int64()),
                      ("id", pa.int64()), ("n", pa.int64()), ("alike", pa.int64())])
_OWNER = pa.schema([("text_sha256", pa.string()), ("keep_id", pa.int64()), ("keep_chars", pa.int64()),
                    ("group_size", pa.int64()), ("keep_rows", pa.int64())])


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, make: Callable, limit: int = 1 << 20) -> Batches:
    out, held = [], 0
    for key, owner in rows:
        out.append(make(key, owner))
        held += len(key)
        if held > limit or len(out) >= 2_000:
            yield to_batch(schema, *(list(c) for c in zip(*out)))
            out, held = [], 0
    if out:
        yield to_batch(schema, *(list(c) for c in zip(*out)))


def _partial(key: bytes, owner: tuple) -> tuple:
    """A text leaves its task compressed: the shuffle and the sort hold less than half of it."""
    return (len(key), xxhash.xxh64_intdigest(key) - (1 << 63), zstandard.compress(key, 1), -owner[0],
            None if owner[1] else owner[2], owner[3], owner[4])


def _rows(batches: Batches) -> Iterator[tuple]:
    """Rows one by one; no more than one text is a Python object."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def _final(key: bytes, owner: tuple) -> tuple:
    return hashlib.sha256(key).hexdigest(), None if owner[1] else owner[2], -owner[0], owner[3], owner[4]


def owners(docs: DataFrame, budget: int = 12 << 20) -> DataFrame:
    """``text_sha256, keep_id, keep_chars, group_size, keep_rows`` of each distinct normalised text.

    ``keep_rows`` says how many rows repeat the id and the length of the one that stays.

    A trie is held below ``budget`` bytes (and one text).
    """
    def local(batches: Batches) -> Batches:
        trie = Trie(_better)

        def rows() -> Iterator[tuple]:
            for doc, text in _rows(batches):
                trie.add(text.encode().translate(None, _DROP), (-len(text), doc is None, doc or 0, 1, 1))
                while trie.bytes > budget:  # what was spilled is settled by the next trie
                    yield from trie.take(trie.largest())
            while trie.sizes:
                yield from trie.take(next(iter(trie.sizes)))
        yield from _in_batches(rows(), _PARTIAL, _partial)

    def settle(batches: Batches) -> Batches:
        trie = Trie(_better)

        def rows() -> Iterator[tuple]:
            dealt = None
            for *place, norm, chars, doc, n, alike in _rows(batches):
                if place != dealt and trie.bytes > budget:
                    # Rows come sorted by length and hash: everything inserted so far is final.
                    while trie.sizes and trie.bytes > budget // 2:
                        yield from trie.take(trie.largest())
                dealt = place
                trie.add(zstandard.decompress(norm), (-chars, doc is None, doc or 0, n, alike))
            while trie.sizes:
                yield from trie.take(next(iter(trie.sizes)))
        yield from _in_batches(rows(), _OWNER, _final)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    partial = in_arrow(texts, local, "n_bytes long, hash long, norm binary, chars long, id long, n long, alike long")
    dealt = partial.repartition("n_bytes", "hash").sortWithinPartitions("n_bytes", "hash")
    return in_arrow(dealt, settle, "text_sha256 string, keep_id long, keep_chars long, group_size long, "
                                   "keep_rows long")


def _settled(docs: DataFrame, budget: int) -> DataFrame:
    with settings(docs.sparkSession, SMALL):
        return kept_table(owners(docs, budget), "owners")


def exact_dedup(docs: DataFrame, budget: int = 12 << 20) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after deleting white space.  The row with the most
    code points stays, then the smallest ``doc_id`` (NULL last).  A NULL text counts as
    empty.  Of rows that repeat both id and text exactly one is kept; if one id stands
    for several equal texts, the longest stays.  Other columns are ignored; an empty table
    gives no rows.
    """
    settled = _settled(docs, budget)
    # Rows that repeat id, text and length are counted, joined once and dealt out again.
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("_t"))
            .select("doc_id", F.length("_t").cast("long").alias("_chars"),
                    F.sha2(F.translate("_t", WHITE, ""), 256).alias("text_sha256"))
            .groupBy("doc_id", "_chars", "text_sha256").agg(F.count("*").alias("_rows")))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_chars") == F.col("keep_chars"))
    return (rows.join(settled, "text_sha256")
            .select("doc_id", "keep_id", "group_size", stays.alias("_stays"), "text_sha256",
                    F.explode(F.sequence(F.lit(1).cast("long"), "_rows")).alias("_i"))
            .select("doc_id", "keep_id", "group_size", (F.col("_stays") & (F.col("_i") == 1)).alias("kept"),
                    "text_sha256"))


def keep_distinct(docs: DataFrame, budget: int = 12 << 20) -> DataFrame:
    """The rows that :func:`exact_dedup` keeps, with all columns of ``docs``, whatever their names.

    NULL ids are an id like any other.  Of rows that repeat id, text and length one is kept; which
    one is open where their other columns differ.
    """
    settled = _settled(docs, budget)
    # Columns travel as one struct, so that none can clash with a key.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
                        F.length(text_or_empty()).cast("long").alias("chars"),
                        F.sha2(F.translate(text_or_empty(), WHITE, ""), 256).alias("sha"))

    def stay(own: DataFrame) -> DataFrame:
        # All three keys deal the rows, so the copies of one text spread over the tasks.
        return keyed.join(own, (keyed["sha"] == own["text_sha256"]) & (keyed["chars"] == own["keep_chars"])
                          & keyed["id"].eqNullSafe(own["keep_id"]), "left_semi")
    once = stay(settled.filter("keep_rows = 1"))
    repeated = settled.filter("keep_rows > 1")
    if not repeated.isEmpty():
        once = once.unionByName(stay(repeated).dropDuplicates(["sha"]))
    return once.select("row.*")


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(read(spark, folder, "documents"))


OP2_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id, row_number() OVER w = 1 AS kept,
        count(*) OVER (PARTITION BY norm) AS group_size
      FROM t WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id))
SELECT doc_id, keep_id, group_size, kept, sha256(norm) AS text_sha256 FROM r
"""
