"""Substring dedup with fixed-block anchors.

Every document is cut into non-overlapping blocks of 25 words, the reference blocks, and
every rolling window of 25 words of every document probes them.  A repeat of 50 words
holds a whole reference block wherever the blocks happen to be cut, so each repeat makes
a hit.  Hits are then extended: all windows of 50 words around a hit are compared by a
digest of their words, each finds the smallest document it starts in, and the windows
that a smaller document owns merge to maximal repeats.

Probes and windows travel in packed rows, a few bytes each, dealt by ranges of their hash.
What the entries of one task decide among themselves does not travel: of a passage that a
third of all documents share, each task sends the smallest and largest document and the
few it cannot decide.  No pairs of documents are ever made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .common import Batches, in_arrow, pieces, read, text_or_empty, to_batch

WINDOW, BLOCK = 50, 25
_SEGMENT = 1 << 20  # bytes hashed at a time
_FLUSH = 600_000    # entries packed at a time
_KEY_BYTES, _DIGEST_BYTES = 3, 8
# Entries per hash range and documents per group that one task holds at a time.
RANGE_ENTRIES, GROUP_DOCS = 1 << 20, 1000

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up[:n], self.down[:n]


_IN_WORD, _FIRST, _SECOND = _Powers(0x5851F42D4C957F2D), _Powers(0x2545F4914F6CDD1D), _Powers(0x27BB2EE687B0B0FD)


def _sums(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, powers: _Powers) -> np.ndarray:
    """Polynomial hashes of values[start:stop], independent of where the stretch stands."""
    up, down = powers.to(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return (total[stops] - total[starts]) * down[starts]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each word of a text, hashed in segments that end at white space."""
    out, at = [], 0
    while at < len(text):
        stop = min(len(text), at + _SEGMENT)
        while stop < len(text) and not _WHITE[text[stop]]:
            stop += 1
        part = np.frombuffer(text, np.uint8, stop - at, at)
        edges = np.diff(np.concatenate(([True], _WHITE[part], [True])).view(np.int8))
        starts, stops = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        out.append(_mixed(_sums(_BYTE[part], starts, stops, _IN_WORD) + (stops - starts).astype(np.uint64)))
        at = stop
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def windows(hashes: np.ndarray, length: int, powers: _Powers) -> np.ndarray:
    """Hash of each ``length`` consecutive words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    starts = np.arange(n)
    return _mixed(_sums(hashes, starts, starts + length, powers))


def _documents(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of short texts together, and the number of words of each."""
    if len(texts) == 1:
        hashes = word_hashes(texts[0])
        return hashes, np.array([len(hashes)])
    joined = np.frombuffer(b"\n".join(texts), np.uint8)
    white = _WHITE[joined]
    edges = np.diff(np.concatenate(([True], white, [True])).view(np.int8))
    starts, stops = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    hashes = _mixed(_sums(_BYTE[joined], starts, stops, _IN_WORD) + (stops - starts).astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


def _planes(a: np.ndarray, keep: int) -> bytes:
    """The lower ``keep`` bytes of each value, all first bytes first: zeros then compress away."""
    return a.view(np.uint8).reshape(len(a), a.itemsize)[:, :keep].T.tobytes()


def _from_planes(data: bytes, n: int, at: int, keep: int, kind: type) -> np.ndarray:
    out = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
    out[:, :keep] = np.frombuffer(data, np.uint8, n * keep, at).reshape(keep, n).T
    return out.reshape(-1).view(kind)


def _pack(docs: np.ndarray, places: np.ndarray, keys: np.ndarray | None, keep: int) -> bytes:
    steps = np.diff(docs, prepend=np.int64(0))
    return (b"" if keys is None else _planes(keys, keep)) + _planes(steps, 8) + _planes(places.astype(np.uint32), 4)


def _unpack(data: bytes, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, word positions and keys of a packed row."""
    n = len(data) // (keep + 12)
    return (np.cumsum(_from_planes(data, n, n * keep, 8, np.int64)), _from_planes(data, n, n * (keep + 8), 4, np.uint32),
            _from_planes(data, n, 0, keep, np.uint64))


# Open entries go to the task of their hash range; decided ones are meant for a group of documents.
OPEN, DECIDED = 0, 1
_PACKED = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("packed", pa.binary())])
_PACKED_DDL = "kind int, part int, packed binary"


class _Packer:
    """Gathers entries and gives them out as one packed row per part."""

    def __init__(self, keep: int, kind: int):
        self.keep, self.kind, self.held, self.n = keep, kind, [], 0

    def add(self, parts: np.ndarray, docs: np.ndarray, places: np.ndarray, keys: np.ndarray | None = None):
        self.held.append((parts, docs, places, keys))
        self.n += len(parts)

    def full(self) -> bool:
        return self.n >= _FLUSH

    def give(self) -> Batches:
        if not self.n:
            return
        parts, docs, places = (np.concatenate([h[i] for h in self.held]) for i in range(3))
        keys = np.concatenate([h[3] for h in self.held]) if self.keep else None
        self.held, self.n = [], 0
        order = np.argsort(parts, kind="stable")
        parts, docs, places = parts[order], docs[order], places[order]
        keys = keys[order] if keys is not None else None
        first = np.flatnonzero(np.diff(parts, prepend=-1))
        for start in range(0, len(first), 512):
            spans = list(zip(first[start:start + 512], [*first[start + 1:start + 512],
                                                        first[start + 512] if start + 512 < len(first) else len(parts)]))
            yield to_batch(_PACKED, np.full(len(spans), self.kind, np.int32), parts[[a for a, _ in spans]].astype(np.int32),
                           [_pack(docs[a:b], places[a:b], None if keys is None else keys[a:b], self.keep)
                            for a, b in spans])


def _by_part(batches: Batches, keep: int, decided: list[pa.RecordBatch]) -> Iterator[tuple]:
    """All open entries of one part after the other, from rows sorted by part; others go to ``decided``."""
    part, held = None, []
    for batch in batches:
        open_ = np.asarray(batch.column(0)) == OPEN
        if not open_.all():
            decided.append(batch.filter(pa.array(~open_)))
            batch = batch.filter(pa.array(open_))
        for p, packed in zip(batch.column(1).to_pylist(), batch.column(2)):
            if p != part and held:
                yield tuple(np.concatenate(c) for c in zip(*held))
                held = []
            part = p
            held.append(_unpack(packed.as_py(), keep))
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def _group_of(docs: np.ndarray, groups: int) -> np.ndarray:
    return (_mixed(docs.view(np.uint64)) % np.uint64(groups)).astype(np.int32)


def _text_batches(batches: Batches, at: int) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray, np.ndarray]]:
    """Slices of about a segment of text, with word hashes and words per document."""
    for batch in pieces(batches, 256):
        texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(at).to_pylist()]
        start = 0
        while start < len(texts):
            stop, size = start + 1, len(texts[start])
            while stop < len(texts) and size + len(texts[stop]) < _SEGMENT:
                size += len(texts[stop])
                stop += 1
            yield batch.slice(start, stop - start), texts[start:stop], *_documents(texts[start:stop])
            start = stop


def _same(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (key, document), where each key begins in it, and how often it occurs."""
    order = np.lexsort((docs, keys))
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return order, first, np.diff(np.append(first, len(keys)))


def _meetings(keys: np.ndarray, docs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries meet, among these, a block that matters to them, and which others must hear of.

    A larger document learns of the blocks it shares with a smaller one; the smaller one of
    its blocks that a larger one shares.  Others must hear of what is undecided, and of the
    smallest block and the largest document of each key.
    """
    order, first, sizes = _same(keys, docs)
    met, tell = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if not len(keys):
        return met, tell
    own, block = docs[order], places[order] % BLOCK == 0
    at = np.minimum.reduceat(np.where(block, np.arange(len(order)), len(order)), first)
    owner = np.append(own, np.iinfo(np.int64).max)[at]
    largest = first + sizes - 1
    hit = (own > np.repeat(owner, sizes)) | (block & (own < np.repeat(own[largest], sizes)))
    said = ~hit
    said[largest] = True
    said[at[at < len(order)]] = True
    met[order], tell[order] = hit, said
    return met, tell


def _probes(docs: DataFrame, ranges: int, groups: int) -> DataFrame:
    """Rolling windows of 25 words by range of their hash; those at multiples of 25 are reference blocks."""
    def task(batches: Batches) -> Batches:
        held, n = [], 0

        def give() -> Batches:
            probe, ids, places = (np.concatenate(c) for c in zip(*held))
            met, tell = _meetings(probe, ids, places)
            here, away = _Packer(0, DECIDED), _Packer(_KEY_BYTES, OPEN)
            here.add(_group_of(ids[met], groups), ids[met], places[met])
            away.add((probe[tell] % np.uint64(ranges)).astype(np.int32), ids[tell], places[tell],
                     probe[tell] // np.uint64(ranges))
            yield from here.give()
            yield from away.give()
        for batch, _, hashes, counts in _text_batches(batches, 1):
            ids = np.asarray(batch.column(0)).astype(np.int64)
            ends = np.cumsum(counts)
            probe = windows(hashes, BLOCK, _FIRST)
            of = np.repeat(np.arange(len(counts)), counts)[:len(probe)]
            place = np.arange(len(probe)) - (ends - counts)[of]
            # Documents without a window of 50 words repeat nothing.
            good = (place + BLOCK <= counts[of]) & (counts[of] >= WINDOW)
            held.append((probe[good], ids[of[good]], place[good]))
            n += int(good.sum())
            if n >= _FLUSH:
                yield from give()
                held, n = [], 0
        if held:
            yield from give()

    return in_arrow(docs.select("doc_id", "text"), task, _PACKED_DDL)


def _dealt(entries: DataFrame) -> DataFrame:
    return entries.repartition("kind", "part").sortWithinPartitions("kind", "part")


def _hits(probes: DataFrame, groups: int) -> DataFrame:
    """Places where a probe of one document meets a reference block of another that matters to it."""
    def task(batches: Batches) -> Batches:
        packer, table = _Packer(0, DECIDED), np.zeros(1 << (8 * _KEY_BYTES), bool)
        decided: list[pa.RecordBatch] = []
        for docs, places, keys in _by_part(batches, _KEY_BYTES, decided):
            blocks = keys[places % BLOCK == 0]
            table[blocks] = True
            some = np.flatnonzero(table[keys])
            table[blocks] = False
            docs, places, keys = docs[some], places[some], keys[some]
            met, _ = _meetings(keys, docs, places)
            packer.add(_group_of(docs[met], groups), docs[met], places[met])
            if packer.full():
                yield from packer.give()
            yield from decided
            decided.clear()
        yield from packer.give()
        yield from decided

    return in_arrow(_dealt(probes), task, _PACKED_DDL).select("part", "packed")


def _entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Packed documents and places, sorted by document."""
    rows = [_unpack(p, 0)[:2] for p in table.column("packed").to_pylist()]
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    docs, places = (np.concatenate(c) for c in zip(*rows))
    order = np.argsort(docs, kind="stable")
    return docs[order], places[order].astype(np.int64)


def _marked(n: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in any of the stretches."""
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(stops, minlength=n + 1)
    return np.cumsum(edges)[:n] > 0


def _per_group(texts: DataFrame, packed: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table],
               schema: str) -> DataFrame:
    """``work`` on the texts and the packed rows of each group of documents."""
    ship_package(texts.sparkSession)

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        return work(left, right)
    return texts.groupBy("part").cogroup(packed.groupBy("part")).applyInArrow(one, schema)


def _owned_here(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries share their key with a smaller document among these, and one smallest entry of each key."""
    order, first, sizes = _same(keys, docs)
    lost, least = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if len(keys):
        lost[order] = docs[order] > np.repeat(docs[order][first], sizes)
        least[order[first]] = True
    return lost, least | ~lost


def _candidates(texts: DataFrame, hits: DataFrame, ranges: int, groups: int) -> DataFrame:
    """Digests of the windows of 50 words that hold a hit, by range of the digest."""
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, places = _entries(right)
        held: list[tuple] = []
        for doc, text in zip(left.column("doc_id").to_pylist(), left.column("text")):
            if doc is None:
                continue
            a, b = np.searchsorted(docs, doc, "left"), np.searchsorted(docs, doc, "right")
            if a == b:
                continue
            digest = windows(word_hashes(text.as_py().encode("utf-8", "surrogatepass")), WINDOW, _SECOND)
            own = places[a:b]
            own = own[own + BLOCK <= len(digest) + WINDOW - 1]
            starts = np.flatnonzero(_marked(len(digest), np.maximum(0, own + BLOCK - WINDOW),
                                            np.minimum(len(digest), own + 1)))
            held.append((digest[starts], np.full(len(starts), doc, np.int64), starts))
        if not held:
            return pa.Table.from_batches([], _PACKED)
        digest, ids, starts = (np.concatenate(c) for c in zip(*held))
        lost, tell = _owned_here(digest, ids)
        here, away = _Packer(0, DECIDED), _Packer(_DIGEST_BYTES, OPEN)
        here.add(_group_of(ids[lost], groups), ids[lost], starts[lost])
        away.add((digest[tell] % np.uint64(ranges)).astype(np.int32), ids[tell], starts[tell],
                 _mixed(digest[tell] + np.uint64(1)))
        return pa.Table.from_batches([*here.give(), *away.give()], _PACKED)

    return _per_group(texts, hits, work, _PACKED_DDL)


def _owned(candidates: DataFrame, groups: int) -> DataFrame:
    """Windows that start in a document with a smaller id as well."""
    def task(batches: Batches) -> Batches:
        packer, decided = _Packer(0, DECIDED), []
        for docs, places, keys in _by_part(batches, _DIGEST_BYTES, decided):
            lost, _ = _owned_here(keys, docs)
            packer.add(_group_of(docs[lost], groups), docs[lost], places[lost])
            if packer.full():
                yield from packer.give()
            yield from decided
            decided.clear()
        yield from packer.give()
        yield from decided

    return in_arrow(_dealt(candidates), task, _PACKED_DDL).select("part", "packed")


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("repeats", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                     ("kept", pa.string())])
_RESULT_DDL = "doc_id long, n_words long, n_removed long, repeats array<struct<start:int,stop:int>>, kept string"


def _without(texts: DataFrame, owned: DataFrame) -> DataFrame:
    """Every document without the words of its owned windows."""
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, places = _entries(right)
        rows = []
        for doc, text in zip(left.column("doc_id").to_pylist(), left.column("text")):
            words = text.as_py().encode("utf-8", "surrogatepass").split()
            a, b = (0, 0) if doc is None else (np.searchsorted(docs, doc, "left"), np.searchsorted(docs, doc, "right"))
            own = places[a:b][places[a:b] + WINDOW <= len(words)]
            gone = _marked(len(words), own, own + WINDOW)
            edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
            spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
            kept, at = [], 0
            for start, stop in [*spans, (len(words), len(words))]:
                kept += words[at:start]
                at = stop
            rows.append((doc, len(words), int(gone.sum()), [{"start": s, "stop": e} for s, e in spans],
                         b" ".join(kept).decode("utf-8", "surrogatepass")))
        return pa.Table.from_batches([to_batch(_RESULT, *(list(c) for c in zip(*rows)))] if rows else [], _RESULT)

    return _per_group(texts, owned, work, _RESULT_DDL)


def substring_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, repeats, kept``.

    Removed is each word covered by a window of 50 words that also starts in a document
    with a smaller id; ``repeats`` are the maximal stretches of such words, ``kept`` the
    other words joined by blanks.  Windows are judged on the input.  A NULL text has no
    words.  A document without an id is not smaller than any, nor any than it: it keeps its
    words.  Rows that repeat an id are judged alike, since neither is smaller.  Other columns are
    ignored, an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).first()
    # Ranges and groups follow the input, so that what one task holds does not.
    ranges = max(1024, (size["bytes"] or 0) // 6 // RANGE_ENTRIES)
    groups = max(640, size["n"] // GROUP_DOCS)
    hits = _hits(_probes(rows.filter("doc_id IS NOT NULL"), ranges, groups), groups)
    # Both uses of the texts ask for the same exchange, which Spark makes once.
    texts = _grouped(rows, groups)
    return _without(texts, _owned(_candidates(texts, hits, ranges, groups), groups))


def _grouped(rows: DataFrame, groups: int) -> DataFrame:
    """Texts with the group of their document: the same function of the id as :func:`_group_of`."""
    schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("text", pa.string())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            ids = batch.column(0)
            known = np.asarray(ids.fill_null(0)).astype(np.int64)
            spread = np.where(np.asarray(ids.is_null()), np.asarray(batch.column(1)), known)
            yield to_batch(schema, _group_of(spread.astype(np.int64), groups), ids, batch.column(2))

    hashed: Column = F.xxhash64("text")
    return in_arrow(rows.select("doc_id", hashed.alias("_spread"), "text"), task, "part int, doc_id long, text string")


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(read(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
