"""Embedding near-dedup by PCA-ordered tiled comparison.

Vectors are rotated so that the leading coordinates hold most of their products.  Tiles of
vectors are compared with each other a few leading coordinates at a time; what the other
coordinates can still add is bounded by the norms of the suffixes, and a pair is given
up as soon as its cosine cannot reach the threshold.  Tiles hold ranges of the first
coordinate, and two tiles whose ranges lie too far apart never meet.

The work is quadratic in the number of different vectors when no bound bites: the method
compares, it does not index.  Equal vectors are one node, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, in_arrow, kept_table, read, to_batch
from .components import components

STEP = 16        # coordinates added between two looks at the bound
SLICE = 512      # rows of a tile compared at a time
_SLACK = 1e-9    # rounding of rotated products; links are decided by the vectors as they came


def _vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, dim, vec``: doubles as bytes; NULL for vectors that link with nothing."""
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("vec", pa.binary())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            dims, vecs = [], []
            for values in batch.column(1).to_pylist():
                vec = None
                if values and None not in values:
                    array = np.array(values, float)
                    if np.isfinite(array).all() and array.any():
                        vec = array
                dims.append(None if vec is None else len(vec))
                vecs.append(None if vec is None else (vec + 0.0).tobytes())  # -0.0 equals 0.0
            yield to_batch(schema, batch.column(0), dims, vecs)

    plain = rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                        F.col("embedding").cast("array<double>").alias("embedding"))
    return in_arrow(plain, task, "vec_id long, dim int, vec binary")


def _units(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that nothing overflows."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(-1, dim)


def rotation(nodes: DataFrame, dim: int) -> np.ndarray:
    """Orthonormal columns in order of the second moment along them, largest first.

    What is summed and collected is one ``dim`` x ``dim`` matrix, whatever the corpus.
    """
    schema = pa.schema([("i", pa.int32()), ("s", pa.float64())])

    def task(batches: Batches) -> Batches:
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                units = _units(_matrix(batch.column(0), dim))
                total += units.T @ units
        yield to_batch(schema, np.arange(dim * dim, dtype=np.int32), total.ravel())

    moment = np.zeros(dim * dim)
    for i, s in in_arrow(nodes.select("vec"), task, "i int, s double").groupBy("i").agg(F.sum("s")).collect():
        moment[i] = s
    _, axes = np.linalg.eigh(moment.reshape(dim, dim))
    return np.ascontiguousarray(axes[:, ::-1])


def linked(left: np.ndarray, right: np.ndarray, threshold: float, same: bool,
           rotated: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (left, right) of rows whose cosine reaches the threshold; of one tile, only i < j."""
    a, b = rotated if rotated is not None else (_units(left), _units(right))
    dim = a.shape[1]
    ends = [*range(STEP, dim, STEP), dim]

    def tails(m: np.ndarray) -> list[np.ndarray]:
        squares = np.cumsum((m * m)[:, ::-1], 1)[:, ::-1]
        return [np.sqrt(squares[:, e]) if e < dim else np.zeros(len(m)) for e in ends]
    tail_a, tail_b = tails(a), tails(b)
    lead = np.column_stack([b[:, :ends[0]], tail_b[0]]).T.copy()
    # Norms beyond the range of doubles: such pairs are judged by their unit vectors.
    with np.errstate(over="ignore", under="ignore"):
        norms_a, norms_b = (np.sqrt((m * m).sum(1)) for m in (left, right))
    odd_a, odd_b = (~np.isfinite(n) | (n < 1e-150) | (n > 1e150) for n in (norms_a, norms_b))
    for start in range(0, len(a), SLICE):
        stop = min(start + SLICE, len(a))
        # Leading products and the bound on the rest in one product.
        bound = np.column_stack([a[start:stop, :ends[0]], tail_a[0][start:stop]]) @ lead
        if same:
            bound[np.arange(len(b))[None, :] <= np.arange(start, stop)[:, None]] = -2.0
        i, j = np.nonzero(bound >= threshold - _SLACK)
        done = bound[i, j] - tail_a[0][start + i] * tail_b[0][j]
        i += start
        for k in range(1, len(ends)):
            if not len(i):
                break
            part = slice(ends[k - 1], ends[k])
            done = done + _products(a[:, part], b[:, part], i, j)
            alive = done + tail_a[k][i] * tail_b[k][j] >= threshold - _SLACK
            i, j, done = i[alive], j[alive], done[alive]
        if len(i):
            odd = odd_a[i] | odd_b[j]
            with np.errstate(all="ignore"):
                cosine = _products(left, right, i, j) / (norms_a[i] * norms_b[j])
            if odd.any():
                cosine[odd] = _products(_units(left), _units(right), i[odd], j[odd])
            reach = cosine >= threshold
            if reach.any():
                yield i[reach], j[reach]


def _products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    for s in range(0, len(i), 1 << 16):
        out[s:s + (1 << 16)] = np.einsum("ij,ij->i", a[i[s:s + (1 << 16)]], b[j[s:s + (1 << 16)]])
    return out


def _compared(tiles: DataFrame, axes: np.ndarray, dim: int, threshold: float) -> DataFrame:
    """``node, other, n``: link counts per node and pair of tiles, and links that connect what is linked there.

    A tile pair gives a spanning forest of its links, never all of them.
    """
    schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])

    def done(a: int, b: int, held: list) -> pa.RecordBatch:
        block, node, size = (np.concatenate([h[i] for h in held]) for i in range(3))
        vecs = np.concatenate([h[3] for h in held])
        first, second = block == a, block == b
        rotated = _units(vecs) @ axes
        near = linked(vecs[first], vecs[second], threshold, a == b, (rotated[first], rotated[second]))
        left, right = np.flatnonzero(first), np.flatnonzero(second)
        counts, label, links = np.zeros(len(node), np.int64), np.arange(len(node)), []
        for i, j in near:
            i, j = left[i], right[j]
            np.add.at(counts, i, size[j])
            np.add.at(counts, j, size[i])
            for one in np.unique(i):
                others = j[i == one]
                others = others[label[others] != label[one]]
                if len(others):
                    found, at = np.unique(label[others], return_index=True)
                    links += [(one, o) for o in others[at]]
                    label[np.isin(label, found)] = label[one]
        some = np.flatnonzero(counts)
        pairs = np.array(links, np.int64).reshape(-1, 2)
        n, m = len(some), len(pairs)
        other = pa.array(np.concatenate([np.zeros(n, np.int64), node[pairs[:, 1]]]),
                         mask=np.concatenate([np.ones(n, bool), np.zeros(m, bool)]))
        return to_batch(schema, np.concatenate([node[some], node[pairs[:, 0]]]), other,
                        np.concatenate([counts[some], np.zeros(m, np.int64)]))

    def task(batches: Batches) -> Batches:
        pair, held = None, []
        for batch in batches:
            a, b = (np.asarray(batch.column(i)) for i in range(2))
            cuts = [0, *(np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0)) + 1), len(a)]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                if (a[s], b[s]) != pair:
                    if held:
                        yield done(*pair, held)
                    pair, held = (a[s], b[s]), []
                held.append((*(np.asarray(batch.column(i).slice(s, e - s)) for i in (2, 3, 4)),
                             _matrix(batch.column(5).slice(s, e - s), dim)))
        if held:
            yield done(*pair, held)

    dealt = tiles.repartition("a", "b").sortWithinPartitions("a", "b")
    return in_arrow(dealt, task, "node long, other long, n long")


def _tiled(nodes: DataFrame, axes: np.ndarray, dim: int, threshold: float, rows: int) -> DataFrame:
    """``a, b, block, node, size, vec``: every vector once for each pair of tiles that it takes part in."""
    lead_schema = pa.schema([("node", pa.int64()), ("size", pa.int64()), ("vec", pa.binary()), ("lead", pa.float64())])

    def leading(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                lead = _units(_matrix(batch.column(2), dim)) @ axes[:, 0]
                yield to_batch(lead_schema, batch.column(0), batch.column(1), batch.column(2), lead)

    led = kept_table(in_arrow(nodes.select("node", "size", "vec"), leading,
                              "node long, size long, vec binary, lead double"), "embedding-leads")
    n = led.count()
    ranges = -(-n // rows)
    inner = led.approxQuantile("lead", [k / ranges for k in range(1, ranges)], 0.1 / ranges) if ranges > 1 else []
    cuts = np.array(sorted(inner))
    ranged_schema = pa.schema([*list(lead_schema)[:3], ("range", pa.int32()), ("lead", pa.float64())])

    def ranging(batches: Batches) -> Batches:
        for batch in batches:
            lead = np.asarray(batch.column(3))
            yield to_batch(ranged_schema, *batch.columns[:3], np.searchsorted(cuts, lead, "right").astype(np.int32), lead)

    ranged = in_arrow(led, ranging, "node long, size long, vec binary, range int, lead double")
    found = sorted(ranged.groupBy("range").agg(F.count("*"), F.min("lead"), F.max("lead")).collect())
    # Tiles: a range, or parts of one that holds more rows than a tile should.
    low, high, of_range = [], [], {}
    for r, count, least, most in found:
        parts = -(-count // (2 * rows))
        of_range[r] = (len(low), parts)
        low += [least] * parts
        high += [most] * parts
    lows, highs = np.array(low), np.array(high)
    apart = np.sqrt(max(0.0, 2 - 2 * threshold)) + _SLACK
    schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("block", pa.int32()), ("node", pa.int64()),
                        ("size", pa.int64()), ("vec", pa.binary())])

    def deal(batches: Batches) -> Batches:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            first, parts = (np.array([of_range[r][k] for r in batch.column(3).to_pylist()], np.int64) for k in (0, 1))
            block = first + ids % np.maximum(parts, 1)
            for one in np.unique(block):
                mine = np.flatnonzero(block == one)
                partners = np.flatnonzero((lows - highs[one] <= apart) & (lows[one] - highs <= apart))
                part = batch.take(pa.array(mine))
                for other in partners:
                    a, b = min(one, other), max(one, other)
                    yield to_batch(schema, *(np.full(len(mine), v, np.int32) for v in (a, b, one)), part.column(0),
                                   part.column(1), part.column(2))

    return in_arrow(ranged.select("node", "size", "vec", "range"), deal,
                    "a int, b int, block int, node long, size long, vec binary")


def embedding_dedup(rows: DataFrame, threshold: float = 0.9, tile: int = 4096) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Two vectors link if their cosine in double precision reaches ``threshold`` (above 0).
    ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest
    vec_id reachable, and a vector is kept if that is its own.  A vector that is NULL, empty,
    zero or holds a NULL or non-finite component links with nothing; vectors of different
    lengths do not link.  Equal vectors link with each other.  Repeated rows are vectors
    of their own with equal verdicts; a NULL vec_id is never the smallest unless it stands
    alone.  Other columns (labels too) are ignored; an empty table gives no rows.  A task holds
    two tiles of about ``tile`` rows.
    """
    vectors = kept_table(_vectors(rows), "embedding-vectors")
    nodes = kept_table(vectors.filter("vec IS NOT NULL").groupBy("dim", "vec")
                       .agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
                       .withColumn("node", F.monotonically_increasing_id()), "embedding-nodes")
    found = None
    for dim in [r[0] for r in nodes.select("dim").distinct().toLocalIterator()]:
        own = nodes.filter(F.col("dim") == dim)
        axes = rotation(own, dim)
        part = kept_table(_compared(_tiled(own, axes, dim, threshold, tile), axes, dim, threshold), "embedding-links")
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "node long, other long, n long")
    counts = found.filter("other IS NULL").groupBy("node").agg(F.sum("n").alias("n"))
    roots = kept_table(components(found.filter("other IS NOT NULL").select(F.col("node").alias("a"),
                                                                           F.col("other").alias("b")), "embedding"),
                       "embedding-roots")
    labelled = nodes.join(roots, "node", "left").select("node", "vec", "least", "size",
                                                        F.coalesce("root", "node").alias("root"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = kept_table(labelled.join(least, "root").join(counts, "node", "left").select(
        "vec", "component_id", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links")), "embedding-named")
    joined = vectors.filter("vec IS NOT NULL").join(named, "vec").select("vec_id", "n_links", "component_id")
    alone = vectors.filter("vec IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                 F.col("vec_id").alias("component_id"))
    return joined.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup(read(spark, folder, "embeddings"))
