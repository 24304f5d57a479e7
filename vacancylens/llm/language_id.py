"""Language identification with error-correcting output codes.

Every language gets a codeword.  A binary classifier per bit tells, from hashed
character n-grams, whether a text's language has a one there; decoding adds up the loss
of each codeword over all bits, weighted by how well a bit separated the training
languages, and picks the nearest.  If the runner-up is almost as near, or the text has
no letter, the prediction is flagged.

The classifiers are log-odds of n-gram frequencies, so training is one sum per language
and bucket over *all* training documents; no sample is taken.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, in_arrow, pieces, read, to_batch

BUCKETS, SIZES = 1 << 13, (1, 2, 3)
UNDECIDED = "und"
# Short texts say little: their mean log-odds are drawn towards zero as by so many neutral n-grams.
SHRINK = 16
_STEP = np.uint32(0x9E3779B1)


def gram_counts(text: str, buckets: int = BUCKETS, sizes: Sequence[int] = SIZES) -> np.ndarray:
    """How often each bucket of the lower-cased text's character n-grams occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.zeros(buckets, np.int64)
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    for start in range(0, len(points), 1 << 16):  # very long texts in overlapping stretches
        for n in sizes:
            part = points[start:start + (1 << 16) + n - 1]
            if len(part) < n:
                continue
            h = np.full(len(part) - n + 1, n, np.uint32)
            for k in range(n):
                h = (h ^ part[k:len(part) - n + 1 + k]) * _STEP
            counts += np.bincount((h ^ (h >> np.uint32(15))) * _STEP >> shift, minlength=buckets)
    return counts


def codewords(k: int, bits: int | None = None) -> np.ndarray:
    """``k`` codewords of -1 and 1, one row each; no two bits split the languages alike.

    Up to five languages get the exhaustive code; more get the rows of a Hadamard matrix,
    any two of which differ in half of their bits.  ``bits`` limits neither.
    """
    if k <= 1:
        return np.ones((k, 1))
    if k <= 5:
        rest = [c for c in product((1, -1), repeat=k - 1) if -1 in c]
        return np.array([(1, *c) for c in rest]).T.astype(float)
    h = np.ones((1, 1))
    while len(h) < k + 1:
        h = np.block([[h, h], [h, -h]])
    code = h[1:k + 1, 1:]
    return code[:, [i for i in range(code.shape[1]) if len(set(code[:, i])) == 2]]


@dataclass(frozen=True)
class CodeModel:
    """``weights[bucket, bit]`` and codewords; its size depends on the number of languages only."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    bit_weights: np.ndarray
    scale: float
    ambiguous_below: float

    def decode(self, counts: np.ndarray) -> tuple[str, float, bool]:
        """Language, confidence from 0 to 1, and whether the runner-up is about as near."""
        if not self.languages:
            return UNDECIDED, 0.0, True
        total = counts.sum()
        margins = np.clip(self.scale * (counts @ self.weights) / (total + SHRINK), -30, 30)
        loss = np.log1p(np.exp(-self.code * margins)) @ self.bit_weights  # logistic loss of each codeword
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        order = np.argsort(loss, kind="stable")
        ambiguous = len(order) > 1 and share[order[0]] - share[order[1]] < self.ambiguous_below
        return self.languages[order[0]], float(share[order[0]]), bool(ambiguous)


def fit(languages: Sequence[str], counts: np.ndarray, ambiguous_below: float = 0.05, scale: float = 12.0) -> CodeModel:
    """Classifiers from the n-gram counts of each language (rows of ``counts``, any order)."""
    order = sorted(range(len(languages)), key=lambda i: languages[i])
    names = tuple(languages[i] for i in order)
    code = codewords(len(names))
    if not names:
        return CodeModel((), code, np.zeros((BUCKETS, 1)), np.ones(1), scale, ambiguous_below)
    rates = np.asarray(counts, float)[order] + 0.5
    rates /= rates.sum(1, keepdims=True)
    weights = np.empty((rates.shape[1], code.shape[1]))
    for bit in range(code.shape[1]):
        side = code[:, bit] > 0
        one = rates[side].mean(0) if side.any() else np.full(rates.shape[1], 1 / rates.shape[1])
        two = rates[~side].mean(0) if (~side).any() else np.full(rates.shape[1], 1 / rates.shape[1])
        weights[:, bit] = np.log(one) - np.log(two)
    # A bit counts by how far it holds the expected margins of the languages from zero.
    expected = np.abs(rates @ weights).min(0) if len(names) > 1 else np.ones(code.shape[1])
    bit_weights = expected / max(expected.sum(), 1e-12) * len(expected)
    return CodeModel(names, code, weights, bit_weights, scale, ambiguous_below)


def train(rows: DataFrame) -> CodeModel:
    """Fit on all ``text, lang`` rows with a text and a language.

    Each task sums its own rows; what is shuffled and what reaches the driver is one count
    per language and bucket.
    """
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def task(batches: Batches) -> Batches:
        sums: dict[str, np.ndarray] = {}
        for batch in pieces(batches, 500):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang] += gram_counts(text)
        for lang, counts in sums.items():
            full = np.flatnonzero(counts)
            yield to_batch(schema, [lang] * len(full), full.astype(np.int32), counts[full])

    plain = rows.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        "text IS NOT NULL AND lang IS NOT NULL")
    counted = (in_arrow(plain, task, "lang string, bucket int, n long").groupBy("lang", "bucket")
               .agg(F.sum("n").alias("n")).groupBy("lang")
               .agg(F.collect_list(F.struct("bucket", "n")).alias("c")).toLocalIterator())
    languages, counts = [], []
    for lang, cells in counted:
        row = np.zeros(BUCKETS, np.int64)
        row[[c[0] for c in cells]] = [c[1] for c in cells]
        languages.append(lang)
        counts.append(row)
    return fit(languages, np.array(counts).reshape(len(languages), BUCKETS))


def predict(docs: DataFrame, model: CodeModel, extra: Sequence[str] = ()) -> DataFrame:
    """``doc_id`` and ``extra`` columns with ``lang_pred, score, ambiguous`` of every row.

    Only the text is read.  NULL texts and texts without a letter are ``und`` with score
    0 and flagged; repeated rows get equal rows; an empty table gives none.
    """
    fields = docs.select("doc_id", *extra).schema
    schema = None

    def task(batches: Batches) -> Batches:
        nonlocal schema
        for batch in batches:
            out = []
            for text in batch.column("_text").to_pylist():
                if text is None or not any(map(str.isalpha, text)):
                    out.append((UNDECIDED, 0.0, True))
                else:
                    out.append(model.decode(gram_counts(text)))
            if schema is None:
                schema = pa.schema([*(f for f in batch.schema if f.name != "_text"), ("lang_pred", pa.string()),
                                    ("score", pa.float64()), ("ambiguous", pa.bool_())])
            if out:
                yield to_batch(schema, *(batch.column(f.name) for f in batch.schema if f.name != "_text"),
                               *(list(c) for c in zip(*out)))

    wanted = docs.select("doc_id", *extra, F.col("text").cast("string").alias("_text"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return in_arrow(wanted, task, f"{ddl}, lang_pred string, score double, ambiguous boolean")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training; a NULL id is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows whose language is told, with all columns of ``docs``; texts without letters or verdict go."""
    model = train(docs.filter(~held_out()).select("text", "lang"))
    # The rows travel under names of their own, whatever columns they have.
    carried = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)])
    judged = predict(carried, model, [f"_{i}" for i in range(len(docs.columns))])
    return judged.filter(f"NOT ambiguous AND lang_pred <> '{UNDECIDED}'").select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = train(docs.filter(~held_out()).select("text", "lang"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out"))
    return predict(rows, model, ["held_out"])
