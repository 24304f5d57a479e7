"""BPE encoding and decoding of whole texts by tree concatenation.

A long text is halved until its pieces are short; the pieces are encoded on their own,
wherever the cuts fall.  Neighbours are then joined: a window around the cut is encoded
again and grows on both sides until it starts with a token of the left side and holds a
token of the right side, at the same place with the same id; there the three encodings
are spliced.  A byte-pair encoding is valid exactly if every two neighbouring tokens
are, so agreement in one token on either side makes the splice equal the encoding of
the whole.

The pieces of very long texts are rows of their own, encoded by as many tasks; one task then
joins them.  Pieces are encoded by the tokenizers library.  White space always ends a token, and in
texts of common characters so does each change between letters, digits and marks; each
distinct part is encoded once per worker and kept in a bounded cache.
"""

from __future__ import annotations

import os
import pickle
import re
import unicodedata
from bisect import bisect_left, bisect_right
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, in_arrow, kept_table, pieces, read, text_or_empty, to_batch

VOCABULARY = "word_bpe_49k.json"
LONG = 1 << 17  # code points of the longest text that one task encodes by itself, in about a tenth of a second
LEAF = 8192  # code points of the longest piece that is not halved
MARGIN = 32  # code points of a window on either side: more than the longest special token
CACHED = 250_000  # parts in each of the cache's two generations
_RUN = re.compile("[^\x20\x09-\x0d]+")
# Texts of these characters alone split where letters, digits and marks meet, and nowhere else.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_COMMON = re.compile(f"[{_LETTERS}0-9.,;:!?%*#$&()\\-\"/@=+|\x20\x09-\x0d]*")
_PART = re.compile(f"[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9\x20\x09-\x0d]+")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


class Tokens:
    """Ids and the code points [start, stop) each covers."""

    __slots__ = ("ids", "starts", "stops")

    def __init__(self, ids: list, starts: list, stops: list):
        self.ids, self.starts, self.stops = ids, starts, stops

    def at(self, i: int) -> tuple[int, int, int]:
        return self.ids[i], self.starts[i], self.stops[i]


# How a part of a text is encoded: number of ids, ids and decoding as texts, code points of
# the part, and the tokens if it was spliced.
Part = tuple[int, str, str, int, Tokens | None]
_base = itemgetter(0)


def _shifted(part: Part, by: int) -> Part:
    """A part as it counts in a text that begins ``by`` code points earlier."""
    *said, own = part
    return part if own is None else (*said, Tokens(own.ids, [a + by for a in own.starts], [b + by for b in own.stops]))


def _cut(text: str, start: int, stop: int) -> int | None:
    """A place near the middle where no character composes with the one before; None without one."""
    middle = (start + stop) // 2
    for at in chain(range(middle, stop), range(middle - 1, start, -1)):
        c = text[at]
        if c < "̀" or not (unicodedata.category(c).startswith("M") or "ᄀ" <= c <= "ᇿ"):
            return at
    return None


def _firm(text: str, at: int) -> bool:
    """Whether a token boundary at ``at`` means the same wherever the encoding began.

    True after white space, and inside a run of letters, which is split at no other rule.
    """
    if at == 0 or text[at - 1] in " \t\n\x0b\x0c\r":
        return True
    return text[at - 1].isalpha() and text[at].isalpha() and not "ᄀ" <= text[at] <= "ᇿ"


class Encoder:
    """The library's encoding of whole texts, with an exact split of long ones."""

    def __init__(self, vocabulary: str, leaf: int = LEAF):
        # A task has one core: threads of the library's own would only wait for it.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.leaf = leaf
        # Two generations: parts that are not asked for while the younger fills are dropped.
        self.young: dict[str, Part] = {}
        self.old: dict[str, Part] = {}

    def _spell(self, ids: list, chars: int, tokens: Tokens | None = None) -> Part:
        return (len(ids), " ".join(map(str, ids)),
                self.library.decode(ids, skip_special_tokens=False) if ids else "", chars, tokens)

    def _fresh(self, text: str, base: int) -> Tokens:
        e = self.library.encode(text, add_special_tokens=False)
        return Tokens(e.ids, [base + a for a, _ in e.offsets], [base + b for _, b in e.offsets])

    def learn(self, parts: set[str]) -> None:
        """Have every part in the younger generation; what is new is encoded in one call of the library."""
        new = []
        for part in parts:
            if part not in self.young:
                if (known := self.old.get(part)) is not None:
                    self.young[part] = known
                else:
                    new.append(part)
        for part, e in zip(new, self.library.encode_batch_fast(new, add_special_tokens=False)):
            self.young[part] = self._spell(e.ids, len(part))

    def forget(self) -> None:
        """Between batches: keep the cache bounded."""
        if len(self.young) > CACHED:
            self.old, self.young = self.young, {}

    @staticmethod
    def parts(text: str) -> list[str]:
        """Stretches whose encodings make up the text's."""
        if _COMMON.fullmatch(text):
            return _PART.findall(text.lower())
        return [p for run in _RUN.findall(text)
                for p in (_PART.findall(run.lower()) if _COMMON.fullmatch(run) else (run,))]

    def _piece(self, text: str, start: int, stop: int) -> list[tuple[int, Part]]:
        piece = text[start:stop]
        if _COMMON.fullmatch(piece):
            parts = [(start + m.start(), m[0]) for m in _PART.finditer(piece.lower())]
        else:
            parts = [(start + m.start(), m[0]) for m in _RUN.finditer(piece)]
        self.learn({p for _, p in parts})
        known = self.young
        return [(base, known[p]) for base, p in parts]

    def _flat(self, text: str, segments: list[tuple[int, Part]]) -> Tokens:
        """The tokens of neighbouring parts."""
        out = Tokens([], [], [])
        for base, (*_, chars, own) in segments:
            own = own or self._fresh(text[base:base + chars], base)
            out.ids += own.ids
            out.starts += own.starts
            out.stops += own.stops
        return out

    def _join(self, text: str, left: list, cut: int, right: list, start: int, stop: int) -> list[tuple[int, Part]]:
        """Splice the encodings of text[start:cut] and text[cut:stop]."""
        margin = MARGIN
        while True:
            # The window begins at a firm token boundary of the left side, or with the whole of it ...
            a = max(0, bisect_right(left, cut - margin, key=_base) - 1)
            tail = self._flat(text, left[a:])
            i = bisect_right(tail.starts, cut - margin) - 1
            while i > 0 and not (_firm(text, tail.starts[i]) and tail.stops[i - 1] <= tail.starts[i]):
                i -= 1
            i = max(i, 0)
            whole_left = i == 0 and a == 0
            if not whole_left and not tail.ids:
                margin *= 2
                continue
            begin = start if whole_left else tail.starts[i]
            end = min(stop, cut + margin)
            window = self._fresh(text[begin:end], begin)
            agrees = whole_left or (_firm(text, begin) and bool(window.ids) and window.at(0) == tail.at(i))
            # ... and is left at a token that the right side has too, unless it covers all of that.
            if agrees and end == stop:
                return [*left[:a], self._spliced(tail, i, window, len(window.ids), tail, 0, 0)]
            if agrees:
                b = bisect_left(right, end, key=_base)
                head = self._flat(text, right[:b])
                for j in range(len(window.ids) - 2, -1, -1):
                    at = window.starts[j]
                    if at < cut or not _firm(text, at) or (j > 0 and window.stops[j - 1] > at):
                        continue
                    k = bisect_left(head.starts, at)
                    if k < len(head.ids) and head.at(k) == window.at(j) and (k == 0 or head.stops[k - 1] <= at):
                        return [*left[:a], self._spliced(tail, i, window, j, head, k, len(head.ids)), *right[b:]]
            if whole_left and end == stop:
                return [self._spliced(window, 0, window, len(window.ids), window, 0, 0)]
            margin *= 2

    def _spliced(self, left: Tokens, i: int, window: Tokens, j: int, right: Tokens, k: int, n: int) -> tuple[int, Part]:
        """left[:i], window[:j] and right[k:n] as one part."""
        own = Tokens(*(getattr(left, f)[:i] + getattr(window, f)[:j] + getattr(right, f)[k:n]
                       for f in ("ids", "starts", "stops")))
        return own.starts[0] if own.ids else 0, self._spell(own.ids, 0, own)

    def cuts(self, text: str, size: int, start: int = 0, stop: int | None = None) -> list[int]:
        """Where halving ends pieces of at most ``size`` code points, if the text can be cut there."""
        stop = len(text) if stop is None else stop
        cut = _cut(text, start, stop) if stop - start > size else None
        if cut is None:
            return [stop]
        return self.cuts(text, size, start, cut) + self.cuts(text, size, cut, stop)

    def joined(self, pieces: list[tuple[str, list[tuple[int, Part]]]]) -> tuple[int, str, str]:
        """What :meth:`spelled` says of the text that pieces and their segments make up, joined pair by pair."""
        text = "".join(p for p, _ in pieces)
        level, at = [], 0
        for piece, own in pieces:
            level.append((at, at + len(piece), [(at + base, _shifted(part, at)) for base, part in own]))
            at += len(piece)
        while len(level) > 1:
            pairs = [level[i:i + 2] for i in range(0, len(level), 2)]
            level = [(p[0][0], p[1][1], self._join(text, p[0][2], p[0][1], p[1][2], p[0][0], p[1][1])) if len(p) == 2
                     else p[0] for p in pairs]
        found = [own for _, own in level[0][2] if own[0]] if level else []
        return sum([f[0] for f in found]), " ".join([f[1] for f in found]), " ".join([f[2] for f in found])

    def segments(self, text: str, start: int = 0, stop: int | None = None) -> list[tuple[int, Part]]:
        """The parts of text[start:stop] with where they begin, by halves."""
        stop = len(text) if stop is None else stop
        cut = _cut(text, start, stop) if stop - start > self.leaf else None
        if cut is None:
            return self._piece(text, start, stop)
        return self._join(text, self.segments(text, start, cut), cut, self.segments(text, cut, stop), start, stop)

    def spelled(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each text the number of ids, the ids joined by blanks, and their decoding."""
        short = [self.parts(t) if len(t) <= self.leaf else None for t in texts]
        self.learn(set().union(*filter(None, short)))
        out, known = [], self.young
        for text, parts in zip(texts, short):
            found = [known[p] for p in parts] if parts is not None else [own for _, own in self.segments(text)]
            counts = [f[0] for f in found]
            if 0 in counts:
                found = [f for f in found if f[0]]
            out.append((sum(counts), " ".join([f[1] for f in found]), " ".join([f[2] for f in found])))
        self.forget()
        return out

    def ids(self, text: str) -> list[int]:
        return [int(i) for i in self.spelled([text])[0][1].split()]


@lru_cache(maxsize=2)
def _encoder(vocabulary: str, leaf: int) -> Encoder:
    return Encoder(vocabulary, leaf)


def _long_texts(texts: DataFrame, vocabulary: str | None, long: int, leaf: int) -> DataFrame:
    """``key, n, ids, decoded`` of distinct long texts (``key``, ``text``).

    Each text is halved into pieces of at most ``long`` code points, which are encoded by
    different tasks; the pieces of a text then meet in one task, in order.
    """
    piece_schema = pa.schema([("key", pa.string()), ("n", pa.int32()), ("piece", pa.string())])
    coded_schema = pa.schema([*piece_schema, ("segments", pa.binary())])
    said_schema = pa.schema([("key", pa.string()), ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())])
    name = vocabulary

    def halve(batches: Batches) -> Batches:
        encoder = _encoder(name or default_vocabulary(), leaf)
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                stops = encoder.cuts(text, long)
                for n, (a, b) in enumerate(zip([0, *stops], stops)):
                    yield to_batch(piece_schema, [key], [n], [text[a:b]])

    def encode(batches: Batches) -> Batches:
        encoder = _encoder(name or default_vocabulary(), leaf)
        for batch in pieces(batches, 16):
            own = [pickle.dumps(encoder.segments(t)) for t in batch.column(2).to_pylist()]
            encoder.forget()
            yield to_batch(coded_schema, *batch.columns, own)

    def join(batches: Batches) -> Batches:
        encoder = _encoder(name or default_vocabulary(), leaf)
        key, held = None, {}

        def done() -> pa.RecordBatch:
            count, ids, decoded = encoder.joined([held[n] for n in sorted(held)])
            return to_batch(said_schema, [key], [count], [ids], [decoded])
        for batch in pieces(batches, 16):
            for own_key, n, piece, own in zip(*(c.to_pylist() for c in batch.columns)):
                if own_key != key and held:
                    yield done()
                    held = {}
                key = own_key
                held[n] = (piece, pickle.loads(own))
        if held:
            yield done()

    cut = in_arrow(texts, halve, "key string, n int, piece string").repartition("key", "n")
    coded = in_arrow(cut, encode, "key string, n int, piece string, segments binary")
    return in_arrow(coded.repartition("key").sortWithinPartitions("key", "n"), join,
                    "key string, n_tokens long, ids string, decoded string")


def _encoded(docs: DataFrame, vocabulary: str | None, long: int, leaf: int) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every row; ids as decimals joined by blanks."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())])
    name = vocabulary

    def task(batches: Batches) -> Batches:
        encoder = _encoder(name or default_vocabulary(), leaf)
        for batch in pieces(batches, 200):
            said = encoder.spelled(batch.column(1).to_pylist())
            yield to_batch(schema, batch.column(0), *(list(c) for c in zip(*said)))

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    short = in_arrow(plain.filter(F.length("text") <= long), task, "doc_id long, n_tokens long, ids string, decoded string")
    rest = kept_table(plain.filter(F.length("text") > long).withColumn("key", F.sha2("text", 256)), "bpe-long")
    # Copies of a long text are encoded once.
    known = _long_texts(rest.groupBy("key").agg(F.min("text").alias("text")), vocabulary, long, leaf)
    return short.unionByName(rest.select("doc_id", "key").join(known, "key").drop("key"))


def encode_texts(docs: DataFrame, vocabulary: str | None = None, long: int = LONG, leaf: int = LEAF) -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` of every row; a NULL text is empty.

    Special tokens in a text are recognised as the library does by default.  Repeated rows
    give repeated rows, an empty table gives none, other columns are ignored.
    """
    ids = F.when(F.col("ids") == "", F.array().cast("array<int>")).otherwise(F.split("ids", " ").cast("array<int>"))
    return _encoded(docs, vocabulary, long, leaf).select("doc_id", ids.alias("ids"), "decoded")


def token_digests(docs: DataFrame, vocabulary: str | None = None, long: int = LONG, leaf: int = LEAF) -> DataFrame:
    """The same encoding as digests: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    return _encoded(docs, vocabulary, long, leaf).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(read(spark, folder, "documents"))
