"""Spelling variants: words one edit apart, and the common form behind a rare one.

The vocabulary is kept as two sorted lists, of words and of reversed words.  A pair one edit
apart agrees before the middle of the shorter word or after it, so the shorter one finds its partner
among the words of one list that begin with one half of it: a range of neighbours.  A range
is scanned in order with a banded edit matrix: one row per letter, and the rows of the prefix
that a word shares with the one before are reused.  Where a row is above one edit, all words
that share the prefix up to it are skipped.

Lists are cut into blocks of bounded size.  A word visits another block only where its range
goes on there and the prefix that all words of that block share is still within one edit.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, in_arrow, kept_table, pieces, read, to_batch

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_CHARS, LEAST, TIMES, DROP_EVERY = 7, 2, 10, 31
BLOCK_WORDS, BLOCK_CHARS = 16_384, 1 << 20
SHOWN = 64          # code points of a block's first word that routing looks at
LAST = "\U0010ffff"  # sorts after every letter of a word

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- vocabulary -----------------------------------------------------------------

def _lower_ascii(run: Column) -> Column:
    return F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, _UPPER, _LOWER))


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words of all texts that are long and frequent enough."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
                       F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= LEAST_CHARS).select("doc", _lower_ascii(F.col("run")).alias("run"))
    h = runs.select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % DROP_EVERY == 0, F.concat(F.substring("run", F.lit(1), at), F.substring(
        "run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return (h.select(word.alias("word")).filter(F.length("word") >= LEAST_CHARS)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST))


# --- one block ------------------------------------------------------------------

def head(key: str, reverse: bool) -> int:
    """How many first letters of ``key`` a longer or equal partner shares in its list."""
    half = len(key) // 2
    return len(key) - half if reverse else half


def scan(words: list[str], shared: list[int], query: str, agreed: int, start: int) -> Iterator[str]:
    """Words that ``query`` becomes by one replaced or inserted letter after the first ``agreed``.

    ``words`` are sorted, ``shared[i]`` is the prefix that word i shares with the one before, and
    the range begins at ``start``.  Only two cells of a row can stay within one edit: those of as
    many letters of the query as of the word, and of one letter less.
    """
    size, n = len(query), len(words)
    if start >= n or not words[start].startswith(query[:agreed]):
        return
    even, behind = [0] * (size + 2), [2] * (size + 2)  # rows by number of letters of the word
    behind[agreed] = 1
    i, rows = start, agreed                            # rows that hold for word i
    while True:
        word = words[i]
        length = len(word)
        dead = 0
        if size <= length <= size + 1:
            while rows < length:
                a, b, letter = even[rows], behind[rows], word[rows]
                b += letter != query[rows - 1]
                if b > a + 1:
                    b = a + 1
                a = a + (letter != query[rows]) if rows < size else 2
                rows += 1
                even[rows], behind[rows] = a, b
                if a > 1 and b > 1:
                    dead = rows
                    break
            else:
                if (even if length == size else behind)[length] == 1:
                    yield word
        i += 1
        if dead and i < n and shared[i] >= dead:
            i = bisect_left(words, word[:dead] + LAST, i)
        if i >= n or shared[i] < agreed:
            return
        if shared[i] < rows:
            rows = shared[i]


def _better(n: int, word: str, than: list) -> bool:
    return n > than[1] or (n == than[1] and word < than[2])


def block_links(words: list[str], counts: list[int], queries: list[tuple[str, int]], reverse: bool) -> dict[str, list]:
    """Key -> [near words found, count and name of the most frequent one], of one block of a list.

    ``queries`` are sorted.  Every pair is found once over both lists: partners that agree in
    the first half are left to the list of words, and the shorter word reports for both.
    """
    shared = [0] + [len(commonprefix(pair)) for pair in zip(words, words[1:])]
    number = dict(zip(words, counts))
    found: dict[str, list] = {}

    def report(key: str, n: int, near: str) -> None:
        own = found.get(key)
        if own is None:
            found[key] = [1, n, near]
        else:
            own[0] += 1
            if _better(n, near, own):
                own[1:] = n, near

    for query, n in queries:
        agreed = head(query, reverse)
        start = bisect_left(words, query[:agreed])
        for word in scan(words, shared, query, agreed, start):
            if reverse:
                other = len(query) - agreed
                if word[len(word) - other:] == query[agreed:]:
                    continue
            names = (query[::-1], word[::-1]) if reverse else (query, word)
            report(query, number[word], names[1])
            if len(word) > len(query):
                report(word, n, names[0])
    return found


# --- blocks over tasks ------------------------------------------------------------

def _blocks(words: DataFrame, most: int) -> DataFrame:
    """``side, block, key, n``: both sorted lists, cut into blocks."""
    schema = pa.schema([("side", pa.int32()), ("block", pa.int64()), ("key", pa.string()), ("n", pa.int64())])

    def task(batches: Batches) -> Batches:
        first = TaskContext.get().partitionId() << 32
        held = chars = cuts = 0
        before = None
        for batch in pieces(batches, 4096):
            blocks = []
            for side, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held >= most or chars >= BLOCK_CHARS or (before is not None and side != before):
                    held, chars, cuts = 0, 0, cuts + 1
                held, chars, before = held + 1, chars + len(key), side
                blocks.append(first + cuts)
            yield to_batch(schema, batch.column(0), blocks, batch.column(1), batch.column(2))

    both = words.select(F.lit(0).alias("side"), F.col("word").alias("key"), "n").unionAll(
        words.select(F.lit(1), F.reverse("word"), "n"))
    dealt = both.repartitionByRange("side", "key").sortWithinPartitions("side", "key")
    return kept_table(in_arrow(dealt, task, "side int, block long, key string, n long"), "spelling-lists")


class Routes:
    """Which blocks of one list a range goes on in; one short string per block."""

    def __init__(self, starts: list[tuple[str, int]]):
        self.starts, self.blocks = [s for s, _ in starts], [b for _, b in starts]

    def visits(self, query: str, agreed: int, own: int) -> Iterator[int]:
        prefix = query[:agreed]
        first = max(0, bisect_right(self.starts, prefix[:SHOWN]) - 1)
        while first and self.starts[first] == prefix[:SHOWN] and len(prefix) >= SHOWN:
            first -= 1  # such blocks begin somewhere below the prefix
        for i in range(first, bisect_right(self.starts, prefix + LAST)):
            if self.blocks[i] != own and self._within(i, query):
                yield self.blocks[i]

    def _within(self, i: int, query: str) -> bool:
        """Whether the prefix that all words of the block share is within one edit of a prefix of ``query``."""
        if i + 1 == len(self.starts):
            return True
        common = commonprefix((self.starts[i], self.starts[i + 1]))
        even, behind = 0, 1
        for j, letter in enumerate(common):
            if j > len(query):
                return False
            behind = min(behind + (j == 0 or letter != query[j - 1]), even + 1)
            even = even + (letter != query[j]) if j < len(query) else 2
            if even > 1 and behind > 1:
                return False
        return True


def near_words(words: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """``word, n_near, near, near_n`` of every word that is one edit from another one of ``words`` (word, n).

    ``near`` is the most frequent of them, then the smallest.  A task holds blocks of ``block`` words.
    """
    lists = _blocks(words, block)
    starts = lists.groupBy("side", "block").agg(F.substring(F.min("key"), 1, SHOWN).alias("start")).collect()
    routes = {side: Routes(sorted((r["start"], r["block"]) for r in starts if r["side"] == side)) for side in (0, 1)}
    asked = pa.schema([("block", pa.int64()), ("side", pa.int32()), ("key", pa.string()), ("n", pa.int64()),
                       ("own", pa.bool_())])
    linked = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])

    def visit(batches: Batches) -> Batches:
        for batch in pieces(batches, 4096):
            out = []
            for side, own, key, n in zip(*(c.to_pylist() for c in batch.columns)):
                out.append((own, side, key, n, True))
                out += [(b, side, key, n, False) for b in routes[side].visits(key, head(key, side == 1), own)]
            if out:
                yield to_batch(asked, *(list(c) for c in zip(*out)))

    def settle(batches: Batches) -> Batches:
        def blocks() -> Iterator[tuple[int, int, list]]:
            held, at = [], None
            for batch in pieces(batches, 4096):
                for name, side, key, n, own in zip(*(c.to_pylist() for c in batch.columns)):
                    if at is not None and at[0] != name:
                        yield *at, held
                        held = []
                    at = name, side
                    held.append((key, n, own))
            if at is not None:
                yield *at, held

        for _, side, rows in blocks():
            own = [r for r in rows if r[2]]
            found = block_links([r[0] for r in own], [r[1] for r in own], [r[:2] for r in rows], side == 1)
            if found:
                yield to_batch(linked, [k[::-1] if side else k for k in found], [v[0] for v in found.values()],
                               [v[2] for v in found.values()], [v[1] for v in found.values()])

    rows = in_arrow(lists, visit, "block long, side int, key string, n long, own boolean")
    tasks = max(1, -(-len(starts) // 2))  # the work is in the scans, not in the bytes: few blocks a task
    links = in_arrow(rows.repartition(tasks, "block").sortWithinPartitions("block", "key"), settle,
                     "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    return (links.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
            .select("word", "n_near", F.col("_best.word").alias("near"), (-F.col("_best.n")).alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every row of ``forms`` (word, form): the last of the forms that follow from it.

    A form is at least ten times as frequent as its word, so chains end; each round doubles
    the steps that are taken, and only words whose root still has a form are joined.
    """
    steps = kept_table(forms.select("word", F.col("form").alias("root")), "spelling-steps")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = steps.join(further, "root", "left")
        ahead = kept_table(longer.select("word", F.coalesce("next", "root").alias("root"),
                                         F.col("next").isNotNull().alias("moved")), "spelling-steps")
        steps = ahead.select("word", "root")
        if ahead.filter("moved").isEmpty():
            return steps


def spelling_variants(docs: DataFrame) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Words, what makes them near and which near word is a form is set by the constants above.  A
    NULL text has no words, a NULL ``doc_id`` counts as an empty one, rows that repeat count again;
    other columns are ignored; an empty table gives no rows.
    """
    words = kept_table(vocabulary(docs), "spelling-words")
    near = kept_table(near_words(words), "spelling-near").withColumnRenamed("word", "_word")
    known = words.join(near, words["word"] == near["_word"], "left")
    is_form = F.col("near_n") >= TIMES * F.col("n")
    known = kept_table(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("near")).alias("form"),
        F.when(is_form, F.col("near_n")).alias("form_n")), "spelling-forms")
    last = roots(known.filter("form IS NOT NULL").select("word", "form"))
    return (known.join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(read(spark, folder, "documents"))


# The crc32 of a run needs its bytes: runs hold letters of one and two bytes only.
OP13_SQL = r"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) r(i))),
runs AS (SELECT doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
spelt AS (SELECT run, n, flatten(list_transform(string_split(doc || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c) - 64] END)) AS bytes FROM runs),
hashed AS (SELECT run, n, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295),
    4294967295) AS h FROM spelt, crc),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 31 = 0 THEN
    left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS MATERIALIZED (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (
    SELECT word, CAST(unnest(range(1, length(word) + 1)) AS INT) AS i FROM v)),
pairs AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT cut.word, v.word FROM cut JOIN v ON rest = v.word UNION SELECT v.word, cut.word FROM cut JOIN v ON rest = v.word),
best AS (SELECT p.word, near, v.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near FROM pairs p JOIN v ON near = v.word
    QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, near) = 1),
known AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
    CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS last FROM known UNION ALL SELECT walk.word, form FROM walk JOIN known ON last = known.word
    WHERE form IS NOT NULL)
SELECT k.word, k.form, walk.last AS root, k.n, k.n_near, k.form_n FROM known k JOIN walk USING (word)
JOIN known e ON e.word = walk.last WHERE e.form IS NULL
"""
