"""Quality rules, lines first.

Every line is judged by itself: does it end like a sentence, is it a row of links, is it a
notice.  Lines that fail are removed, and a document goes if too much of it went with them.
Figures of the whole text (words, symbols, repeats) come first and need no verdict on lines.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, Batches, in_arrow, pieces, read, text_or_empty, to_batch

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50   # percent of the words
MOST_LOST = 50       # percent of the code points in words

# A line of more words than this may mention anything, and need not end with a stop
# if it holds one in so many words.
SHORT = 30
STOP_EVERY = 60
STOP = "[.!?…。！？।؟۔][\"'”’»)\\]]*[\\x20\\x09-\\x0D]"
# Full stops of the larger scripts; closing quotes and brackets may follow.
SENTENCE_END = "[.!?:;…。！？।؟۔][\"'”’»)\\]]*$"
# Separators between links.
LINK_MARK = "[|»›·•▸]"
NAVIGATION = ("^(home|menu|search|next|previous|prev|back( to top)?|top|login|log in|logout|sign (in|up|out)|register"
              "|share( this)?|print|reply|read more|show more|load more|more|close|skip to (main )?content"
              "|click here|contact( us)?|about( us)?|site ?map|faq|help)[ .:!>»›]*$")
NOTICE = ("all rights reserved|copyright (\\(c\\)|©|[0-9])|© ?[0-9]|cookie (policy|settings|consent)"
          "|(use|accept)s? cookies|privacy policy|terms (of (use|service)|and conditions)|licen[sc]ed under"
          "|released under the|terms of the .* licen[sc]e|(enable|requires) javascript|lorem ipsum|powered by"
          "|subscribe to (our|the)|sign up for (our|the)|unsubscribe|follow us on|advertisement")

_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lines_removed",
             "lost_chars")
_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in _MEASURES], ("kept_text", pa.string())])
_DDL = "doc_id long, " + ", ".join(f"{c} long" for c in _MEASURES) + ", kept_text string"


class LineRules:
    """Whether a line stays; ``line`` comes without white space around it and holds a word."""

    def __init__(self):
        self.end, self.stop, self.mark = re.compile(SENTENCE_END), re.compile(STOP), re.compile(LINK_MARK)
        self.navigation, self.notice = re.compile(NAVIGATION, re.I), re.compile(NOTICE, re.I)

    def keeps(self, line: str, n_words: int) -> bool:
        if 2 * sum(map(line.count, SYMBOLS)) > n_words:
            return False
        marks = len(self.mark.findall(line))
        if marks >= 2 and n_words <= 4 * (marks + 1):
            return False
        if n_words > SHORT:
            return bool(self.end.search(line)) or STOP_EVERY * len(self.stop.findall(line)) >= n_words
        return bool(self.end.search(line)) and not (self.navigation.search(line) or self.notice.search(line))


def repeated_words(words: list[bytes]) -> int:
    """How many words stand in a 3-word window that the text holds twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    # Windows as numbers: pairs are renumbered first, so that no product overflows.
    _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    _, windows, counts = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[windows] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i:len(words) - 2 + i] |= again
    return int(covered.sum())


def measure(text: str, rules: LineRules) -> tuple[list[int], str]:
    """The figures of one text, in the order of the result's columns, and the lines that stay."""
    words = text.encode().split()  # bytes split at exactly the white space of WHITE
    chars = len(text) - sum(map(text.count, WHITE))
    seen: set[str] = set()
    repeats = lines = removed = lost = 0
    stay = []
    for line in text.split("\n"):
        bare = line.strip(WHITE)
        if not bare:
            continue
        lines += 1
        repeats += line in seen
        seen.add(line)
        if rules.keeps(bare, len(bare.encode().split())):
            stay.append(line)
        else:
            removed += 1
            lost += len(bare) - sum(map(bare.count, WHITE))
    return [len(words), chars, sum(map(text.count, SYMBOLS)), repeats, repeated_words(words), lines, removed,
            lost], "\n".join(stay)


def _measured(docs: DataFrame, texts: bool) -> DataFrame:
    def task(batches: Batches) -> Batches:
        rules = LineRules()
        for batch in pieces(batches, 500):
            rows, kept = [], []
            for i in range(batch.num_rows):  # one text at a time: texts can be long
                figures, text = measure(batch.column(1)[i].as_py(), rules)
                rows.append(figures)
                kept.append(text if texts else None)
            yield to_batch(_SCHEMA, batch.column(0), *(list(c) for c in zip(*rows)), kept)

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")),
                    task, _DDL)


def _verdicts(measured: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (measured.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= MOST_LOST * F.col("word_chars"))))


def line_quality(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, its figures, ``base_failed`` and ``kept``.

    ``kept`` is false for a document that fails the figures of its whole text, or that loses
    more than half of the code points in its words with lines that fail: short lines that
    do not end like a sentence, navigate or give notice, long lines without stops, rows of
    links, and lines with a symbol to every second word.  A NULL text has no
    words and is not kept; NULL and repeated ids give a row each; other columns are
    ignored; an empty table gives no rows.
    """
    return _verdicts(_measured(docs, texts=False)).drop("kept_text")


def clean_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of the documents that :func:`line_quality` keeps, without the lines that failed."""
    return _verdicts(_measured(docs, texts=True)).filter("kept").select("doc_id", F.col("kept_text").alias("text"))


def op11_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality(read(spark, folder, "documents"))


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
v AS (SELECT r, words, len(words) AS n FROM w),
t AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS t
      FROM (SELECT r, words, unnest(range(1, n - 1)) AS i FROM v WHERE n >= 3)),
twice AS (SELECT r, unnest([i, i + 1, i + 2]) AS pos
          FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM t) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT pos) AS n_repeat_words FROM twice GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM d),
b AS (SELECT r, pos, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
        len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l),
j AS (SELECT r, row_number() OVER (PARTITION BY r, line ORDER BY pos) > 1 AS dup,
        length(regexp_replace(bare, '[\x20\x09-\x0D]', '', 'g')) AS chars,
        2 * length(regexp_replace(bare, '[^#*$%&|<>]', '', 'g')) <= n
        AND NOT (len(regexp_extract_all(bare, '{_sql(LINK_MARK)}')) >= 2
                 AND n <= 4 * (len(regexp_extract_all(bare, '{_sql(LINK_MARK)}')) + 1))
        AND CASE WHEN n > {SHORT} THEN regexp_matches(bare, '{_sql(SENTENCE_END)}')
                   OR {STOP_EVERY} * len(regexp_extract_all(bare, '{_sql(STOP)}')) >= n
                 ELSE regexp_matches(bare, '{_sql(SENTENCE_END)}') AND NOT (regexp_matches(bare, '{_sql(NAVIGATION)}', 'i')
                   OR regexp_matches(bare, '{_sql(NOTICE)}', 'i')) END AS stays
      FROM b WHERE n > 0),
s AS (SELECT r, count(*) AS n_lines, count(*) FILTER (dup) AS n_dup_lines, count(*) FILTER (NOT stays) AS n_lines_removed,
        coalesce(sum(chars) FILTER (NOT stays), 0) AS lost_chars FROM j GROUP BY r),
f AS (SELECT doc_id, n AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_lines_removed, 0) AS n_lines_removed, coalesce(lost_chars, 0)::BIGINT AS lost_chars
      FROM d JOIN v USING (r) LEFT JOIN s USING (r) LEFT JOIN repeated USING (r))
SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)
  AND 100 * lost_chars <= {MOST_LOST} * word_chars AS kept FROM f
"""
