"""Lines first: figures against a plain version, rules line by line, odd tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from checking import compare, connect
from vacancylens.llm import line_quality as q
from vacancylens.llm.common import read

FOLDER = "/root/testdata/sf0.01"
PROSE = "The committee met on the first day of spring and agreed to publish its report before the summer begins. "


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_repeats(words):
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return len(covered)


def test_query_equals_sql(spark):
    assert compare(q.op11_line_quality(spark, FOLDER), connect(FOLDER), q.OP11_SQL) is None


def test_figures_equal_a_plain_version(spark):
    docs = {r["doc_id"]: r["text"] for r in read(spark, FOLDER, "documents").collect()}
    for row in q.op11_line_quality(spark, FOLDER).collect():
        text = docs[row["doc_id"]] or ""
        words = words_of(text)
        lines = [line for line in text.split("\n") if words_of(line)]
        assert row["n_words"] == len(words) and row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == plain_repeats(words)
        failed = len(words) < 50 or 100 * row["n_repeat_words"] > 50 * len(words)
        assert row["base_failed"] == failed and not (failed and row["kept"])


@pytest.mark.parametrize("line, stays", [
    ("The report was published in spring.", True),
    ("“Nobody knew.”", True),
    ("这是一个句子。", True),
    ("A headline without an end", False),
    ("Home | News | Sport | Contact.", False),
    ("Read more.", False),
    ("All rights reserved.", False),
    ("We use cookies to improve this site.", False),
    ("Terms of the GNU General Public License apply.", False),
    ("spam%%% spam&&& spam### spam*** end.", False),
    (PROSE * 2 + "The privacy policy of the company was one of the subjects.", True),
    (PROSE * 3 + "and then it broke off", True),
    ("word " * 80, False)])
def test_rules_of_a_line(line, stays):
    bare = line.strip()
    assert q.LineRules().keeps(bare, len(words_of(bare))) is stays


def test_documents_losing_too_much_text_go(spark):
    good = " ".join(f"Committee c{i} met{i} on day d{i} and{i} agreed on item{i}." for i in range(8))
    bad = "A headline without an end\n" * 40
    rows = [(1, f"{good}\nHome | News | Sport\nAll rights reserved."), (2, f"{good}\n{bad}"), (3, None), (4, ""),
            (4, good), (None, good), (5, " \n\t\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"kept": F.lit("own"), "n_words": F.lit(None).cast("int")})
    got = Counter((r["doc_id"], r["kept"], r["n_lines_removed"]) for r in q.line_quality(docs).collect())
    assert got == Counter([(1, True, 2), (2, False, 40), (3, False, 0), (4, False, 0), (4, True, 0), (None, True, 0),
                           (5, False, 0)])
    cleaned = {(r["doc_id"], r["text"]) for r in q.clean_lines(docs).collect()}
    assert cleaned == {(1, good), (4, good), (None, good)}


def test_empty_table_and_a_long_text(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert q.line_quality(docs).count() == 0
    text = " ".join(f"w{i}" for i in range(300_000)) + ". " + "a b c d a b c."
    row = q.line_quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_words"], row["n_repeat_words"]) == (300_007, 0)
    again = q.line_quality(spark.createDataFrame([(1, f"{text} w1 w2 w3")], "doc_id long, text string")).first()
    assert again["n_repeat_words"] == 6
