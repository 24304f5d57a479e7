"""A dictionary of expressions as a table: same tags as running every expression, whatever its length."""

import re
import time

import pytest
from pyspark.sql import functions as F

from vacancylens.config import SKILLS
from vacancylens.functions.patterns import probes
from vacancylens.functions.skills import pattern_probes, tag_from_patterns, tag_skills

TEXTS = ["Python and SQL", "Java, not JavaScript", "C# developer", "C++17 node.js", "Power BI excel", "github actions docker",
         "machine learning cv", "", None, "größe straße", "ab", "R&D lead", "x" * 5000 + " python", "sql sql SQL"]
HARD = {"always": "[pq]ython", "either": r"\bjava\b|c\+\+", "inside": "thon", "short": "c#", "letters": r"\bgröße\b",
        "gap": r"\bmachine\s+learning\b", "end": "docker$", "optional": r"node(\.js)?", "nothing": r"\bcobol\b"}


def texts(spark):
    rows = [(i, t, f"d {t}" if i % 2 else None) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "seq long, title string, description string")


def tags(df):
    return {r["seq"]: sorted(r["skills"]) for r in df.collect()}


@pytest.mark.parametrize("patterns", [SKILLS, HARD, {}])
def test_table_tags_like_the_mapping(spark, patterns):
    table = spark.createDataFrame([(n, p) for n, p in patterns.items()] + [(None, "a"), ("none", None)],
                                  "name string, pattern string")
    want = tags(tag_skills(texts(spark), patterns)) if patterns else {i: [] for i in range(len(TEXTS))}
    got = tag_from_patterns(texts(spark), table)
    assert tags(got) == want and got.columns == ["seq", "title", "description", "skills"]
    assert all(r["skills"] == sorted(r["skills"]) for r in got.collect())


@pytest.mark.parametrize("pattern", [*SKILLS.values(), *HARD.values()])
def test_a_text_that_matches_shows_a_probe(pattern):
    for text in filter(None, TEXTS):
        low = text.lower()
        if re.search(pattern, low):
            words = re.split(r"\W+", low)
            assert any(p.kind == "always" or (p.value in words if p.kind == "word" else p.value in low)
                       for p in probes(pattern))


def test_ten_thousand_expressions(spark):
    table = spark.range(10_000).select(F.concat(F.lit("name"), F.col("id").cast("string")).alias("name"), F.concat(
        F.lit(r"\b"), F.lit("skill"), F.col("id").cast("string"), F.when(F.col("id") % 2 == 0, r"\b")
        .otherwise(r"\s+pro\b")).alias("pattern"))
    docs = spark.range(300).select(F.col("id").alias("seq"), F.concat(
        F.lit("Skill"), (F.col("id") * 31).cast("string"), F.lit(" pro")).alias("title"), F.lit("skill7 pro").alias("description"))
    tagged = tag_from_patterns(docs, table)
    plan = tagged._jdf.queryExecution().toString()
    assert "skill77" not in plan and len(plan) < 200_000 and "CartesianProduct" not in plan and "NestedLoop" not in plan
    got = tags(tagged)
    for i in range(300):
        assert got[i] == sorted({"name7"} | ({f"name{i * 31}"} if i * 31 < 10_000 else set()))


def test_probes_are_one_row_per_alternative(spark):
    table = spark.createDataFrame([("a", r"\bsql\b|\bmy sql\b"), ("b", "[x]y")], "name string, pattern string")
    assert sorted(map(tuple, pattern_probes(table).select("name", "kind", "probe", "decides").collect())) == [
        ("a", "word", "sql", False), ("a", "word", "sql", True), ("b", "always", "", False)]


def test_long_text_is_walked_once_per_length_of_probe(spark):
    """Cutting out each place by its number took time with the square of the text's length."""
    text = "ab é" * 100_000 + "\n𝄞python"
    rows = spark.createDataFrame([(1, "t", text)], "seq long, title string, description string")
    table = spark.createDataFrame([("p", "𝄞py"), ("edge", "é\\n𝄞"), ("none", "zzz")], "name string, pattern string")
    tags(tag_from_patterns(texts(spark), table))  # starts workers
    began = time.monotonic()
    assert tags(tag_from_patterns(rows, table)) == {1: ["edge", "p"]}
    assert time.monotonic() - began < 15
