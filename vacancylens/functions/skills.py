"""Skill tagging from a dictionary of regular expressions.

Running every expression over every text is the cost of an ingest.  Most
expressions ask for whole words, so a text is split into words once and only
the words of the dictionary are kept.  An expression that is just a word is
then decided by that short list; the others run where the words they need are
present, or, where an expression names no whole word, a plain substring.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SKILLS
from ..session import ship_package
from .patterns import GRAM, needs, probes


def _match(text: Column, words: Column, pattern: str) -> Column:
    run = text.rlike(f"(?U){pattern}")
    alternatives = needs(pattern)
    if alternatives is None:
        return run
    decided, guarded = [], []
    for need in alternatives:
        if need.exact:
            decided.append(F.array_contains(words, need.words[0]))
        elif need.words:
            present = F.array_contains(words, need.words[0])
            for word in need.words[1:]:
                present = present & F.array_contains(words, word)
            guarded.append(present)
        else:
            guarded.append(text.contains(need.substring))
    hit = None
    for test in decided:
        hit = test if hit is None else hit | test
    if guarded:
        possible = guarded[0]
        for test in guarded[1:]:
            possible = possible | test
        hit = possible & run if hit is None else hit | (possible & run)
    return hit


def _text() -> Column:
    """Title and description as expressions see them."""
    return F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit(""))))


def tag_skills(df: DataFrame, skills: Mapping[str, str] = SKILLS, out: str = "skills") -> DataFrame:
    """Add the array of skills found in title and description, in dictionary order."""
    vocabulary = sorted({w for p in skills.values() for n in needs(p) or () for w in n.words})
    words = F.filter(F.split("_text", r"(?U)\W+"), lambda w: w.isin(*vocabulary))
    tags = [F.when(_match(F.col("_text"), F.col("_words"), p), F.lit(name)) for name, p in skills.items()]
    return (df.withColumn("_text", _text()).withColumn("_words", words)
            .withColumn(out, F.array_compact(F.array(*tags))).drop("_text", "_words"))


def skills_from_table(table: DataFrame, name: str = "name", pattern: str = "pattern") -> dict[str, str]:
    """A short dictionary table as a mapping, which becomes part of the plan; see :func:`tag_from_table`."""
    return {r[0]: r[1] for r in table.select(name, pattern).collect()}


def tag_from_table(df: DataFrame, table: DataFrame, key: str = "seq", out: str = "skills") -> DataFrame:
    """Tag from a dictionary table of whole words or phrases, of any length.

    ``table`` has ``name`` and ``phrase``.  A text is tagged with a name if the phrase's
    words stand in it one after the other, letter case aside.  Texts meet phrases by an equality
    join on the phrase's first word, so neither the plan nor the driver holds the dictionary.
    Names come in alphabetical order.  ``key`` identifies the rows of ``df``.
    """
    words = F.split(_text(), r"(?U)\W+")
    phrases = (table.select("name", F.array_remove(F.split(F.lower("phrase"), r"(?U)\W+"), "").alias("_phrase"))
               .filter(F.size("_phrase") > 0).withColumn("_first", F.col("_phrase")[0]))
    said = df.select(key, words.alias("_words"))
    # A word of the text and what follows it, once each.
    longest = phrases.agg(F.max(F.size("_phrase"))).scalar()
    starts = (said.withColumn("_n", longest).select(key, F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("_words"), F.lit(1))),
        lambda i: F.slice("_words", i, F.coalesce(F.col("_n"), F.lit(1)))))).alias("_from"))
        .withColumn("_first", F.col("_from")[0]))
    tags = (starts.join(phrases, "_first")
            .filter(F.slice("_from", F.lit(1), F.size("_phrase")) == F.col("_phrase"))
            .groupBy(key).agg(F.array_sort(F.collect_set("name")).alias("_tags")))
    return (df.join(tags, key, "left")
            .withColumn(out, F.coalesce("_tags", F.array().cast("array<string>"))).drop("_tags"))


def pattern_probes(table: DataFrame, name: str = "name", pattern: str = "pattern") -> DataFrame:
    """``name, pattern, kind, probe, decides``: what a text must show for each expression of a dictionary."""
    ship_package(table.sparkSession)
    schema = pa.schema([("name", pa.string()), ("pattern", pa.string()), ("kind", pa.string()), ("probe", pa.string()),
                        ("decides", pa.bool_())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(n, p, found.kind, found.value, found.decides)
                    for n, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for found in probes(p)]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

    rows = table.select(F.col(name).alias("name"), F.col(pattern).alias("pattern")).filter(
        "name IS NOT NULL AND pattern IS NOT NULL")
    return rows.mapInArrow(task, "name string, pattern string, kind string, probe string, decides boolean")


def tag_from_patterns(df: DataFrame, table: DataFrame, key: str = "seq", out: str = "skills") -> DataFrame:
    """Tag from a dictionary table of regular expressions (``name``, ``pattern``), of any length.

    Each expression is reduced to what a text must show: a word, or a few letters in a row.
    Texts meet expressions by an equality join on that, and only then is the expression of the row
    run.  Neither the plan nor the driver holds the dictionary.  An expression that asks for
    nothing readable is tried on every text; keep those few.  Names come in alphabetical order; rows
    without name or pattern are ignored.  ``key`` identifies the rows of ``df``.
    """
    wanted = pattern_probes(table)
    said = df.select(F.col(key).alias("_key"), _text().alias("_text"))
    # Letters in a row are only listed if an expression is looked up by them.
    grams = wanted.agg(F.array_sort(F.collect_set(F.when(F.col("kind") == "gram", F.length("probe"))))).scalar()

    def shown(kind: str, values: Column) -> Column:
        return F.transform(F.array_distinct(values), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("probe")))

    # One walk through the text for each length; cutting out every place by its number walks there each time.
    in_a_row = F.flatten(F.transform("_grams", lambda n: F.regexp_extract_all(
        F.col("_text"), F.concat(F.lit("(?s)(?=(.{"), n.cast("string"), F.lit("}))")), F.lit(1))))
    shows = F.concat(shown("word", F.split("_text", r"(?U)\W+")), shown("gram", in_a_row),
                     shown("always", F.array(F.lit(""))))
    met = (said.withColumn("_grams", grams).select("_key", F.explode(shows).alias("_shown")).select("_key", "_shown.*")
           .join(wanted, ["kind", "probe"]).groupBy("_key", "name", "pattern").agg(F.bool_or("decides").alias("decides")))
    hits = (met.join(said, "_key").filter(F.col("decides") | F.regexp_like("_text", F.concat(F.lit("(?U)"), "pattern")))
            .groupBy("_key").agg(F.array_sort(F.collect_set("name")).alias("_tags")))
    return (df.join(hits, F.col(key) == F.col("_key"), "left").drop("_key")
            .withColumn(out, F.coalesce("_tags", F.array().cast("array<string>"))).drop("_tags"))
