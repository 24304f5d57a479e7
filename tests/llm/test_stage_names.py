"""Stages hand on every column as it came, whatever it is called."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vacancylens.llm import exact_dedup, mixing

CLASHING = ["_sha", "_chars", "_copies", "_size", "_i", "_rows", "sha", "chars", "id", "row", "i", "from", "words", "copies",
            "size", "keep_id", "keep_chars", "keep_rows", "text_sha256", "group_size", "a.b", "_stays"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"Text number {i % 7} with some words about nothing in particular.", "en", f"s{i % 3}") for i in range(30)]
    rows += [(None, "Text without an id.", "en", None), (None, "Text without an id.", "en", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").select(
        "*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHING])


def own(rows):
    return all(r[c] == f"{c} of {'none' if r['doc_id'] is None else r['doc_id']}" for r in rows for c in CLASHING)


def test_distinct_rows_keep_their_columns(docs):
    kept = exact_dedup.keep_distinct(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == 8 and own(rows)


def test_mixed_rows_keep_their_columns(docs):
    mixed = mixing.mixed_documents(docs)
    rows = mixed.collect()
    assert mixed.columns == docs.columns and rows and own(rows)


def test_every_stage_but_the_last_keeps_them(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        assert own(out.collect()), name


def test_small_batches_do_not_outlive_the_operator(spark, docs):
    before = {k: spark.conf.get(k, None) for k in exact_dedup.SMALL}
    exact_dedup.exact_dedup(docs).count()
    after = {k: spark.conf.get(k, None) for k in exact_dedup.SMALL}
    assert after != exact_dedup.SMALL and all(after[k] == v for k, v in before.items() if v is not None)
