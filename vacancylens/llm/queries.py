"""Queries of the operators and their SQL: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, chat, embedding_dedup, exact_dedup, html_main, language_id, line_quality, mixing, simhash,
               spelling, substring_dedup, url_filter, whitening)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_chat_format": chat.op1_chat_format,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_substring_dedup": substring_dedup.op3_substring_dedup,
        "op4_url_filter": url_filter.op4_url_filter,
        "op5_language_id": language_id.op5_language_id,
        "op6_embedding_dedup": embedding_dedup.op6_embedding_dedup,
        "op7_bpe": bpe.op7_bpe,
        "op8_simhash_dedup": simhash.op8_simhash_dedup,
        "op9_html_extraction": html_main.op9_html_extraction,
        "op10_mixing": mixing.op10_mixing,
        "op11_line_quality": line_quality.op11_line_quality,
        "op12_embedding_whitening": whitening.op12_embedding_whitening,
        "op13_spelling_variants": spelling.op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": chat.OP1_SQL, "op2_exact_dedup": exact_dedup.OP2_SQL,
            "op11_line_quality": line_quality.OP11_SQL, "op13_spelling_variants": spelling.OP13_SQL}
