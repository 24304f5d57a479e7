"""Chains of stages, each a function from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SKILLS, CleanConfig
from ..functions.skills import tag_skills
from ..operators.clean import clean_postings, label_rejects
from ..operators.dedup import dedup_url
from ..sources.csv_files import csv_backup
from ..sources.table import Batch, PostingTable

Stage = Callable[[DataFrame], DataFrame]


def build_pipeline(stages: Mapping[int, Stage] | Sequence[Stage]) -> Stage:
    """One stage out of many; a mapping runs in ascending order of its keys."""
    ordered = [stages[k] for k in sorted(stages)] if isinstance(stages, Mapping) else list(stages)

    def run(df: DataFrame) -> DataFrame:
        for stage in ordered:
            df = df.transform(stage)
        return df

    return run


def ingest_stages(cfg: CleanConfig = CleanConfig(), skills: Mapping[str, str] = SKILLS,
                  run_ts: Column | None = None) -> dict[int, Stage]:
    """The default chain up to the sinks: clean, first row per URL, tag."""
    return {
        100: lambda df: clean_postings(df, cfg, run_ts),
        200: dedup_url,
        260: lambda df: tag_skills(df, skills),
    }


def store_stages(store: PostingTable, folder: str, csv_folder: str, run_date: str, run_ts: Column,
                 batch: Batch | None = None, cfg: CleanConfig = CleanConfig(),
                 skills: Mapping[str, str] = SKILLS) -> dict[int, Stage]:
    """The whole chain with its sinks: checked rows, CSV backup, tags, store.

    Raw rows are cleaned, checked and written once, below ``folder``: what is not stored
    stands in ``rejected=true`` with its reason, and the later stages read the rest.  Each run
    needs a ``folder`` of its own that every executor can reach.
    """
    def check(df: DataFrame) -> DataFrame:
        labelled = label_rejects(df, cfg, run_ts, lengths=cfg.enforce_lengths)
        labelled = labelled.withColumn("rejected", F.col("reject_reason").isNotNull())
        labelled.write.partitionBy("rejected").parquet(f"{folder}/checked")
        kept = df.sparkSession.read.schema(labelled.schema).parquet(f"{folder}/checked")
        return kept.filter("NOT rejected").drop("rejected", "reject_reason")

    def back_up(df: DataFrame) -> DataFrame:
        csv_backup(df, csv_folder, run_date)
        return df

    def keep(df: DataFrame) -> DataFrame:
        store.append(df, run_ts, batch, cfg)
        return df

    return {100: check, 250: back_up, 260: lambda df: tag_skills(df, skills), 300: keep}
