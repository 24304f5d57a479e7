"""Listing and detail pages as two streams: cards meet the pages their links lead to.

Which card of a link counts is only known when all have arrived, so the stream hands on every
meeting that may count and :func:`settle_postings` picks among them when they are read.  Whatever
the order of arrival, that gives what the batch extraction gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CardLayout, DetailLayout
from ..operators.dedup import dedup_key, keep_first
from ..operators.extract import age_cut, card_fields, detail_fields, drop_blocked, extract_cards, extract_details
from ..schema import RAW_POSTING
from .ingest import thin

_AT = "_at"


def _timed(pages: DataFrame, at: str) -> DataFrame:
    return pages.withColumn(_AT, F.unix_micros(F.col(at)))


def stream_candidates(listings: DataFrame, detail_pages: DataFrame, at: str = "captured_at", apart: str = "14 days",
                      late: str = "1 day", cards: CardLayout = CardLayout(), details: DetailLayout = DetailLayout(),
                      limit: int | None = None) -> DataFrame:
    """Cards with the fields of the page their link leads to, one row per meeting; *append* mode.

    Both sides wait for each other: a card and a page meet if they were captured at most ``apart``
    of each other (column ``at``, a timestamp), whichever comes first.  The state holds extracted fields,
    never pages, and lets go of what can meet nothing any more.  A page that comes more than ``late``
    behind the latest one is dropped.  Copies of a link on many pages are thinned out before
    they are shuffled.
    """
    found = card_fields(extract_cards(_timed(drop_blocked(listings), at), cards, _AT), _AT)
    found = thin(found.withColumn("seq", F.struct("page_id", "pos")).drop("page_id", "pos", "href", "page_url"), "url", "seq")
    pages = detail_fields(extract_details(_timed(detail_pages, at), details, _AT), limit, _AT)
    pages = thin(pages.withColumnsRenamed({"page_url": "detail_url", "page_id": "capture"}), "detail_url", "capture")
    left = found.withColumn("card_at", F.timestamp_micros(_AT)).drop(_AT).withWatermark("card_at", late)
    right = pages.withColumn("detail_at", F.timestamp_micros(_AT)).drop(_AT).withWatermark("detail_at", late)
    near = F.expr(f"url = detail_url AND detail_at >= card_at - INTERVAL {apart} AND detail_at <= card_at + INTERVAL {apart}")
    return left.join(right, near).drop("detail_url", "card_at", "detail_at")


def settle_postings(candidates: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """The raw postings among the candidates that have arrived: see ``extract_postings`` for the rules."""
    first = keep_first(candidates.withColumn("_order", F.struct("seq", "capture")), ["url"], "_order")
    stamp = F.date_format(F.current_timestamp() if run_ts is None else run_ts, "yyyy-MM-dd HH:mm:ss")
    return (dedup_key(age_cut(first)).withColumn("scraped_at", stamp).select(*RAW_POSTING.fieldNames()))
