"""Captured pages -> cards, details and raw postings.

One ``mapInArrow`` reads each page once and returns lists of texts; every rule
after that is a Column expression.  Pages are independent rows, so Spark spreads
them freely and a lost executor only repeats its own pages.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (CHALLENGE_PHRASES, DEFAULT_SALARY, EXPERIENCE_WORDS, LEVEL_WORDS,
                      DATE_TEXT_WORDS, CardLayout, DetailLayout, FieldSpec)
from ..functions import html_text as H
from ..functions import text
from ..functions.dates import too_old
from ..functions.links import resolve_url
from ..schema import RAW_POSTING
from ..session import ship_package
from .dedup import dedup_key, keep_first

_ROWS_PER_BATCH = 256


def _take(scope: H.Element, spec: FieldSpec) -> list[str | None]:
    if spec.take == "texts":
        return H.select_texts(scope, spec.css)
    picked = H.select(scope, spec.css)
    if spec.take == "attr":
        return [n.attrs.get(spec.attr) for n in picked]
    return [t for n in picked for t, _ in n.texts()]


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def build(chunk):
        return pa.RecordBatch.from_arrays(
            [pa.array(col, f.type) for col, f in zip(zip(*chunk), schema)], schema=schema)

    chunk = []
    for row in rows:
        chunk.append(row)
        if len(chunk) == _ROWS_PER_BATCH:
            yield build(chunk)
            chunk = []
    if chunk:
        yield build(chunk)


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Page, url, parsed html, and whatever columns follow."""
    for batch in batches:
        for page_id, url, html, *more in zip(*[c.to_pylist() for c in batch.columns]):
            yield page_id, url, H.parse(html), *more


def extract_cards(pages: DataFrame, layout: CardLayout = CardLayout(), *carried: str) -> DataFrame:
    """One row per card: page, position on it, and a list of texts per field.

    The fallback selector applies to pages where the primary one finds nothing.  ``carried``
    names columns of longs that the cards take over from their page.
    """
    ship_package(pages.sparkSession)
    names = list(layout.fields)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("pos", pa.int32()),
                        *[(n, pa.list_(pa.string())) for n in names], *[(c, pa.int64()) for c in carried]])

    def rows(batches):
        for page_id, url, root, *more in _pages(batches):
            found = H.select(root, layout.primary) or H.select(root, layout.fallback)
            for pos, card in enumerate(found):
                yield (page_id, url, pos, *[_take(card, layout.fields[n]) for n in names], *more)

    return pages.select("page_id", "url", "html", *carried).mapInArrow(
        lambda batches: _in_batches(rows(batches), schema), "page_id long, url string, pos int, " + ", ".join(
            [f"`{n}` array<string>" for n in names] + [f"`{c}` long" for c in carried]))


def extract_details(pages: DataFrame, layout: DetailLayout = DetailLayout(), *carried: str) -> DataFrame:
    """One row per page with a list of texts per field, and the ``carried`` columns of longs."""
    ship_package(pages.sparkSession)
    names = list(layout.fields)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()),
                        *[(n, pa.list_(pa.string())) for n in names], *[(c, pa.int64()) for c in carried]])

    def rows(batches):
        for page_id, url, root, *more in _pages(batches):
            yield (page_id, url, *[_take(root, layout.fields[n]) for n in names], *more)

    return pages.select("page_id", "url", "html", *carried).mapInArrow(
        lambda batches: _in_batches(rows(batches), schema), "page_id long, url string, " + ", ".join(
            [f"`{n}` array<string>" for n in names] + [f"`{c}` long" for c in carried]))


def is_blocked(html: Column) -> Column:
    """The page is a challenge page, not content."""
    return text.contains_any(F.lower(html), CHALLENGE_PHRASES)


def drop_blocked(pages: DataFrame) -> DataFrame:
    """Pages with content; the filter runs before any page is parsed."""
    return pages.filter(~F.coalesce(is_blocked(F.col("html")), F.lit(False)))


def card_fields(cards: DataFrame, *carried: str) -> DataFrame:
    """Lists of texts -> card columns, cards without title or link dropped."""
    posted = text.pick_text(F.col("all_text"), DATE_TEXT_WORDS)
    return require_fields(cards.select(
        "page_id", "pos", F.col("url").alias("page_url"),
        text.first_text(F.col("title")).alias("title"),
        F.coalesce(F.try_element_at("href", F.lit(1)), F.lit("")).alias("href"),
        text.strip_company(text.first_text(F.col("company"))).alias("company"),
        text.location_prefix(text.first_text(F.col("location"))).alias("location"),
        text.join_tags(F.col("job_type")).alias("job_type"),
        posted.alias("date_posted"), *carried)).withColumn("url", resolve_url(F.col("href"), F.col("page_url")))


def require_fields(cards: DataFrame) -> DataFrame:
    """Cards with a title and a link."""
    return cards.filter(text.has_text(F.col("title")) & text.has_text(F.col("href")))


def age_cut(df: DataFrame, column: str = "date_posted") -> DataFrame:
    """Rows whose date text does not say they are too old; a row without a date text stays."""
    return df.filter(~F.coalesce(too_old(F.col(column)), F.lit(False)))


def cap_text(c: Column, limit: int | None = None) -> Column:
    """The first ``limit`` characters; without a limit the whole text."""
    return c if limit is None else F.substring(c, 1, limit)


def detail_fields(details: DataFrame, limit: int | None = None, *carried: str) -> DataFrame:
    """Lists of texts -> detail columns; a ``limit`` cuts descriptions to so many characters."""
    return details.select(
        "page_id", F.col("url").alias("page_url"),
        text.pick_text(F.col("experience"), EXPERIENCE_WORDS).alias("experience"),
        text.pick_text(F.col("career_level"), LEVEL_WORDS).alias("career_level"),
        text.pick_salary(F.col("salary"), DEFAULT_SALARY).alias("salary"),
        text.join_tags(F.col("keywords")).alias("keywords"),
        cap_text(text.full_text(F.col("description"), F.col("requirements"), F.col("fallback_text")), limit)
        .alias("description"), *carried)


def join_card_detail(cards: DataFrame, details: DataFrame) -> DataFrame:
    """Cards with the fields of the page their link leads to.

    Both sides hold a URL once, so the join has no hot key.
    """
    pages = details.withColumnRenamed("page_url", "_page_url").drop("page_id")
    return (cards.join(pages, cards["url"] == pages["_page_url"], "inner")
            .withColumn("url", F.coalesce(cards["url"], "_page_url")).drop("_page_url"))


def extract_postings(listings: DataFrame, detail_pages: DataFrame, run_ts: Column | None = None,
                     cards: CardLayout = CardLayout(), details: DetailLayout = DetailLayout(),
                     limit: int | None = None) -> DataFrame:
    """Captured listing and detail pages -> raw postings.

    A link counts once, on its first card; that card is then dropped if it is too old.  Of
    several captures of a page the first counts.  Pages are read once, where they are
    scanned: only extracted fields are ever shuffled.  ``seq`` is (page, position), which orders
    arrivals whatever the numbers.
    """
    found = card_fields(extract_cards(drop_blocked(listings), cards)).withColumn("seq", F.struct("page_id", "pos"))
    found = age_cut(keep_first(found, ["url"], "seq"))
    pages = keep_first(detail_fields(extract_details(detail_pages, details), limit), ["page_url"], "page_id")
    stamp = F.date_format(F.current_timestamp() if run_ts is None else run_ts, "yyyy-MM-dd HH:mm:ss")
    return (dedup_key(join_card_detail(found, pages)).withColumn("scraped_at", stamp)
            .select(*RAW_POSTING.fieldNames()))
