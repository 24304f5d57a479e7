"""Every operator as a query over the test tables: name -> (spark, folder) -> DataFrame.

Results use plain types only: days and times as text, lists joined by ", ".
Each query reads whole tables, so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import DESCRIPTION_CAP, CardLayout, DetailLayout, FieldSpec
from ..functions import dates, links, text
from ..functions.skills import skills_from_table, tag_from_patterns, tag_from_table, tag_skills
from ..operators import analytics as A
from ..operators import bitmaps, clean, clusters, dedup, extract, sketches, upsert, views
from ..operators.sparse_pca import sparse_pca
from ..schema import ADDABLE_COLUMNS, ensure_columns
from ..session import settings, work_folder
from ..sources import csv_files, readers
from ..sources.live_views import LiveViews
from ..sources.table import PostingTable
from ..streaming import ingest
from ..streaming.pages import settle_postings, stream_candidates
from . import fits
from . import fixtures as fx
from .stages import build_pipeline, ingest_stages, store_stages

Query = Callable[[SparkSession, str], DataFrame]

FIRST_RUN, SECOND_RUN = "2024-02-01 00:00:00", "2024-02-03 00:00:00"
RUN_DATE = "2024-02-01"
# Limits of the fixed behaviour that the checks pass in; the library has no defaults for them.
MAX_TERMS = 100
ROLE_CLUSTERS, SEGMENTS, TERMS_EACH = 5, 3, 7

# The test pages have one layout of their own.
PAGE_CARDS = CardLayout(primary="section.jobs li", fallback="nav li", fields={
    "title": FieldSpec("a", "blocks"), "href": FieldSpec("a", "attr", "href"),
    "company": FieldSpec("a.employer::text"), "location": FieldSpec("span::text"),
    "job_type": FieldSpec("a::text"), "all_text": FieldSpec("::text")})
PAGE_DETAIL = DetailLayout(fields={
    "headline": FieldSpec("article h1::text"), "links": FieldSpec("nav a::text"),
    "description": FieldSpec("article", "blocks"), "requirements": FieldSpec("div.ad", "blocks"),
    "fallback_text": FieldSpec("nav ::text")})

# A detail page of the same layout with every field of a posting.
PAGE_POSTING = DetailLayout(fields={
    "description": FieldSpec("article", "blocks"), "requirements": FieldSpec("div.ad", "blocks"),
    "fallback_text": FieldSpec("nav ::text"), "experience": FieldSpec("article h1::text"),
    "career_level": FieldSpec("article h1::text"), "salary": FieldSpec("span.salary::text"),
    "keywords": FieldSpec("nav a::text")})


def _ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def portable(df: DataFrame) -> DataFrame:
    """Days, times and lists as text."""
    def plain(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return F.array_join(c, ", ").alias(f.name)
        return c
    return df.select(*[plain(f) for f in df.schema])


def _postings(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: f(fx.postings(spark, d))


def _active(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: f(readers.scan_active(fx.postings(spark, d), ordered=False))


def _raw(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: f(fx.raw_postings(spark, d))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return fx.spread(readers.read_pages(spark, f"{d}/pages.parquet"))


def _tagged(raw: DataFrame) -> DataFrame:
    return tag_skills(clean.clean_postings(raw, run_ts=_ts(FIRST_RUN)))


def _folded(wide: DataFrame, key: str, names: str, values: str) -> DataFrame:
    """A wide report as three columns: the key, the names of the other columns, their values."""
    others = [c for c in wide.columns if c != key]
    return wide.select(key, F.lit(", ".join(others)).alias(names),
                       F.array_join(F.array(*[F.col(f"`{c}`").cast("string") for c in others]), ", ").alias(values))


def _melted(wide: DataFrame, value: str) -> DataFrame:
    """A wide feature table as (company, feature, value) rows."""
    others = [c for c in wide.columns if c != "company"]
    return wide.unpivot("company", [F.col(f"`{c}`") for c in others], "feature", value)


def _digest(df: DataFrame, *columns: str) -> DataFrame:
    """Long texts as md5, so that results stay small."""
    return df.withColumns({c: F.md5(c) for c in columns})


# --- sources and sinks -------------------------------------------------------

def scan_active(spark, d):
    return readers.scan_active(fx.postings(spark, d))


def ensure_columns_query(spark, d):
    bare = fx.postings(spark, d).drop("salary", "skills", "experience")
    return ensure_columns(bare).select("job_hash", "title", *ADDABLE_COLUMNS)


def csv_backup(spark, d):
    folder = work_folder(spark, "csv_backup")
    csv_files.csv_backup(_tagged(fx.raw_postings(spark, d)), folder, RUN_DATE)
    return _digest(csv_files.read_csv(spark, f"{folder}/run_date={RUN_DATE}"), "description")


def csv_snapshot(spark, d):
    folder = work_folder(spark, "csv_snapshot")
    path = csv_files.csv_snapshot(readers.scan_active(fx.postings(spark, d), ordered=False), folder, RUN_DATE)
    return csv_files.read_csv(spark, path, csv_files.SCAN_COLUMNS)


def read_pages(spark, d):
    return _pages(spark, d).select("page_id", "url", F.length("html").alias("n_chars"), F.md5("html").alias("digest"))


def upsert_sink(spark, d):
    """Two sources that both number from 0, some rows with very long fields, and a batch that comes twice."""
    tagged = _tagged(_with_long_fields(fx.raw_postings(spark, d)))
    store = PostingTable(spark, work_folder(spark, "upsert_sink"), digits=1, buckets=8)
    store.append(tagged.filter("seq % 2 = 0"), _ts(FIRST_RUN), ("first", 0))
    store.compact()
    store.append(tagged.filter("seq % 2 = 1"), _ts(SECOND_RUN), ("second", 0))
    store.append(tagged.filter("seq % 2 = 0"), _ts(SECOND_RUN), ("first", 0))
    store.compact()
    return _digest(store.read(), "description")


def live_views(spark, d):
    """The counting views after three upserts, the last of which says again what half of the rows said."""
    tagged = _tagged(_with_long_fields(fx.raw_postings(spark, d)))
    live = LiveViews(PostingTable(spark, work_folder(spark, "live_views"), digits=1, buckets=8))
    live.append(tagged.filter("seq % 2 = 0"), _ts(FIRST_RUN), ("first", 0))
    live.append(tagged.filter("seq % 2 = 1"), _ts(SECOND_RUN), ("second", 0))
    live.compact()
    live.append(tagged.filter("seq % 4 = 1"), _ts(SECOND_RUN), ("second", 1))
    return live.counts()


def preview(active):
    return A.preview(active, [F.desc("date_first_seen"), "title"]).select("title", "company", "date_first_seen")


# --- pages -------------------------------------------------------------------

def _cards(spark, d):
    return extract.extract_cards(_pages(spark, d), PAGE_CARDS)


def _details(spark, d):
    return extract.extract_details(_pages(spark, d), PAGE_DETAIL)


def extract_cards(spark, d):
    return _cards(spark, d).select("page_id", "pos", text.first_text(F.col("title")).alias("title"),
                                   F.try_element_at("href", F.lit(1)).alias("href"))


def first_text(spark, d):
    return _details(spark, d).select("page_id", text.first_text(F.col("headline")).alias("headline"))


def resolve_url(spark, d):
    href = F.try_element_at("href", F.lit(1))
    word = F.substring(href, F.lit(2), F.length(href))
    form = (F.when(F.col("pos") == 0, href).when(F.col("pos") == 1, word)
            .when(F.col("pos") == 2, F.concat(F.lit("https://cdn.example.org"), href))
            .when(F.col("pos") == 3, F.concat(F.lit("//cdn.example.org"), href))
            .when(F.col("pos") == 4, F.concat(F.lit("?p="), word))
            .otherwise(F.concat(F.lit("../a/./b/../"), word)))
    return _cards(spark, d).select("page_id", "pos", links.resolve_url(form, F.col("url")).alias("link"))


def require_fields(spark, d):
    n = F.col("page_id") + F.col("pos")
    cards = extract_cards(spark, d).withColumns({
        "title": F.when(n % 3 == 0, "").otherwise(F.col("title")),
        "href": F.when(n % 5 != 0, F.col("href"))})
    return extract.require_fields(cards)


def strip_company(raw):
    ends = F.when(F.col("seq") % 3 == 0, " - ").when(F.col("seq") % 3 == 1, " --  -").otherwise("-a")
    return raw.select("seq", text.strip_company(F.concat("company", ends)).alias("company"))


def join_tags(spark, d):
    return _details(spark, d).select("page_id", text.join_tags(F.col("links")).alias("tags"))


def pick_date_text(raw):
    return raw.select("seq", text.pick_text(
        F.array("title", "location", F.upper("date_posted"), "url"), extract.DATE_TEXT_WORDS).alias("date_text"))


def age_cut(raw):
    seq = F.col("seq")
    said = (F.when(seq % 3 == 0, F.concat((seq % 30).cast("string"), F.lit(" Months ago")))
            .when(seq % 3 == 1, F.concat((seq % 30).cast("string"), F.lit(" month ago")))
            .otherwise(F.col("date_posted")))
    return extract.age_cut(raw.select("seq", said.alias("date_posted")))


def full_text(spark, d):
    none = F.array().cast("array<string>")
    bare = F.col("page_id") % 4 == 0
    return _details(spark, d).select("page_id", F.md5(text.full_text(
        F.when(bare, none).otherwise(F.col("description")), F.when(bare, none).otherwise(F.col("requirements")),
        F.col("fallback_text"))).alias("digest"))


def pick_experience(active):
    return active.select("title", text.pick_text(
        F.array("location", "job_type", "experience", "salary"), extract.EXPERIENCE_WORDS).alias("experience"))


def pick_career_level(spark, d):
    docs = fx.tables(spark, d, "documents")["documents"]
    return docs.select("doc_id", text.pick_text(F.split("text", " "), extract.LEVEL_WORDS).alias("career_level"))


def pick_salary(raw):
    texts = F.when(F.col("salary").isNull(), F.array().cast("array<string>")).otherwise(
        F.array(F.concat(F.lit(" "), "salary", F.lit("\t")), F.lit("later")))
    return raw.select("seq", text.pick_salary(texts, extract.DEFAULT_SALARY).alias("salary"))


def join_card_detail(spark, d):
    details = _details(spark, d)
    lost = F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit("/gone"))).otherwise(F.col("url"))
    cards = details.select("page_id", text.first_text(F.col("headline")).alias("title"), lost.alias("url"))
    fields = details.select("page_id", F.col("url").alias("page_url"), F.md5(text.full_text(
        F.col("description"), F.col("requirements"), F.col("fallback_text"))).alias("digest"))
    return extract.join_card_detail(cards, fields)


def _extracted(spark, d):
    pages = _pages(spark, d)
    leads = pages.withColumn("url", F.expr(fx.DETAIL_URL))
    return extract.extract_postings(pages, leads, _ts(FIRST_RUN), PAGE_CARDS, PAGE_POSTING)


def extract_postings(spark, d):
    return _digest(_extracted(spark, d).select("seq.page_id", "seq.pos", "*").drop("seq"), "description")


def stream_pages(spark, d):
    """Listing and detail pages as two streams that arrive in shuffled, opposite orders."""
    folder = work_folder(spark, "stream_pages")
    pages = _pages(spark, d).withColumn("captured_at", F.timestamp_millis(F.col("page_id") + 1_700_000_000_000))
    leads = pages.withColumn("url", F.expr(fx.DETAIL_URL))
    turn = F.pmod(F.xxhash64("page_id"), F.lit(ARRIVALS))
    for i in range(ARRIVALS):
        pages.filter(turn == i).write.mode("append").parquet(f"{folder}/listings")
        leads.filter(turn == ARRIVALS - 1 - i).write.mode("append").parquet(f"{folder}/leads")
        found = stream_candidates(*[readers.stream_pages(spark, f"{folder}/{side}", at="captured_at")
                                    for side in ("listings", "leads")], cards=PAGE_CARDS, details=PAGE_POSTING)
        with settings(spark, ingest.LARGE_STATE):  # for sessions that build_session did not make
            _started(found, folder).awaitTermination()
    return _digest(settle_postings(_taken(spark, folder), _ts(FIRST_RUN)).select("seq.page_id", "seq.pos", "*").drop("seq"),
                   "description")


def ingest_pages(spark, d):
    """From captured pages through every stage and sink; the stored table and the rejected rows."""
    folder = work_folder(spark, "ingest_pages")
    store = PostingTable(spark, f"{folder}/store", digits=1, buckets=8)
    build_pipeline(store_stages(store, folder, f"{folder}/csv", RUN_DATE, _ts(FIRST_RUN), ("pages", 0)))(
        _extracted(spark, d))
    stored = store.read().select("job_hash", "title", "job_type", "career_level", "keywords", "url", "skills",
                                 "description", F.lit(None).cast("string").alias("reject_reason"))
    rejected = (spark.read.parquet(f"{folder}/checked").filter(F.col("rejected").cast("boolean"))
                .select(F.lit(None).cast("string").alias("job_hash"), "title", "job_type", "career_level", "keywords",
                        "url", F.lit(None).cast("array<string>").alias("skills"), "description", "reject_reason"))
    backed_up = csv_files.read_csv(spark, f"{folder}/csv/run_date={RUN_DATE}").select("url", F.lit(1).alias("in_csv"))
    return _digest(stored.unionByName(rejected).join(backed_up, "url", "left"), "description")


def cap_text(spark, d):
    capped = extract.cap_text(F.col("text"), DESCRIPTION_CAP)
    return fx.tables(spark, d, "documents")["documents"].select(
        "doc_id", F.length(capped).alias("n_kept"), F.md5(capped).alias("digest"))


def stamp_scraped(raw):
    stamped = raw.withColumn("scraped_at", F.when(F.col("seq") % 3 != 0, F.col("scraped_at")))
    return clean.stamp_scraped(stamped, _ts(FIRST_RUN)).select("seq", "scraped_at")


def flag_blocked(spark, d):
    more = (F.when(F.col("page_id") % 7 == 0, "please solve the CAPTCHA")
            .when(F.col("page_id") % 7 == 3, "Just a moment...").otherwise(""))
    return _pages(spark, d).select("page_id", extract.is_blocked(F.concat("html", more)).alias("blocked"))


def location_prefix(raw):
    where = F.when(F.col("seq") % 2 == 0, F.lower("location")).otherwise(F.col("location"))
    return raw.select("seq", text.location_prefix(where).alias("location"))


# --- cleaning ----------------------------------------------------------------

def clean_text(raw):
    return _digest(raw.select("seq", *[text.clean_text(F.col(c)).alias(c) for c in (
        "title", "location", "date_posted", "salary", "description")]), "description")


def _title_op(f, end=None):
    def query(raw):
        title = text.clean_text(F.col("title"))
        return raw.select("seq", f(title if end is None else F.concat(title, end())).alias("title"))
    return query


def _place_end():
    return (F.when(F.col("seq") % 4 == 0, "Giza").when(F.col("seq") % 4 == 1, " nasr city")
            .when(F.col("seq") % 4 == 2, "New Cairo City").otherwise(" Cairo Branch"))


def _division_end():
    return (F.when(F.col("seq") % 3 == 0, " bmb Reach").when(F.col("seq") % 3 == 1, "More  Detail")
            .otherwise(" BMB Reach Team"))


def _clean_location(raw):
    return raw.select("seq", text.clean_location(F.col("location")).alias("location"))


def non_job(raw):
    title = text.scrub_title(text.clean_text(F.col("title")))
    return raw.select("seq", title.alias("title"), text.non_job(title).alias("non_job"))


def _with_long_fields(raw):
    return raw.withColumns({
        "company": F.when(F.col("seq") % 9 == 0, F.repeat("company", F.lit(90))).otherwise(F.col("company")),
        "salary": F.when(F.col("seq") % 13 == 0, F.repeat("url", F.lit(5))).otherwise(F.col("salary"))})


def rejects(raw):
    return clean.label_rejects(_with_long_fields(raw), run_ts=_ts(FIRST_RUN)).select("seq", "reject_reason")


def relative_date(raw):
    base = dates.base_date(F.col("scraped_at"), _ts(FIRST_RUN), is_text=False)
    return raw.select("seq", dates.relative_date(F.col("date_posted"), base).alias("historical_date"),
                      dates.relative_date(F.col("date_posted"), base, weeks=True).alias("with_weeks"))


def constraint_guard(raw):
    return clean.constraint_guard(ensure_columns(_with_long_fields(raw))).select("seq", "company", "salary")


def apply_defaults(raw):
    return clean.apply_defaults(raw).select("seq", "salary")


def clean_postings(raw):
    return _digest(clean.clean_postings(raw, run_ts=_ts(FIRST_RUN)).select(
        "seq", "title", "company", "location", "experience", "job_type", "salary", "career_level",
        "date_posted", "keywords", "description", "url", "historical_date"), "description")


# --- keys, skills, upsert ----------------------------------------------------

def job_hash(raw):
    return clean.clean_postings(raw, run_ts=_ts(FIRST_RUN)).select("seq", dedup.job_hash().alias("job_hash"))


def skill_dictionary(spark, d):
    nation = fx.tables(spark, d, "nation")["nation"]
    own = skills_from_table(nation.select(
        F.col("n_name").alias("name"), F.concat(F.lit(r"\b"), F.lower("n_name"), F.lit(r"\b")).alias("pattern"))
        .orderBy("name"))
    raw = fx.raw_postings(spark, d).withColumn("description", F.concat("location", F.lit(" "), "description"))
    return tag_skills(raw, own).select("seq", "skills")


def skill_table(spark, d):
    """The same dictionary as a table of phrases, met by a join."""
    phrases = fx.tables(spark, d, "nation")["nation"].select(F.col("n_name").alias("name"), F.col("n_name").alias("phrase"))
    raw = fx.raw_postings(spark, d).withColumn("description", F.concat("location", F.lit(" "), "description"))
    return tag_from_table(raw, phrases).select("seq", "skills")


# Nation names as a dictionary of expressions: as words, as letters in a row, with a class of letters.
NATION_PATTERN = ("CASE n_nationkey % 3 WHEN 0 THEN concat('\\\\b', lower(n_name), '\\\\b') WHEN 1 THEN lower(n_name) "
                  "ELSE concat('[', lower(left(n_name, 1)), ']', lower(substr(n_name, 2))) END")


def skill_patterns(spark, d):
    """A dictionary of expressions as a table, met by a join."""
    table = fx.tables(spark, d, "nation")["nation"].select(
        F.col("n_name").alias("name"), F.expr(NATION_PATTERN).alias("pattern"))
    raw = fx.raw_postings(spark, d).withColumn("description", F.concat("location", F.lit(" "), "description"))
    return tag_from_patterns(raw, table).select("seq", "skills")


def ingest_batch(raw):
    return build_pipeline(ingest_stages(run_ts=_ts(FIRST_RUN)))(raw).select("seq", "title", "location", "url", "skills")


def upsert_postings(raw):
    tagged = _tagged(_with_long_fields(raw))
    target = upsert.upsert_postings(None, tagged.filter("seq % 2 = 0"), _ts(FIRST_RUN))
    return _digest(upsert.upsert_postings(target, tagged.filter("seq % 2 = 1"), _ts(SECOND_RUN)), "description")


# --- model-based reports -----------------------------------------------------

def _skilled(postings: DataFrame) -> DataFrame:
    """Keys and skills of the active postings, derived once: a fit and its figures read them many times."""
    active = postings.filter("status = 'active'").select("job_hash", "skills")
    return kept_in(work_folder(active.sparkSession, "skilled"), active)


def tfidf_skills(postings):
    active = postings.filter("status = 'active'")
    return clusters.tfidf_skills(active, max_terms=MAX_TERMS).withColumn("weight", F.round("weight", 9))


def scale_features(active):
    features = A.min_volume(A.company_features(active))
    scaled = A.scale_features(features, [c for c in features.columns if c != "company"])
    return _melted(scaled, "z").withColumn("z", F.round("z", 9) + 0.0)


# The results of a fit are not unique; what is returned are properties that every right fit has.

def _centres(model: clusters.RoleModel, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, t, float(x)) for i, c in enumerate(model.model.clusterCenters())
                                  for (t, _), x in zip(model.terms, c) if x], "cluster int, term string, x double")


def _role_points(active: DataFrame) -> tuple[clusters.RoleModel, DataFrame]:
    model = clusters.RoleModel(active, ROLE_CLUSTERS, MAX_TERMS)
    weights = clusters.tfidf_skills(active, max_terms=MAX_TERMS).withColumnRenamed("weight", "x")
    points = model.assign(active).select("job_hash", F.col("cluster").alias("own")).join(weights, "job_hash")
    return model, kept_in(work_folder(active.sparkSession, "role_points"), points)


def role_clusters(postings):
    """Every posting with skills, whether it was given to the nearest centre, and what the clusters are worth."""
    model, points = _role_points(_skilled(postings))
    near = fits.distances(points, _centres(model, postings.sparkSession), "job_hash", "own")
    return fits.with_figures(near, fits.clustering(points, "job_hash", "own"))


def cluster_terms(postings):
    """The heaviest terms of the centres, how far each weight is off the mean of the members, and whether they are the heaviest."""
    active = _skilled(postings)
    model, points = _role_points(active)
    sizes = model.assign(active).groupBy("cluster").agg(F.count("*").alias("n"))
    means = (points.groupBy(F.col("own").alias("cluster"), "term").agg(F.sum("x").alias("s")).join(sizes, "cluster")
             .select("cluster", "term", (F.col("s") / F.col("n")).alias("mean")))
    listed = model.top_terms(active, TERMS_EACH)
    return (listed.join(means, ["cluster", "term"], "left").join(fits.heaviest(listed, means), "cluster")
            .select("cluster", "rank", (F.round(F.coalesce("mean", F.lit(0.0)) - F.col("weight"), 6) + 0.0).alias("off"),
                    "heaviest"))


def _weights(active: DataFrame) -> DataFrame:
    return clusters.tfidf_skills(active, max_terms=MAX_TERMS).withColumnRenamed("weight", "x")


def pca_2d(postings):
    """Means (0), order and width of the two projected columns."""
    active = _skilled(postings)
    vectors = clusters.tfidf_vectors(active, clusters.read_terms(active, MAX_TERMS))
    projected = kept_in(work_folder(active.sparkSession, "pca"), clusters.pca_2d(vectors).select("job_hash", "pca_1", "pca_2"))
    return fits.projection(projected, _weights(active), "job_hash")


def pca_sparse(postings):
    """The same for the iteration that suits any vocabulary, over all its terms."""
    active = _skilled(postings)
    terms = clusters.read_terms(active)
    _, projected = sparse_pca(clusters.tfidf_vectors(active, terms), len(terms))
    projected = kept_in(work_folder(active.sparkSession, "pca_sparse"), projected)
    return fits.projection(projected, clusters.tfidf_skills(active).withColumnRenamed("weight", "x"), "job_hash")


def _segments(active: DataFrame) -> tuple[DataFrame, DataFrame]:
    segments = clusters.company_segments(active, k=SEGMENTS)
    segments = kept_in(work_folder(active.sparkSession, "segments"), segments)
    columns = [c for c in segments.columns if c not in ("company", "segment")]
    points = _melted(A.scale_features(segments.drop("segment"), columns), "x").withColumnRenamed("feature", "term").join(
        segments.select("company", F.col("segment").alias("own")), "company")
    return segments, points


def _judged(segments: DataFrame, points: DataFrame) -> DataFrame:
    centres = points.groupBy(F.col("own").alias("cluster"), "term").agg(F.avg("x").alias("x"))
    return fits.with_figures(fits.distances(points, centres, "company", "own"), fits.clustering(points, "company", "own"))


def company_segments(active):
    """Every company of some size, its postings, whether its segment is the nearest, and what the segments are worth."""
    segments, points = _segments(active)
    return _judged(segments, points).join(segments.select("company", "total_jobs"), "company")


def segment_plot_data(active):
    """The plotted columns, and whether the plotted segment is the nearest."""
    segments, points = _segments(active)
    plot = clusters.segment_plot_data(segments)
    judged = _judged(segments, points.drop("own").join(plot.select("company", F.col("segment").alias("own")), "company"))
    return plot.select("company", "total_jobs", "first_level_jobs").join(
        judged.select("company", "nearest", "n_clusters", "tighter"), "company")


# --- summaries ---------------------------------------------------------------

def load_summary_sketched(active):
    """The load summary merged from one sketched row per day, next to the exact counts."""
    days = kept_in(work_folder(active.sparkSession, "days"), sketches.daily_sketches(active))
    exact = active.agg(F.countDistinct("company").alias("companies"), F.countDistinct("location").alias("locations"))
    names = A.exploded_skills(active).agg(F.countDistinct("skill")).scalar()
    figures = fits.with_figures(sketches.span_summary(days).select("jobs", *[
        F.col(c).alias(f"about_{c}") for c in ("companies", "locations", "skills")], "first_seen", "last_seen"), exact)
    figures = figures.withColumn("skills", names)
    off = 4 * sketches.relative_error()
    return figures.select("jobs", "companies", "locations", "skills", "first_seen", "last_seen", *[
        (F.abs(F.col(f"about_{c}") - F.col(c)) <= 1 + off * F.col(c)).alias(f"{c}_near")
        for c in ("companies", "locations", "skills")])


def top_parts(spark, d):
    """The parts that stand in most lines, of a column of many values, by counted candidates."""
    lines = fx.tables(spark, d, "lineitem")["lineitem"].select(F.col("l_partkey").cast("string").alias("part"))
    return sketches.proven_top(lines, "part", 20, out="lines", capacity=200)


def skill_pairs(active):
    """Co-occurrence of up to 200 skills by bitmaps."""
    return bitmaps.skill_pairs(active, 200)


def listed_titles(spark, d):
    """Raw postings whose title is on no list, a table of titles made of the postings of every third company."""
    raw = clean.clean_fields(fx.raw_postings(spark, d))
    titles = raw.filter("company IN ('src0', 'src3', 'src6') AND seq % 4 < 3").select(F.upper("title").alias("title"))
    return clean.drop_listed_titles(raw, titles).select("seq", "title")


# --- streaming ---------------------------------------------------------------

ARRIVALS = 2


def _fed(df: DataFrame, folder: str, order: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Hand ``df`` over in a few arrivals, in order, and let the stream take in each.

    The rows are derived once, into a staged table; ``start`` starts the stream anew
    each time, from the same checkpoint, as a scheduled run does.
    """
    staged = kept_in(f"{folder}/staged", df)
    low, high = staged.agg(F.min(order), F.max(order)).first()
    arrival = F.floor((F.col(order) - low) * ARRIVALS / (high - low + 1))
    source = df.sparkSession.readStream.schema(df.schema)
    for i in range(ARRIVALS):
        staged.filter(arrival == i).write.mode("append").parquet(f"{folder}/in")
        start(source.parquet(f"{folder}/in")).awaitTermination()


def kept_in(folder: str, df: DataFrame) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _started(stream: DataFrame, folder: str, mode: str = "append") -> StreamingQuery:
    """Write each micro-batch to a folder of its own; in complete mode the last one counts."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out" + ("" if mode == "complete" else f"/batch={number}"))
    return (stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state")
            .foreachBatch(write).trigger(availableNow=True).start())


def _taken(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/out")


def stream_clean(spark, d):
    folder = work_folder(spark, "stream_clean")
    _fed(fx.raw_postings(spark, d), folder, "seq",
         lambda raw: _started(ingest.stream_clean(raw, run_ts=_ts(FIRST_RUN)), folder))
    return _taken(spark, folder).select("seq", "title", "location", "historical_date", "skills")


def stream_dedup(spark, d):
    folder = work_folder(spark, "stream_dedup")
    with settings(spark, ingest.KEYED_STATE):  # for sessions that build_session did not make
        _fed(fx.raw_postings(spark, d), folder, "seq", lambda raw: _started(
            ingest.stream_dedup(clean.clean_postings(raw, run_ts=_ts(FIRST_RUN))), folder))
    return _digest(_taken(spark, folder).select(
        "seq", "title", "company", "location", "experience", "job_type", "salary", "career_level",
        "date_posted", "keywords", "description", "url", "historical_date"), "description")


def stream_upsert(spark, d):
    folder = work_folder(spark, "stream_upsert")
    store = PostingTable(spark, f"{folder}/store", digits=1, buckets=8)
    _fed(_with_long_fields(fx.raw_postings(spark, d)), folder, "seq", lambda raw: ingest.stream_upsert(
        ingest.stream_clean(raw, run_ts=_ts(FIRST_RUN)), store, f"{folder}/state", _ts(FIRST_RUN)))
    store.compact()
    return _digest(store.read(), "description")


def stream_trend(spark, d):
    folder = work_folder(spark, "stream_trend")
    posted = fx.postings(spark, d).select("job_hash", "date_first_seen", F.unix_date(
        F.to_date("date_first_seen")).alias("seq"))
    _fed(posted, folder, "seq", lambda rows: _started(ingest.stream_trend(rows), folder, "complete"))
    return _taken(spark, folder)


def _sequence() -> dict[str, Query]:
    return {
        "scan_active": scan_active,
        "ensure_columns": ensure_columns_query,
        "csv_backup": csv_backup,
        "csv_snapshot": csv_snapshot,
        "read_pages": read_pages,
        "upsert_sink": upsert_sink,
        "live_views": live_views,
        "preview": _active(preview),
        "schema_report": _active(A.schema_report),
        "extract_cards": extract_cards,
        "first_text": first_text,
        "resolve_url": resolve_url,
        "require_fields": require_fields,
        "strip_company": _raw(strip_company),
        "join_tags": join_tags,
        "pick_date_text": _raw(pick_date_text),
        "age_cut": _raw(age_cut),
        "full_text": full_text,
        "pick_experience": _active(pick_experience),
        "pick_career_level": pick_career_level,
        "pick_salary": _raw(pick_salary),
        "join_card_detail": join_card_detail,
        "extract_postings": extract_postings,
        "ingest_pages": ingest_pages,
        "cap_text": cap_text,
        "stamp_scraped": _raw(stamp_scraped),
        "flag_blocked": flag_blocked,
        "location_prefix": _raw(location_prefix),
        "clean_text": _raw(clean_text),
        "scrub_title": _raw(_title_op(text.scrub_title)),
        "strip_place": _raw(_title_op(lambda c: text.strip_place(c, clean.CleanConfig().trailing_places), _place_end)),
        "strip_division": _raw(_title_op(
            lambda c: text.strip_division(c, clean.CleanConfig().trailing_division), _division_end)),
        "clean_location": _raw(_clean_location),
        "non_job": _raw(non_job),
        "rejects": _raw(rejects),
        "relative_date": _raw(relative_date),
        "constraint_guard": _raw(constraint_guard),
        "apply_defaults": _raw(apply_defaults),
        "clean_postings": _raw(clean_postings),
        "dedup_url": _raw(lambda raw: dedup.dedup_url(raw).select("seq", "url")),
        "dedup_key": _raw(lambda raw: dedup.dedup_key(raw).select("seq", "company", "title", "location")),
        "job_hash": _raw(job_hash),
        "tag_skills": _raw(lambda raw: tag_skills(raw).select("seq", "skills")),
        "skill_dictionary": skill_dictionary,
        "skill_table": skill_table,
        "skill_patterns": skill_patterns,
        "ingest_batch": _raw(ingest_batch),
        "upsert_postings": _raw(upsert_postings),
        **{name: _postings(view) for name, view in views.VIEWS.items()},
        "load_summary": _active(A.load_summary),
        "quality_audit": _active(A.quality_audit),
        "top_companies": _active(lambda a: A.value_counts(a, "company", 20, drop_empty=False)),
        "top_skills": _active(A.top_skills),
        "skill_stats": _active(A.skill_stats),
        "top_locations": _active(lambda a: A.value_counts(a, "location", 15)),
        "career_level_share": _active(lambda a: A.share_by(a, "career_level")),
        "job_type_top": _active(lambda a: A.value_counts(a, "job_type", 10)),
        "hiring_trend": _active(A.hiring_trend),
        "trend_stats": _active(A.trend_stats),
        "salary_coverage": _active(A.salary_coverage),
        "salary_sample": _active(lambda a: A.salary_sample(a, [F.desc("date_first_seen"), "title"])),
        "skill_cooccurrence": _active(A.skill_cooccurrence),
        "cooccurrence_matrix": _active(lambda a: _folded(A.cooccurrence_matrix(a), "skill_1", "skills", "counts")),
        "experience_top": _active(lambda a: A.value_counts(a, "experience", 10)),
        "skill_by_level": _active(A.skill_by_level),
        "skill_level_crosstab": _active(lambda a: _folded(A.skill_level_crosstab(a), "skill", "levels", "counts")),
        "kpi_summary": _active(A.kpi_summary),
        "value_counts": _active(lambda a: A.value_counts(a, "salary")),
        "tfidf_skills": _postings(tfidf_skills),
        "role_clusters": _postings(role_clusters),
        "cluster_terms": _postings(cluster_terms),
        "pca_2d": _postings(pca_2d),
        "pca_sparse": _postings(pca_sparse),
        "load_summary_sketched": _active(load_summary_sketched),
        "top_parts": top_parts,
        "skill_pairs": _active(skill_pairs),
        "listed_titles": listed_titles,
        "company_features": _active(lambda a: _melted(A.company_features(a), "n")),
        "level_counts": _active(A.level_counts),
        "min_volume": _active(lambda a: _melted(A.min_volume(A.company_features(a)), "n")),
        "scale_features": _active(scale_features),
        "company_segments": _active(company_segments),
        "segment_plot_data": _active(segment_plot_data),
        "stream_clean": stream_clean,
        "stream_dedup": stream_dedup,
        "stream_pages": stream_pages,
        "stream_upsert": stream_upsert,
        "stream_trend": stream_trend,
    }


def queries() -> dict[str, Query]:
    """All registered queries, with portable result types."""
    def wrap(query: Query) -> Query:
        return lambda spark, d: portable(query(spark, d))
    return {name: wrap(query) for name, query in _sequence().items()}
