"""Postings derived from the general test tables, as SQL for either engine.

The texts are the same for Spark and for the checking engine but for a few
function names.  A whole table feeds each view, so work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK = {
    "STR": "STRING",
    "SET_BRAND": "array_sort(collect_set(p_brand))",
    "JOIN_FLAGS": "array_join(array_sort(collect_set(l_returnflag)), ', ')",
}
CHECK = {
    "STR": "VARCHAR",
    "SET_BRAND": "list_sort(list(DISTINCT p_brand))",
    "JOIN_FLAGS": "array_to_string(list_sort(list(DISTINCT l_returnflag)), ', ')",
}

def decode(expr: str) -> str:
    """The character references of the test pages, decoded in SQL."""
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"),
                         ("&amp;", "&")):
        expr = f"replace({expr}, '{entity}', '{char}')"
    return expr


# An order is a posting, the brands of its lines are its skills.
POSTINGS = """
WITH agg AS (
  SELECT l_orderkey, {SET_BRAND} AS skills, {JOIN_FLAGS} AS job_type, max(l_shipdate) AS last_seen
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
base AS (
  SELECT o.*, c_name, c_mktsegment, n_name, r_name, skills, job_type, last_seen
  FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey LEFT JOIN agg ON o_orderkey = l_orderkey)
SELECT md5('p' || CAST(o_orderkey AS {STR})) AS job_hash,
  'Role ' || o_orderpriority || ' #' || CAST(o_orderkey AS {STR}) AS title, c_name AS company,
  CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN r_name WHEN 2 THEN n_name || ', ' || r_name
    ELSE c_mktsegment || ', ' || n_name || ', ' || r_name END AS location,
  CASE o_orderkey % 7 WHEN 0 THEN '' ELSE CAST(o_orderkey % 7 AS {STR}) || ' yrs' END AS experience,
  coalesce(job_type, '') AS job_type,
  CASE o_orderkey % 5 WHEN 0 THEN 'Not Specified' WHEN 1 THEN 'Confidential' WHEN 2 THEN ''
    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS {STR}) || ' EGP' END AS salary,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS career_level,
  skills, o_orderdate AS date_first_seen, coalesce(last_seen, o_orderdate) AS date_last_seen,
  CASE o_orderstatus WHEN 'F' THEN 'inactive' ELSE 'active' END AS status
FROM base
"""

# A document is a raw scraped posting with a dirty title, location and date text.
RAW = """
SELECT d.doc_id AS seq,
  CASE d.doc_id % 12 WHEN 0 THEN 'Data Engineer | Full-time' WHEN 1 THEN 'Remote Data Analyst'
    WHEN 2 THEN 'IT Contractor' WHEN 3 THEN 'Senior AnalystCairo' WHEN 4 THEN 'QA Engineer BMB Drive'
    WHEN 5 THEN 'Apply Now' WHEN 6 THEN 'R&amp;D  Lead' WHEN 7 THEN 'BI Developer More Details'
    WHEN 8 THEN '  Data   Scientist ' WHEN 9 THEN 'Data Analyst Cairo, Egypt'
    WHEN 10 THEN 'Java Developer Hybrid' ELSE 'Backend Developer' END AS title,
  d.source AS company,
  CASE d.doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'Location ' || n_name WHEN 2 THEN n_name || ' - ' || r_name
    WHEN 3 THEN ', ' || n_name || ' ,' ELSE 'Al-' || n_name || ', ' || r_name END AS location,
  CASE d.doc_id % 11 WHEN 0 THEN '' WHEN 1 THEN '3 days ago' WHEN 2 THEN 'yesterday' WHEN 3 THEN '2 weeks ago'
    WHEN 4 THEN 'a month ago' WHEN 5 THEN '2 months ago' WHEN 6 THEN '1 year ago' WHEN 7 THEN '5 hours ago'
    WHEN 8 THEN '30+ days ago' WHEN 9 THEN '1 day 4 hours ago' ELSE 'Just now' END AS date_posted,
  'https://jobs.example.org/p/' || md5(d.text) AS url, d.lang AS career_level,
  CASE d.doc_id % 4 WHEN 0 THEN CAST(NULL AS {STR}) WHEN 1 THEN '' ELSE '10000 EGP' END AS salary,
  CASE d.doc_id % 8 WHEN 0 THEN 'Python and SQL ' WHEN 1 THEN 'Java, not JavaScript ' WHEN 2 THEN 'C# developer '
    WHEN 3 THEN 'C++17 node.js ' WHEN 4 THEN 'Power BI excel ' WHEN 5 THEN 'github actions docker '
    WHEN 6 THEN 'machine learning cv ' ELSE '' END || d.text AS description,
  e.ts AS scraped_at
FROM documents d JOIN nation ON d.doc_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN events e ON e.event_id = d.doc_id
"""


# A detail page stands where the first link of the page leads, so that some cards lead to it.
DETAIL_URL = ("concat(regexp_extract(url, '^[a-z]+://[^/?#]*', 0), "
              + decode("regexp_extract(html, '<li><a href=\"([^\"]*)\"', 1)") + ")")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table of few files, dealt to all cores.

    The small test tables are one row group, which one task reads whatever it has to do with it.
    A table of as many files as there are cores is read as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores)


def _view(spark: SparkSession, sf_dir: str, sql: str, names: list[str]) -> DataFrame:
    # Named frames instead of temp views: nothing global, any number of folders.
    text = sql.format(**SPARK)
    for n in names:
        text = text.replace(f" {n} ", f" {{{n}}} ").replace(f" {n}\n", f" {{{n}}}\n")
    found = tables(spark, sf_dir, *names)
    return spark.sql(text, **{n: spread(df) if n == "documents" else df for n, df in found.items()})


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, POSTINGS, ["lineitem", "part", "orders", "customer", "nation", "region"])


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, RAW, ["documents", "nation", "region", "events"])
