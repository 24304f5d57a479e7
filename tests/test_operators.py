"""Operators on small hand-made frames: goldens, properties, NULL and empty input."""

import hashlib
import itertools
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vacancylens.functions.skills import skills_from_table, tag_from_table
from vacancylens.operators import analytics as A
from vacancylens.operators import clean, dedup, extract, upsert, views
from vacancylens.config import CleanConfig
from vacancylens.plans.stages import build_pipeline
from vacancylens.schema import POSTING, ensure_columns
from vacancylens.sources.readers import hash_slices, scan_active

RUN1 = "2024-02-01 00:00:00"
RUN2 = "2024-02-03 00:00:00"


def ts(s):
    return F.lit(s).cast("timestamp_ntz")


def active(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


def raw(spark, rows):
    names = ["seq", "company", "title", "location", "description", "url", "salary", "date_posted"]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows],
                                 "seq long, company string, title string, location string, description string, "
                                 "url string, salary string, date_posted string")


def job(seq, **kw):
    return {"seq": seq, "company": "c", "title": "Data Analyst", "location": "x", "url": f"u{seq}", **kw}


def test_fold_keeps_first_and_refreshes_last_even_with_null(spark):
    rows = ensure_columns(raw(spark, [job(1, description="d1", salary="s1"), job(2, description=None, salary="s2")]))
    out = as_dicts(upsert.upsert_postings(None, rows, ts(RUN1)))
    assert len(out) == 1
    assert (out[0]["url"], out[0]["description"], out[0]["salary"], out[0]["status"]) == ("u1", None, "s2", "active")


def test_upsert_column_policy(spark):
    first = ensure_columns(raw(spark, [job(1, description="old", date_posted="a"), job(2, title="Other Role")]))
    second = ensure_columns(raw(spark, [job(3, description=None, date_posted="b"), job(4, title="Third Role")]))
    stored = upsert.upsert_postings(None, first, ts(RUN1)).withColumn("status", F.lit("inactive"))
    merged = {r["title"]: r for r in upsert.upsert_postings(stored, second, ts(RUN2)).collect()}
    assert set(merged) == {"Data Analyst", "Other Role", "Third Role"}
    hit = merged["Data Analyst"]
    assert (hit["url"], hit["date_posted"], hit["description"], hit["status"]) == ("u1", "a", None, "active")
    assert (str(hit["date_first_seen"]), str(hit["date_last_seen"])) == (RUN1, RUN2)
    assert merged["Other Role"]["status"] == "inactive" and str(merged["Other Role"]["date_last_seen"]) == RUN1
    assert str(merged["Third Role"]["date_first_seen"]) == RUN2


def test_upsert_twice_changes_only_last_seen(spark):
    rows = ensure_columns(raw(spark, [job(i, title=f"Role number {i % 3}", description=str(i)) for i in range(9)]))
    once = upsert.upsert_postings(None, rows, ts(RUN1))
    twice = upsert.upsert_postings(once, rows, ts(RUN2))
    drop = "date_last_seen"
    assert sorted(map(str, once.drop(drop).collect())) == sorted(map(str, twice.drop(drop).collect()))
    assert {str(r[drop]) for r in twice.collect()} == {RUN2}
    assert twice.schema.fieldNames() == POSTING.fieldNames()


def test_job_hash_counts_null_as_empty(spark):
    df = spark.createDataFrame([(None, "t", "l"), ("", "t", "l"), ("C", "t", "l"), ("c", "t", "l")],
                               "company string, title string, location string")
    got = [r[0] for r in df.select(dedup.job_hash()).collect()]
    assert got == [hashlib.md5(k).hexdigest() for k in (b"_t_l", b"_t_l", b"C_t_l", b"c_t_l")]


def test_first_row_rules(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (5, ""), (4, "b")], "seq long, url string")
    assert sorted(r["seq"] for r in dedup.dedup_url(df).collect()) == [1, 2, 4]
    keys = spark.createDataFrame([(1, "a_b", "c", "x"), (2, "a", "b_c", "x"), (3, "a", "b_C", "x")],
                                 "seq long, company string, title string, location string")
    assert sorted(r["seq"] for r in dedup.dedup_key(keys).collect()) == [1, 3]


def test_rejects_have_one_reason_and_match_the_stored_rows(spark):
    rows = raw(spark, [
        job(1, url="same"), job(2, url="same"), job(3, title="Apply Now", url="other"), job(4, url="other"),
        job(5, company="c" * 256), job(6, title=None), job(7, salary="s" * 256, company="c" * 256),
        job(8, url=None), job(9, url="")])
    got = {r["seq"]: r["reject_reason"] for r in clean.label_rejects(rows, run_ts=ts(RUN1)).collect()}
    assert got == {1: None, 2: "duplicate", 3: "non_job", 4: None, 5: "too_long:company", 6: "non_job",
                   7: "too_long:company", 8: None, 9: "duplicate"}
    stored = clean.constraint_guard(dedup.dedup_url(clean.clean_postings(rows, run_ts=ts(RUN1))))
    assert {r["seq"] for r in stored.collect()} == {s for s, reason in got.items() if reason is None}
    strict = clean.label_rejects(rows, CleanConfig(strict_dates=True), ts(RUN1))
    assert strict.filter("seq = 1").first()["reject_reason"] == "no_date"


def test_clean_postings_accepts_a_bare_feed(spark):
    df = spark.createDataFrame([(1, " Data  Analyst "), (2, None)], "seq long, title string")
    out = as_dicts(clean.clean_postings(df, run_ts=ts(RUN1)))
    assert [(r["title"], r["company"], r["salary"], r["historical_date"]) for r in out] == \
        [("Data Analyst", "", "Not Specified", None)]


def test_stages_run_in_key_order(spark):
    df = spark.range(1).select(F.lit("a").alias("v"))
    chain = build_pipeline({200: lambda d: d.withColumn("v", F.concat("v", F.lit("c"))),
                            100: lambda d: d.withColumn("v", F.concat("v", F.lit("b")))})
    assert chain(df).first()["v"] == "abc"
    assert build_pipeline([])(df).first()["v"] == "a"


def test_dictionary_tables(spark):
    table = spark.createDataFrame([("A", "a"), ("B", "b")], "name string, pattern string")
    assert skills_from_table(table) == {"A": "a", "B": "b"}
    phrases = spark.createDataFrame([("ML", "machine learning"), ("ML", "ml"), ("Go", "go"), ("None", ""), ("Been", None)],
                                    "name string, phrase string")
    rows = raw(spark, [job(1, title="ML and machine-learning", description="go"), job(2, title="learning machine goes"),
                       job(3, title="Machine", description="Learning"), job(4, title=None, description=None)])
    got = {r["seq"]: r["skills"] for r in tag_from_table(rows, phrases).collect()}
    assert got == {1: ["Go", "ML"], 2: [], 3: ["ML"], 4: []}
    assert {tuple(r["skills"]) for r in tag_from_table(rows, phrases.limit(0)).collect()} == {()}


def test_age_cut_keeps_rows_without_a_date(spark):
    df = spark.createDataFrame([("5 months ago",), ("2 days ago",), (None,), ("",)], "date_posted string")
    assert [r[0] for r in extract.age_cut(df).collect()] == ["2 days ago", None, ""]


@pytest.mark.parametrize("n", [1, 2, 16, 100])
def test_hash_slices_take_every_key_once(spark, n):
    keys = [None, "", "0", "00", "0fff", "7fff", "8000", "ffff", "ffffff", "FFFF", "g", "é"] + [f"{i:04x}" for i in range(0, 65536, 97)]
    df = spark.createDataFrame([(k,) for k in keys], "job_hash string")
    slices = hash_slices(n)
    assert len(slices) == n
    hits = df.select(sum(F.coalesce(F.expr(s), F.lit(False)).cast("int") for s in slices).alias("n"))
    assert {r[0] for r in hits.collect()} == {1}


POSTED = "job_hash string, location string, job_type string, skills array<string>, status string, company string"


def test_views(spark):
    df = spark.createDataFrame([
        ("1", "Maadi, Cairo, Egypt", "Full Time, Remote", ["a", "b"], "active", "c"),
        ("2", "Cairo, Egypt", "Remote,", [], "active", ""),
        ("3", "Egypt", "", None, "active", ""),
        ("4", "Egypt", None, ["a", None], "active", None),
        ("5", "", "Remote", ["z"], "inactive", "c")], POSTED)
    hierarchy = {r["location"]: (r["country"], r["city"], r["area"]) for r in views.location_hierarchy(df).collect()}
    assert hierarchy == {"Maadi, Cairo, Egypt": ("Egypt", "Cairo", "Maadi"), "Cairo, Egypt": ("Egypt", "Cairo", "Unknown"),
                         "Egypt": ("Egypt", "Unknown", "Unknown")}
    parts = [tuple(r) for r in views.job_types_expanded(df).collect()]
    assert parts == [("1", "Full Time"), ("1", "Remote"), ("2", "Remote"), ("2", "")]
    assert {r["skill"]: r["frequency"] for r in views.skill_frequency(df).collect()} == {"a": 2, "b": 1, None: 1}
    assert {r["company"]: r["open_positions"] for r in views.top_companies(df).collect()} == {"": 2, "c": 1, None: 1}
    views.register_views(df.withColumns({"date_first_seen": ts(RUN1), "career_level": F.lit("x")}))
    assert spark.sql("SELECT * FROM v_skill_frequency LIMIT 1").first()["skill"] == "a"
    assert spark.sql("SELECT sum(new_jobs) FROM v_hiring_trends").first()[0] == 5


def test_scan_adds_what_a_source_lacks(spark):
    df = spark.createDataFrame([("t", "active", 1), ("u", "gone", 2)], "title string, status string, x int") \
        .withColumns({"date_first_seen": ts(RUN1), "date_last_seen": ts(RUN1)})
    out = scan_active(df)
    assert len(out.columns) == 15 and [r["title"] for r in out.collect()] == ["t"]


def test_salary_coverage(spark):
    df = active(spark, [(None,), ("",), ("Not Specified",), ("Confidential",), ("5000 EGP",)], "salary string")
    assert as_dicts(A.salary_coverage(df)) == [{"total": 5, "with_salary": 1, "without_salary": 4, "pct": 20.0}]
    assert as_dicts(A.salary_coverage(df.limit(0)))[0]["pct"] is None


def test_trend_has_no_gap_filling(spark):
    df = active(spark, [("2024-01-01 10:00:00",), ("2024-01-01 23:00:00",), ("2024-01-03 00:00:00",), (None,)],
                "t string").select(F.col("t").cast("timestamp_ntz").alias("date_first_seen"))
    assert [(str(r[0]), r[1], r[2]) for r in A.hiring_trend(df).collect()] == \
        [("2024-01-01", 2, 2), ("2024-01-03", 1, 3)]
    stats = A.trend_stats(df).first()
    assert (str(stats[0]), str(stats[1]), stats[2]) == ("2024-01-01", "2024-01-03", 1.5)


def test_cooccurrence_golden_and_repeated_skills(spark):
    df = active(spark, [(["a", "b", "c"],), (["a", "b"],), (["a"],), (None,), ([],)], "skills array<string>")
    got = {(r[0], r[1]): r[2] for r in A.skill_cooccurrence(df).collect()}
    assert got == {(s, t): 0 if s == t else 2 if {s, t} == {"a", "b"} else 1 for s in "abc" for t in "abc"}
    twice = active(spark, [(["a", "a", "b"],)], "skills array<string>")
    assert {(r[0], r[1]): r[2] for r in A.skill_cooccurrence(twice).collect()} == {
        ("a", "a"): 2, ("a", "b"): 2, ("b", "a"): 2, ("b", "b"): 0}
    assert A.skill_cooccurrence(df.limit(0)).count() == 0


def test_cooccurrence_against_brute_force(spark):
    sets = [[f"s{(i * k + k) % 11}" for k in range(1, 1 + i % 6)] for i in range(200)]
    top = 6
    multi = [s for s in sets if len(s) >= 2]
    freq = Counter(itertools.chain(*multi))
    best = [s for s, _ in sorted(freq.items(), key=lambda e: (-e[1], e[0]))[:top]]
    want = {(a, b): 0 for a in best for b in best}
    for s in multi:
        kept = [x for x in s if x in best]
        for i, j in itertools.combinations(range(len(kept)), 2):
            want[kept[i], kept[j]] += 1
            want[kept[j], kept[i]] += 1
    df = active(spark, [(s,) for s in sets], "skills array<string>")
    assert {(r[0], r[1]): r[2] for r in A.skill_cooccurrence(df, top).collect()} == want
    wide = A.cooccurrence_matrix(df, top=top)
    assert sorted(wide.columns[1:]) == sorted(best) and wide.count() == top


def test_skill_by_level_sums_to_the_filtered_rows(spark):
    df = active(spark, [("x", ["a", "b", ""]), ("y", ["a"]), ("", ["a"]), (None, ["a"]), ("y", None), ("z", ["q"])],
                "career_level string, skills array<string>")
    cells = {(r[0], r[1]): r[2] for r in A.skill_by_level(df, top=2).collect()}
    assert cells == {("a", "x"): 1, ("a", "y"): 1, ("b", "x"): 1, ("b", "y"): 0}
    wide = as_dicts(A.skill_level_crosstab(df, ["x", "y", "none"], top=2))
    assert wide == [{"skill": "a", "x": 1, "y": 1, "none": 0}, {"skill": "b", "x": 1, "y": 0, "none": 0}]


def test_shares_sum_to_100_and_top_skills_use_all_rows(spark):
    df = active(spark, [("a",)] * 3 + [("b",)] * 5 + [("",), (None,)], "career_level string")
    rows = as_dicts(A.share_by(df, "career_level"))
    assert [(r["career_level"], r["n"], r["share_pct"]) for r in rows] == [("b", 5, 62.5), ("a", 3, 37.5)]
    skills = active(spark, [(["a", ""],), (["a", "b"],), (None,), ([],)], "skills array<string>")
    assert [tuple(r) for r in A.top_skills(skills).collect()] == [("a", 2, 50.0), ("b", 1, 25.0)]
    stats = A.skill_stats(skills).first()
    assert (stats["n_skills"], stats["n_distinct_frequencies"]) == (2, 2)
    assert math.isclose(stats["avg_skills_per_job"], 4 / 3)


def test_percent_rounds_ties_to_even(spark):
    df = spark.createDataFrame([(49, 400), (51, 400), (1, 0)], "a long, b long")
    assert [r[0] for r in df.select(A.percent(F.col("a"), F.col("b"))).collect()] == [12.2, 12.8, None]


def test_company_features_and_scaling(spark):
    df = active(spark, [("c", "t", "x"), ("c", None, "x"), ("c", "t", ""), ("d", "t", None), (None, "t", "x")],
                "company string, title string, career_level string")
    assert A.career_levels(df) == ["", "x"]
    got = {r["company"]: tuple(r)[1:] for r in A.company_features(df).collect()}
    assert got == {"c": (2, 1, 2), "d": (1, 0, 0)}
    assert [r["company"] for r in A.min_volume(A.company_features(df), 2).collect()] == ["c"]
    assert sorted(map(tuple, A.level_counts(df).collect())) == [("c", "", 1), ("c", "x", 2)]
    n = spark.createDataFrame([(1, 7), (3, 7), (5, 7)], "v int, w int")
    scaled = [(round(r["v"], 6), r["w"]) for r in A.scale_features(n, ["v", "w"]).orderBy("v").collect()]
    assert scaled == [(-1.224745, 0.0), (0.0, 0.0), (1.224745, 0.0)]


def test_audit_and_schema_report(spark):
    df = active(spark, [("a", ["x"], 1), ("", None, None), (None, [], 3)], "s string, l array<string>, i int")
    assert [tuple(r) for r in A.quality_audit(df).collect()] == \
        [("s", 3, 2, 1, 33.3), ("l", 3, 2, 0, 66.7), ("i", 3, 2, 0, 66.7)]
    assert [tuple(r) for r in A.schema_report(df).collect()] == \
        [(0, "s", "string", 2), (1, "l", "array<string>", 2), (2, "i", "int", 2)]
