"""Golden cases of the Column expressions; expected values are derived by hand."""

import datetime as dt
import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from vacancylens.config import NON_JOB_TITLES, SKILLS, CleanConfig
from vacancylens.functions import dates, links, text
from vacancylens.functions.patterns import needs
from vacancylens.functions.skills import tag_skills

NBSP = chr(0xA0)


def apply(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", f(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize("f, cases", [
    (text.clean_text, {
        None: "", "": "", "  a\n\t b ": "a b", "R&amp;D Lead": "RD Lead", "a &amp; b": "a  b",
        "it&#39;s": "it&#39;s", f"a{NBSP}{NBSP}b": "a b", "a\x1cb": "a b", f"{NBSP}x{NBSP}": "x"}),
    (text.scrub_title, {
        None: "", "Data Engineer · Full-time": "Data Engineer", "Remote Data Analyst": "",
        "Contract Manager": "", "Freelance / Project Designer": "", "IT Contractor": "IT",
        "Senior AnalystCairo": "Senior Analyst", "Sales LeadNew Cairo City": "Sales Lead",
        "Data Analyst Cairo, Egypt": "Data Analyst Cairo,", "QA Engineer BMB Drive": "QA Engineer",
        "BI Developer More Details": "BI Developer", "UI Designer Hybrid": "UI Designer",
        "Internshipart-time": "Internshi", "Web DevHYBRID team": "Web Dev"}),
    (text.clean_location, {
        None: "", "Location Maadi - Cairo - Egypt": "Maadi, Cairo, Egypt", "Al-Rehab, Egypt": "Al, Rehab, Egypt",
        ", Cairo ,": "Cairo", "Locations": "s", "a – b—c": "a, b, c"}),
    (text.location_prefix, {"Location Giza": "Giza", "location Giza": "location Giza", "Giza": "Giza"}),
    (text.strip_company, {"Acme Co - ": "Acme Co", "Acme-Co": "Acme-Co", "- ": "", "A -- -": "A"}),
    (text.non_job, {"Apply Now": True, "IT": True, "": True, "Sales": False, "home": True, "homer": False,
                    "  Read More ": True, "Meet BMBOTin our immersive reception area!": True}),
    (dates.too_old, {"4 months ago": True, "14 months ago": True, "24 months ago": True, "1 year ago": True,
                     "3 months ago": False, "12 months ago": False, "4 month ago": False}),
])
def test_text_rules(spark, f, cases):
    assert apply(spark, f, list(cases)) == list(cases.values())


def test_title_guards_never_change_a_title(spark):
    """Scrubbed titles equal the plain expressions, whatever the case of the letters."""
    words = ["on-site", "HYBRID", "More Details", "more  detail", "freelance/project", "Freelance  Project", "x·y",
             chr(0xFFFD), "on-" + chr(0x17F) + "ite", "nasr CITY", "New Cairo City", "UAE", "cairo ", "KSA", "Contract",
             "remot", "Part time", "DU" + "bai", chr(0x212A) + "sa", "BMB Reach", "IT", ""]
    titles = [f"{a} Lead {b}".strip() for a in words for b in words] + words

    def plain(c):
        for p in CleanConfig().junk_patterns:
            c = F.regexp_replace(c, f"(?isU){p}.*", "")
        c = F.regexp_replace(F.trim(c), f"(?iU)(?:{'|'.join(CleanConfig().trailing_places)})$", "")
        return F.trim(F.regexp_replace(F.trim(c), f"(?iU){CleanConfig().trailing_division}", ""))

    assert apply(spark, text.scrub_title, titles) == apply(spark, plain, titles)


def test_every_blacklisted_title_is_rejected(spark):
    assert all(apply(spark, text.non_job, [t.title() for t in NON_JOB_TITLES]))


def test_cleaning_clean_text_changes_nothing(spark):
    dirty = ["  a\n b", "R&amp;D  Lead", "Location Maadi - Cairo", "x-y", ", q ,"]
    for f in (text.clean_text, text.clean_location):
        once = apply(spark, f, dirty)
        if f is text.clean_text:
            once = apply(spark, f, once)
        assert apply(spark, f, once) == once


def test_text_lists(spark):
    lists = [["  x ", "", " ", "y"], [], ["posted", " 3 Days AGO ", "yesterday"], [" "], ["2 Yrs of exp"]]

    def run(f):
        return apply(spark, f, lists, "array<string>")

    assert run(text.join_tags) == ["x, y", "", "posted, 3 Days AGO, yesterday", "", "2 Yrs of exp"]
    assert run(text.first_text) == ["x", "", "posted", "", "2 Yrs of exp"]
    assert run(lambda c: text.pick_text(c, ("ago", "yesterday"))) == ["", "", "3 Days AGO", "", ""]
    assert run(lambda c: text.pick_text(c, ("yr", "entry"))) == ["", "", "", "", "2 Yrs of exp"]
    assert run(lambda c: text.pick_salary(c, "none")) == ["x", "none", "posted", "none", "2 Yrs of exp"]


def test_full_text_falls_back_without_trimming(spark):
    df = spark.createDataFrame(
        [([" a ", "b"], ["c"], ["z"]), (["a"], [], ["z"]), ([" "], ["c "], ["z"]), ([" "], [], [" y ", "z "])],
        "d array<string>, r array<string>, f array<string>")
    got = [r[0] for r in df.select(text.full_text(F.col("d"), F.col("r"), F.col("f"))).collect()]
    assert got == ["a b c", "a", "c", " y  z "]


BASE = dt.date(2024, 3, 31)


@pytest.mark.parametrize("said, day", [
    ("3 days ago", "2024-03-28"), ("yesterday", "2024-03-30"), ("2 weeks ago", "2024-03-31"),
    ("a month ago", "2024-03-01"), ("2 months ago", "2024-01-31"), ("1 year ago", "2023-04-01"),
    ("30+ days ago", "2024-03-01"), ("5 hours ago", "2024-03-31"), ("1 day 4 hours ago", "2024-03-31"),
    ("", None), (None, None), ("٣ days ago", "2024-03-28"), ("۱۲ days ago", "2024-03-19"),
    ("Just now", "2024-03-31"), ("99999999999999999999 days ago", None), ("99999999999 hours ago", "2024-03-31"),
    ("9999 years ago", None), ("007 days ago", "2024-03-24")])
def test_relative_date(spark, said, day):
    df = spark.createDataFrame([(said, BASE)], "t string, b date")
    got = df.select(dates.relative_date(F.col("t"), F.col("b"))).first()[0]
    assert (got and str(got)) == day


def test_week_option_and_bad_stamp(spark):
    df = spark.createDataFrame([("2 weeks ago", "2024-03-31 10:00:00"), ("1 day ago", "not a time")],
                               "t string, s string")
    run_ts = F.lit("2020-01-10 00:00:00").cast("timestamp")
    base = dates.base_date(F.col("s"), run_ts, is_text=True)
    got = [str(r[0]) for r in df.select(dates.relative_date(F.col("t"), base, weeks=True)).collect()]
    assert got == ["2024-03-17", "2020-01-09"]


PAGES = ["https://jobs.example.org", "https://jobs.example.org/", "http://a.example.org/x/y", "http://a.example.org/x/y/",
         "https://a.example.org/s?q=1&p=2", "https://a.example.org/d/e#top", "https://a.example.org/d?x=/q/r#s"]
HREFS = ["", "/p/1", "p/1", "./p", "../p", "../../../p", "p/../q", "?a=1", "#frag", "//cdn.example.org/z",
         "https://other.example.org/k?v=1#w", "mailto:x@example.org", "/a/./b/../c?u=../v#w", "a/", "..", ".",
         "p?u=1", "/"]


def test_links_resolve_like_the_standard_library(spark):
    df = spark.createDataFrame([(p, h) for p in PAGES for h in HREFS], "p string, h string")
    got = {(r[0], r[1]): r[2] for r in df.select("p", "h", links.resolve_url(F.col("h"), F.col("p"))).collect()}
    wrong = {k: (v, urljoin(*k)) for k, v in got.items() if v != urljoin(*k)}
    assert not wrong


@pytest.mark.parametrize("said, skills", [
    ("Senior Java Developer", ["Java"]), ("JavaScript", ["JavaScript"]), ("C# developer", []), ("C++ developer", []),
    ("C#/.NET", ["C#"]), ("end.network", ["C#"]), ("C++17", ["C++"]), ("node.js", ["JavaScript", "Node.js"]),
    ("vue.js", ["JavaScript", "Vue.js"]), ("github actions", ["CI/CD", "Git"]), ("NoSQL", ["NoSQL"]),
    ("go language", ["Go"]), ("Send your CV", ["Computer Vision"]), ("power  bi, PowerBI", ["Power BI"]),
    ("ci / cd", ["CI/CD"]), ("CICD", ["CI/CD"]), ("r studio", ["R"]), ("springboot", ["Spring"]),
    ("ésql sqlé sql_x", []), ("", [])])
def test_skill_tags(spark, said, skills):
    df = spark.createDataFrame([(said, None)], "title string, description string")
    assert tag_skills(df).first()["skills"] == skills


def test_guards_never_change_a_tag(spark):
    """Tags equal plain regular expressions on phrases built from the patterns."""
    phrases = []
    for pattern in SKILLS.values():
        for alternative in re.sub(r"\(\?[!:]([^()]*)\)", r"\1", pattern).split("|"):
            plain = alternative.replace(r"\b", "").replace(r"\s*/?\s*", "/").replace(r"\s+", " ") \
                .replace(r"\s*", "").replace("?", "").replace("\\", "")
            phrases += [plain, f"x {plain} y", f"{plain}s", f"pre{plain}", f"({plain})", f"{plain}, {plain}1",
                        plain.replace(" ", "\n"), plain.upper(), f"é{plain}", f"{plain}_"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(phrases)], "i int, title string") \
        .withColumn("description", F.reverse("title"))
    low = F.lower(F.concat_ws(" ", "title", "description"))
    plain = F.array_compact(F.array(*[F.when(low.rlike(f"(?U){p}"), F.lit(n)) for n, p in SKILLS.items()]))
    both = tag_skills(df.withColumn("plain", plain))
    assert both.filter("skills <> plain").count() == 0
    assert both.filter("size(plain) > 0").count() > len(SKILLS)


def test_custom_dictionary_with_constructs_that_have_no_guard(spark):
    own = {"digits": r"\d+", "either": r"[ab]x", "lazy": r"q*?z", "group": r"\b(foo|bar) baz\b", "deep": r"(a(b)c)"}
    assert [needs(p) is None for p in own.values()] == [True, True, True, False, True]
    df = spark.createDataFrame([("7 bx", "z bar baz abc"), ("none here", "")], "title string, description string")
    assert [r["skills"] for r in tag_skills(df, own).collect()] == [list(own), []]


def test_config_is_replaceable(spark):
    cfg = CleanConfig(junk_patterns=("Junior",), trailing_places=("Oslo",), non_job_titles=("nope",), min_title_length=3)
    assert apply(spark, lambda c: text.scrub_title(c, cfg), ["Cook Remote Junior x", "CookOslo"]) == \
        ["Cook Remote", "Cook"]
    assert apply(spark, lambda c: text.non_job(c, cfg), ["Nope", "ab", "abc", "home"]) == [True, True, False, False]
