"""Recurrence of structure, and pages that a scanner must not read over and over."""

import random
import time

import pytest

from vacancylens.llm import html_main

FOLDER = "/root/testdata/sf0.01"


def said(spark, pages, names=True):
    rows = spark.createDataFrame([(i, u, p) for i, (u, p) in enumerate(pages)], "page_id long, url string, html string")
    gone = {r["copy"]: (set(r["template"]), set(r["few"])) for r in html_main.site_templates(rows, names=names).collect()}
    copies = html_main._plain(rows).select("page_id", "copy").collect()
    return [html_main.main_text(html_main.events(pages[r["page_id"]][1]), *gone.get(r["copy"], (set(), set())), names=names)
            for r in sorted(copies)]


def story(i):
    rng = random.Random(i)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9))) for _ in range(30))


def menu(i, n):
    """A menu with other words on every page, in elements that say nothing."""
    return "<div><div>" + "".join(f"<div><a href='/{i}-{k}'>{story(1000 * i + k).split()[0]}</a></div>" for k in range(n)) + "</div></div>"


@pytest.mark.parametrize("n", [3, 300])
def test_recurrence_alone_removes_menus_without_names(spark, n):
    pages = [("http://plain.example/", f"<body>{menu(i, 3 + i % 5)}<div><div>{story(i)}</div></div></body>") for i in range(n)]
    assert said(spark, pages, names=False) == [story(i) for i in range(n)]


def test_lists_of_links_in_an_article_and_lone_links_stay(spark):
    pages = [("http://refs.example/", f"<article><p>{story(i)}</p><ul><li><a>{story(i + 50)}</a><li><a>{story(i + 90)}</a></ul></article>")
             for i in range(5)]
    assert said(spark, pages) == [f"{story(i)} {story(i + 50)} {story(i + 90)}" for i in range(5)]
    lone = [("http://lone.example/", f"<div>{story(i)}</div><div><a>{story(i + 50)}</a></div>") for i in range(5)]
    assert said(spark, lone) == [f"{story(i)} {story(i + 50)}" for i in range(5)]


def test_a_page_that_is_mostly_links_keeps_them(spark):
    pages = [("http://index.example/", f"<div>{menu(i, 60)}</div><p>{story(i).split()[0]}</p>") for i in range(6)]
    assert all(len(t.split()) == 61 for t in said(spark, pages))


def test_recurrence_finds_most_menus_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    effects = html_main.rule_effects(pages).first()
    crowded = pages.selectExpr("regexp_extract(url, '://([^/?#]*)', 1) AS host").groupBy("host").count().filter("count >= 3")
    assert effects["recurrence"] >= crowded.agg({"count": "sum"}).first()[0] * 0.9
    assert effects["after_names"] <= effects["names"] <= effects["pages"]


@pytest.mark.parametrize("page", [
    '<a "x' * 170_000, '<a "x>' * 170_000, '<a ">" ' * 150_000 + "'", "<!" * 500_000, "<p '" * 250_000 + ">",
    '<a "><a" ' * 120_000 + "'", "<div>" * 200_000 + "<p>" * 1000, "<li><ul>" + "<b>" * 100_000 + "<li></li>" * 50_000,
    "<script>" * 100_000, '<x y="' * 100_000 + ">" * 100_000, "<" * 1_000_000, "<!--" * 250_000])
def test_a_megabyte_of_broken_markup_is_read_once(page):
    start = time.process_time()
    html_main.events(page)
    assert time.process_time() - start < 4  # a slow machine; quadratic work takes minutes


@pytest.mark.parametrize("page, want", [
    ("<p title='a > b'>x</p>y", "x y"), ('<p title="it\'s">x</p>', "x"), ("<p title='open>x</p>y", "x y"),
    ("a < b and c > d", "a < b and c > d"), ("<p>x<!-- <p>no</p> --></p>", "x"), ("<p>x<b y</p>z", "x z"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"), ("<p>x<script>if (a<b) '</p>'</script>y</p>", "xy")])
def test_tags_and_quotes(page, want):
    assert html_main.main_text(html_main.events(page)) == want
