"""Page extraction on small pages in the default layout, and selector cases."""

import pytest
from pyspark.sql import functions as F

from vacancylens.config import CardLayout
from vacancylens.functions import html_text as H
from vacancylens.operators import extract

CARD = """
<div class="css-pkv5jc"><h2><a class="css-o171kl" href="/jobs/p/{n}?o=1">{title} &amp; Co<b> x</b></a></h2>
 <a class="css-ipsyv7">Acme Co - </a><span class="css-16x61xq">Location Maadi, Cairo</span>
 <div>posted {posted}</div><span class="css-1lh32fc"> Full Time </span>
 <div class="css-1lh32fc a"><span>Remote</span><span> </span></div></div>"""

DETAIL = """<div class="css-n7fcne"><p>Must know <b>Python</b><p>and SQL</div>
<div class="q css-1lqavbg z"><ul><li>5 years<li>Git</ul></div>
<div class="css-rcl8e5"><span>ignored</span><span> 3 - 5 Yrs </span><span>Senior Management</span></div>
<span class="x-salary-y"> 9000 EGP </span><a class="css-1jf4wgr">sql</a><a class="my-tag">bi</a>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_listing_and_detail_to_postings(spark):
    listing = "".join([CARD.format(n=1, title="Analyst", posted="2 days ago"),
                       CARD.format(n=2, title="Engineer", posted="5 months ago"),
                       CARD.format(n=1, title="Again", posted="1 day ago"),
                       '<div class="css-pkv5jc"><h2>no link</h2></div>'])
    site = "https://jobs.example.org"
    listings = pages(spark, [(1 << 50, f"{site}/search?q=x", listing), (2, f"{site}/s", "<p>Just a moment...</p>" + listing)])
    details = pages(spark, [(7, f"{site}/jobs/p/1?o=1", DETAIL), (8, f"{site}/jobs/p/2?o=1", DETAIL),
                            (9, f"{site}/jobs/p/1?o=1", "<p>captured again</p>")])
    run = F.lit("2024-02-01 00:00:00").cast("timestamp")
    out = [r.asDict() for r in extract.extract_postings(listings, details, run).collect()]
    assert out == [{
        "seq": (1 << 50, 0), "title": "Analyst & Co", "company": "Acme Co", "location": "Maadi, Cairo",
        "experience": "3 - 5 Yrs", "job_type": "Full Time, Remote", "salary": "9000 EGP",
        "career_level": "Senior Management", "date_posted": "posted 2 days ago", "keywords": "sql, bi",
        "description": "Must know Python and SQL 5 years Git", "url": f"{site}/jobs/p/1?o=1",
        "scraped_at": "2024-02-01 00:00:00"}]


def test_fallback_cards_only_without_primary(spark):
    old = '<div class="css-1g4o566"><h2><a href="/jobs/p/5">Old</a></h2></div>'
    new = CARD.format(n=1, title="New", posted="now")
    cards = extract.extract_cards(pages(spark, [(1, "u", old), (2, "u", old + new), (3, "u", ""), (4, "u", None)]))
    got = [(r["page_id"], r["title"]) for r in extract.card_fields(cards).orderBy("page_id").collect()]
    assert got == [(1, "Old"), (2, "New & Co")]


def test_detail_without_known_blocks_uses_section_text(spark):
    html = "<section> a <p>b</p></section><article>c<script>var x='</p>';</script></article><p>out</p>"
    details = extract.detail_fields(extract.extract_details(pages(spark, [(1, "u", html)])))
    row = details.first()
    assert row["description"] == " a  b c var x='</p>';"
    assert (row["salary"], row["experience"], row["career_level"], row["keywords"]) == ("Not Specified", "", "", "")


@pytest.mark.parametrize("html, css, texts", [
    ("<p>a<p>b<b>c</b>d", "p::text", ["a", "b", "d"]),
    ("<p>a<p>b<b>c</b>d", "p ::text", ["a", "b", "c", "d"]),
    ("<div><p>a</p></div><p>b</p>", "div p::text", ["a"]),
    ("<div class='x y'>a</div><div class='xy'>b</div>", "div.x::text", ["a"]),
    ("<i data-k='abc'>1</i><i data-k='b'>2</i><i>3</i>", "i[data-k*='b']::text", ["1", "2"]),
    ("<i data-k='abc'>1</i><i data-k='b'>2</i>", "i[data-k='b']::text", ["2"]),
    ("<b>1</b><i>2</i><b>3</b>", "b::text, i::text", ["1", "2", "3"]),
    ("<div>1<div>2</div>3</div>", "div ::text", ["1", "2", "3"]),
    ("a<!-- c -->b", "::text", ["a", "b"]),
    ("a &amp; b &copy;<br>c", "::text", ["a & b ©", "c"]),
    ("<ul><li>1<li>2<ul><li>3</ul></ul>", "li::text", ["1", "2", "3"]),
    ("</p></div>x<b>y", "b::text", ["y"]),
])
def test_selectors(html, css, texts):
    assert H.select_texts(H.parse(html), css) == texts


def test_unknown_selector_form_is_refused():
    with pytest.raises(ValueError):
        H.selector("a > b::text")


def test_scope_limits_ancestors():
    root = H.parse("<h2><div><a>x</a></div></h2><div><h2><a>y</a></h2></div>")
    inner = H.select(root, "div")[0]
    assert H.select(inner, "h2 a") == [] and len(H.select(root, "h2 a")) == 2


def test_blocked_pages_are_dropped(spark):
    df = pages(spark, [(1, "u", "ACCESS Denied"), (2, "u", "fine"), (3, "u", None)])
    assert [r["page_id"] for r in extract.drop_blocked(df).collect()] == [2, 3]


def test_layout_fields_are_free(spark):
    layout = CardLayout(primary="li", fallback="p", fields={"t": extract.FieldSpec("::text")})
    cards = extract.extract_cards(pages(spark, [(1, "u", "<li>a<li>b")]), layout)
    assert [(r["pos"], r["t"]) for r in cards.orderBy("pos").collect()] == [(0, ["a"]), (1, ["b"])]
