"""What a page costs: rules asked and hashes taken, counted, and places that say what hashes say."""

import random

import pytest

from vacancylens.llm import html_main


@pytest.fixture
def counted(monkeypatch):
    def count(owner, name):
        calls, real = [], getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda *given: calls.append(1) or real(*given))
        return calls
    return count


def test_rules_are_asked_once_for_elements_alike(counted):
    asked = counted(html_main, "_boilerplate")
    page = html_main.events("<ul class=asked>" + "<li class='asked once'>x <a href='/y'>y</a>" * 300 + "</ul><div class=ad>z</div>")
    assert html_main.main_text(page, {1}, {1}) == " ".join(["x y"] * 300)
    html_main.judged(page)
    assert len(asked) < 20


def test_text_outside_links_needs_no_builds(counted):
    page = html_main.events("<div>" + "<p>words <b>of</b> text <a>and a link</a></p>" * 200 + "</div>")
    hashed = counted(html_main.xxhash, "xxh64_intdigest")
    assert html_main.shapes(page) == {}
    assert len(hashed) <= 1  # the link's, unless it is known


def test_builds_of_links_tell_way_and_structure():
    def shapes(page):
        return set(html_main.shapes(html_main.events(page)).values())

    menu = "<div><a>x</a><a>y</a></div>"
    assert len(shapes(menu)) == 1 and shapes(menu) == shapes("<div><a href=1>p</a><a>q</a><a>r</a></div>")
    assert shapes(f"<p>text</p><section>{menu}</section>") == shapes(f"<section>{menu}</section>")
    assert not shapes(menu) & shapes(f"<section>{menu}</section>")
    assert not shapes(menu) & shapes(menu.replace("div", "ul")) and not shapes(menu) & shapes(menu.replace("<div", "<div class=c"))
    assert shapes(f"<div>{menu} text</div>") == shapes(f"<div>{menu}</div>") - {html_main.shapes(html_main.events(
        f"<div>{menu}</div>"))[0]}


def test_places_say_what_hashes_say(spark):
    """Rows come several times and from several tasks; the plain way hashes each page again."""
    rng = random.Random(9)
    parts = ["<div>Our site</div>", "<ul><li>Home<li>News</ul>", "<p>imprint</p>", "<div><div>Our site</div><p>imprint</p></div>",
             "<section><ul><li>Home<li>News</ul></section>"]
    pages = []
    for i in range(120):
        words = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(rng.randint(1, 40)))
        links = "<div>" + "".join(f"<a href='/{i}'>{rng.random()}</a>" for _ in range(rng.randint(1, 4))) + "</div>"
        story = rng.choice([f"<article>{rng.choice(parts)}<p>{words}</p></article>", f"<p>{words}</p>", f"<main>{words}</main>", ""])
        pages += [(f"http://h{i % 5}.example/", "".join([*rng.sample(parts, 3), story, links][:rng.randint(1, 5)]))] * rng.randint(1, 3)
    rows = spark.createDataFrame([(i, u, p) for i, (u, p) in enumerate(pages)], "page_id long, url string, html string").repartition(4)
    gone = {r["copy"]: (set(r["template"]), set(r["few"])) for r in html_main.site_templates(rows).collect()}
    want = {r["page_id"]: html_main.main_text(html_main.events(r["html"]), *gone.get(r["copy"], (set(), set())))
            for r in html_main._plain(rows).collect()}
    got = {r["page_id"]: r["text"] for r in html_main.extract_main(rows).collect()}
    assert got == want
    assert sum(got[i] != html_main.main_text(html_main.events(p)) for i, (_, p) in enumerate(pages)) > 50
