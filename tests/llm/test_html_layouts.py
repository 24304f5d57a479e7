"""Pages whose wrappers carry the words of menus and adverts."""

import pytest

from vacancylens.llm import html_main

STORY = "<p>A long story of many words that a reader came for.</p>"
WANT = "A long story of many words that a reader came for."


def said(page):
    return html_main.main_text(html_main.events(page))


@pytest.mark.parametrize("page", [
    f"<div class='content no-sidebar'><article>{STORY}</article></div>",
    f"<div id=page class='has-sidebar'><main>{STORY}</main><div class=sidebar>s</div></div>",
    f"<div class='page--with-menu'>{STORY}</div>",
    f"<article class='post category-social tag-ads'>{STORY}</article>",
    f"<div class='sidebar-right layout'><article>{STORY}</article><div class='sidebar'>s</div></div>",
    f"<form id=aspnet action='/'><nav>menu</nav><article>{STORY}</article><input></form>",
    f"<form action='/'><div>{STORY}</div><button>go</button></form><div class=menu><a>one</a><a>two</a></div>",
    f"<div class='widget'><div role=main>{STORY}</div></div>",
    f"<div class='banner-page'>{STORY}</div><div class=ad>ad</div>",
    f"<article>{STORY}<div class=related><article>teaser</article></div></article>",
    f"<article>{STORY}</article><section class=related><article>teaser</article></section>",
    f"<article>{STORY}<section id=comments><p>first, and a rather long comment that goes on</p></section></article>",
    f"<div class=menu><a>{'many links ' * 40}</a></div>{STORY}",
])
def test_wrappers_keep_the_main_part(page):
    assert said(page) == WANT


def _texts(spark, pages):
    rows = [(i, url, page) for i, (url, page) in enumerate(pages)]
    return [r.text for r in html_main.extract_main(
        spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]


def _story(i):
    letters = "".join(chr(97 + int(d)) for d in str(i))
    return f"The story {letters} is told in words of its own, {letters} and {letters}, up to the end of {letters}."


def test_menus_of_small_hosts_and_of_sections(spark):
    menu = "<div>Home Search Contact</div>"
    small = [("http://small.example/", f"{menu}<p>{_story(i)}</p>") for i in range(3)]
    inner = [("http://inner.example/", f"<article><ul><li>Home</ul><p>{_story(i)}</p></article>") for i in range(4)]
    section = [("http://big.example/", f"{menu if i < 6 else ''}<p>{_story(i)}</p>") for i in range(40)]
    shared = [("http://shared.example/", f"<article>{'<div>A shared passage</div>' if i < 4 else ''}<p>{_story(i)}</p>"
               "</article>") for i in range(12)]
    got = _texts(spark, small + inner + section + shared)
    want = [_story(i) for n in (3, 4, 40) for i in range(n)]
    assert got[:47] == want
    assert got[47:51] == [f"A shared passage {_story(i)}" for i in range(4)]  # few of the pages: the article's own


def test_near_copies_count_once(spark):
    text = "<div>" + "words of one page that is stored with another counter each time " * 3 + "</div>"
    pages = [("http://copies.example/", f"{text}<p>visits {i}</p>") for i in range(20)]
    pages += [("http://copies.example/x", f"<p>{_story(i)}</p>") for i in range(3)]
    got = _texts(spark, pages)
    assert all(t.startswith("words of one page") for t in got[:20]) and got[20] == _story(0)
