"""Operators on conversations, pages and vectors: brute force, and the edge cases their docstrings define."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry_points
from vacancylens.llm import chat, embedding_dedup, html_main, url_filter
from vacancylens.llm.components import components

FOLDER = "/root/testdata/sf0.001"


# Chat formatting

texts = st.text(alphabet="a\\#<>/: \nturn.é", max_size=12)


@given(st.lists(st.tuples(texts, texts), max_size=6))
@settings(max_examples=200, deadline=None)
def test_turns_are_read_back(turns):
    assert chat.read_back(chat.marked_turns(turns)) == turns


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), texts), max_size=6))
@settings(max_examples=100, deadline=None)
def test_spans_of_a_template_that_appends(turns):
    done = chat.render(turns, chat.marked_turns, ["assistant"])
    assert done.first_rewrite is None and done.formatted == chat.marked_turns(turns)
    assert [s[2] for s in done.spans[1:]] == [s[3] for s in done.spans[:-1]]
    for (k, role, start, stop, a, b), (own, text) in zip(done.spans, turns):
        assert chat.read_back(done.formatted[start:stop]) == [(own, text)]
        assert (a is not None) == (own == "assistant")
        if a is not None:
            assert chat.unescape(done.formatted[a:b]) == text


def test_a_template_that_rewrites_its_history():
    def only_last_thought(turns):
        return "".join(f"[{r}]{t if i == len(turns) - 1 else t.split('|')[-1]}" for i, (r, t) in enumerate(turns))
    done = chat.render([("user", "hi"), ("assistant", "think|yes"), ("user", "so")], only_last_thought, ["assistant"])
    assert done.first_rewrite == 2 and done.formatted == "[user]hi[assistant]yes[user]so"
    assert all(s[3] <= len(done.formatted) for s in done.spans) and done.spans[0][2:4] == (0, 8)

    def twice(turns):
        return "".join(f"{t}{t};" for _, t in turns)
    assert chat.render([("assistant", "x")], twice, ["assistant"]).spans[0][4] is None


def test_chat_on_edge_cases(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, spans int"
    rows = spark.createDataFrame([
        (1, 1, "assistant", "b", "", 0), (1, 0, "user", "a", "", 0), (1, None, None, None, "", 0),
        (2, 0, "assistant", None, "", 0), (2, 0, "assistant", None, "", 0), (None, 0, "user", "lost", "", 0),
        (3, 0, "user", "x" * 200_000, "", 0)], schema)
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(rows)).collect()}
    formatted = {r.conv_id: r for r in chat.format_conversations(rows).collect()}
    assert formatted[1].formatted == "### : </turn>\n### user: a</turn>\n### assistant: b</turn>\n"
    assert {k: r.n_turns for k, r in got.items()} == {1: 3, 2: 2, None: 1, 3: 1}
    assert got[1].loss_chars == 1 and got[2].loss_chars == 0 and got[3].formatted_chars == 200_000 + 18
    assert chat.format_conversations(rows.limit(0)).count() == 0


# URL filter

def _brute_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in url_filter.RULES
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_url_filter_equals_brute_force(spark):
    odd = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q=1://", "x://a.com", "a://b.net/es/", "a://net/fr/#",
           "a://example.com?x", "a://xexample.com/en/", "a://É.com/", "a://h\n.com/é\n?", "b://cheap-pills.example.org/x"]
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url").unionByName(
        spark.createDataFrame([(None if i == 3 else -100 - i, u) for i, u in enumerate(odd)], "page_id long, url string"))
    urls = [(r.page_id, r.url) for r in pages.collect()]
    got = {r.page_id: r for r in url_filter.filter_urls(pages.selectExpr("*", "1 AS score", "'x' AS rule")).collect()}
    model = url_filter.train(url_filter.labelled_urls())
    for page, url in urls:
        host, path, rule, verdict = _brute_rule(url)
        row = got[page]
        assert (row.host, row.path, row.rule) == (host, path, rule), url
        assert row.verdict == (verdict or ("block" if model.score(host, path) >= 0.5 else "allow"))
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_url_model_on_hosts_it_has_not_seen():
    """Each fold leaves out whole words, in all their hosts."""
    table = url_filter.labelled_urls()
    words = sorted({h.split(".")[-3] for h, _, _ in table})
    right = []
    for fold in range(6):
        out = set(words[fold::6])
        model = url_filter.train([r for r in table if r[0].split(".")[-3] not in out])
        right += [(model.score(h, p) >= 0.5) == (label == 1) for h, p, label in table if h.split(".")[-3] in out]
    assert np.mean(right) > 0.85
    assert url_filter.train([]).score("a.example", "/") == 0.5 and url_filter.train(table).score("", "") == 0.0


# HTML

def said(page, template=frozenset()):
    return html_main.main_text(html_main.events(page), template)


@pytest.mark.parametrize("page, want", [
    ("", ""), ("plain  &amp; text", "plain & text"), ("<p>a<p>b", "a b"), ("<p>a<b>b</b>c<br>d</p>", "abc d"),
    ("<nav>menu</nav><article><h1>T</h1><p>x &lt;y&gt;</p></article><footer>f</footer>", "T x <y>"),
    ("<header>top</header><main><header><h1>T</h1></header>x<aside>s</aside></main>", "T x"),
    ("<body><div class='cookie-notice'>c</div><div id=sidebar>s</div>x<div role=navigation>n</div></body>", "x"),
    ("<article>a<div class=ad>ad</div><section id='comments'><p>c</p></section>b</article>", "a b"),
    ("<article>a<script>var t='</p><p>';</script><style>p{}</style><form><input>f</form>b</article>", "a b"),
    ("<article>a<!-- <p>no</p> -->b</article>", "ab"), ("<article>x<script>never closed", "x"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a b c d e"),
    ("<p title='a > b'>x</p>", "x"), ("<p>1 < 2 & 3</p>", "1 < 2 & 3"), ("<p>a\n \t b</p> c ", "a b c"),
    ("<div>" * 3000 + "deep", "deep"), ("<title>t</title>x", "x"), ("<article class=comment>no</article>x", "x"),
])
def test_main_text(page, want):
    assert said(page) == want


def test_site_template_is_deleted_and_shared_lines_stay(spark):
    line = "<p>This line stands in every article.</p>"
    pages = [(i, f"http://one.example/{i}", f"<div>Our site <i>since 1990</i></div><article><div>join us</div>{line}<p>own {i}</p>"
              "</article><p>imprint</p>") for i in range(12)]
    pages += [(100 + i, "http://two.example/", "<div>copy</div>") for i in range(30)]
    pages += [(200, None, None), (201, "http://one.example/x", ""), (None, "http://one.example/y", "<p>z</p>")]
    df = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, text string, host int")
    got = {r.page_id: r for r in html_main.extract_main(df).collect()}
    assert len(got) == len(pages)
    assert all(got[i].text == f"This line stands in every article. own {i}" for i in range(12))
    assert all(got[100 + i].text == "copy" for i in range(30))  # copies of one page are no template
    assert (got[200].text, got[201].text, got[None].text) == ("", "", "z") and got[100].n_chars == 4
    assert html_main.extract_main(df.limit(0)).count() == 0


def test_pages_of_the_test_tables(spark):
    for r in html_main.extract_main(spark.read.parquet(f"{FOLDER}/pages.parquet")).collect():
        assert r.text and "©" not in r.text and r.n_chars == len(r.text)


# Embeddings

def _brute_vectors(rows, threshold=0.9):
    good = [(i, np.array(v, float)) for i, v in rows
            if v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    n = len(good)
    near = [[len(good[a][1]) == len(good[b][1]) and a != b and
             good[a][1] @ good[b][1] / (np.linalg.norm(good[a][1]) * np.linalg.norm(good[b][1])) >= threshold
             for b in range(n)] for a in range(n)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[a], *(label[b] for b in range(n) if near[a][b])]) for a in range(n)]
    out = [(i, sum(near[a]), min(good[b][0] for b in range(n) if label[b] == label[a])) for a, (i, _) in enumerate(good)]
    bad = [(i, 0, i) for i, v in rows if i not in {g[0] for g in good}]
    return sorted(out + bad)


@pytest.mark.parametrize("tile", [4096, 16])
def test_embeddings_equal_brute_force(spark, tile):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(150):
        v = rng.normal(size=40) if i % 3 == 0 else np.array(rows[-1][1]) + rng.normal(size=40) * rng.choice([0, 0.3, 0.5])
        rows.append((i, [float(x) for x in v * rng.choice([1.0, 100.0])]))
    rows += [(500, [1.0, 0.0]), (501, [0.9, float(np.sqrt(1 - 0.81))]), (502, [0.0, 1e300]), (503, [0.0, 3e-300]),
             (504, None), (505, []), (506, [0.0, 0.0]), (507, [1.0, None]), (508, [float("nan"), 1.0]),
             (509, [float("inf"), 1.0]), (510, [-1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, node int, n_links int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.embedding_dedup(df, tile=tile).collect())
    with np.errstate(all="ignore"):
        want = dict((r[0], r) for r in _brute_vectors([r for r in rows if r[0] not in (502, 503)]))
    assert [g for g in got if g[0] < 500] == [want[g[0]] for g in got if g[0] < 500]
    assert {g[0]: g[1:] for g in got if g[0] >= 500} == {
        500: (1, 500), 501: (1, 500), 502: (1, 502), 503: (1, 502), **{i: (0, i) for i in range(504, 511)}}
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


def test_repeated_vectors_and_ids(spark):
    df = spark.createDataFrame([(2, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [2.0, 4.0])],
                               "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_dedup(df).collect())
    assert got == [(0, 3, 1, False), (1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False)]


# Components

def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 350)] + [(1, 2), (2, 3), (3, 1), (5, 5),
                                                                                      (None, 4), (2, 1), (2, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in (7, *range(300, 350))} | {1: 1, 2: 1, 3: 1}
    assert got == want


# Entry points

def test_one_query_per_operator():
    names = [n for n in entry_points.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry_points.queries()
