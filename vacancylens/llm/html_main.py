"""Main text of pages by site template removal.

Every element subtree of a page is hashed.  Spark counts, per host, on how many
different pages each hash stands; a subtree that recurs on half of them is part of the
site's template and is deleted, and so is, outside an article, a container on three pages.
A menu changes its words from page to page, not its build: subtrees whose text is all in links
are counted by their structure, too, which is tags, classes and place without the words.
Paragraphs and headings inside the article are never judged by recurrence, so a line that many
articles share stays.  What does not recur is told by its tag, role or class: adverts, forms, and the
menus of hosts with a page or two.
"""

from __future__ import annotations

import html
import re
from collections.abc import Collection, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, in_arrow, kept_table, pieces, read, text_or_empty, to_batch
from .url_filter import host_of

_START = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/><]*))")
_CLOSED = "((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"  # the rest of a tag whose quotes are closed
_REST = re.compile(_CLOSED)
_WHOLE = re.compile(f"{_START.pattern[:-1]}(?:{_CLOSED})?)")  # as _START, with such a rest
_STOP = re.compile("[<>\"']")
_BARE_STOP = re.compile("[<>]")
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")
# Names that say how the page is laid out or filed, not what the element is: no-sidebar, page--has-menu, tag-social.
_LAYOUT = re.compile(r"(?:^|[-_])(?:no|not|has|have|with|without)[-_]|^(?:category|tag|tagged|post_tag|format)[-_]")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q "
                    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
# A start tag closes an open element of these names, up to one of the others.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
           "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "body": ({"head"}, set())}
_ONLY_P = frozenset({"p"})
_P_SCOPE = frozenset("table td th caption button object template html".split())

# Elements that are never part of the text.
_DROP_TAGS = frozenset("head nav footer aside form script style noscript template iframe svg math canvas object "
                       "embed audio video select option button textarea input dialog menu title xmp".split())
_DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu "
                        "menubar toolbar".split())
_DROP_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner menu nav "
                        "navbar navigation breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent "
                        "notice notices gdpr popup modal overlay newsletter subscribe signup comment comments disqus "
                        "replies respond share sharing social related recommended pagination pager toolbar "
                        "widget".split())
# Of these, what has a text of its own that may be longer than the article.
_OWN_WORDS = frozenset("comment comments disqus replies respond related recommended cookie cookies consent gdpr "
                       "popup modal overlay newsletter".split())
# Elements that recurrence may delete inside an article; outside of it any may go.
_CONTAINERS = frozenset("div section ul ol dl table figure details fieldset center".split())
_ROOTS = frozenset("html body article main".split())

# Of these, what a page tells without its template: menus and the like by their names.
_NAMED_TAGS = frozenset("nav footer aside form dialog menu".split())

# Left out without ending the block they stand in.
_UNSEEN = frozenset("script style noscript template iframe svg math canvas object embed audio video select option "
                    "button textarea input title".split())

OPEN, CLOSE, TEXT, BREAK = 0, 1, 2, 3


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, "/" or "", tag, what follows its name) of tags in one pass; comments have no name.

    A tag ends at the first ``>`` outside quotes, or before the next ``<`` outside them.  A quote that is
    never closed is no quote, nor is any before it, so that no part of a page is read over and over.
    After ``send(place)`` the next tag starts there or later.
    """
    at, plain_until = 0, -1
    while m := (_WHOLE if at >= plain_until else _START).search(page, at):
        start, at = m.start(), m.end()
        if m.lastindex == 5:
            sent = yield start, at, m[3], m[4].lower(), m[5]
        elif m[1] or m[2]:
            end = page.find("-->" if m[1] else ">", at)
            at = len(page) if end < 0 else end + (3 if m[1] else 1)
            if end < 0 and m[2]:
                return  # nothing that ends a tag is left
            sent = yield start, at, "", "", ""
        elif m.re is _START and at >= plain_until and (rest := _REST.match(page, at)):
            at = rest.end()
            sent = yield start, at, m[3], m[4].lower(), rest[1]
        else:
            place, end = at, -1
            while end < 0:
                stop = (_BARE_STOP if place < plain_until else _STOP).search(page, place)
                if stop is None:
                    return
                if stop[0] in "<>":
                    end = stop.start()
                else:
                    closing = page.find(stop[0], stop.end())
                    if closing < 0:
                        plain_until, place = stop.end(), at
                    else:
                        place = closing + 1
            name_end = at
            at = end + (page[end] == ">")
            sent = yield start, at, m[3], m[4].lower(), page[name_end:end]
        if sent is not None:
            at = sent
            yield at, at, "", "", ""


class Traits(NamedTuple):
    """What the rules below say of all elements of a tag and its words."""

    key: bytes  # tells tags and words apart
    by_name: bool  # see ``_by_name``
    hard: bool  # boilerplate wherever it stands, and not just by name
    outside: bool  # boilerplate outside the article
    inside: bool  # boilerplate in the article, too
    main: bool  # a main part
    own: bool  # has a text of its own that may be longer than the article
    block: bool  # ends the block before it
    judged: bool  # recurrence may delete it where it is not the article's own
    container: bool  # recurrence may delete it in an article, too


def _traits(tag: str, words: tuple) -> Traits:
    by_name, outside, inside = _by_name(tag, words), _boilerplate(tag, words, False), _boilerplate(tag, words, True)
    return Traits(
        repr((tag, words)).encode(), by_name, not by_name and tag != "header" and inside, outside, inside,
        tag == "main" or ("role", "main") in words, any(w in _OWN_WORDS for _, w in words), tag not in _INLINE,
        tag not in _INLINE and tag not in _ROOTS and tag not in ("head", "title", "meta"), tag in _CONTAINERS)


@lru_cache(maxsize=4096)
def _usual(tag: str, words: tuple) -> tuple:
    return OPEN, tag, words, _traits(tag, words)


def _opening(tag: str, words: tuple) -> tuple:
    """The event; those of short names and few words are kept for the next element alike."""
    if len(tag) <= 32 and (not words or (len(words) <= 8 and all(len(w) <= 32 for _, w in words))):
        return _usual(tag, words)
    return OPEN, tag, words, _traits(tag, words)


def events(page: str) -> list[tuple]:
    """(OPEN, tag, words of class, id and role, traits), (CLOSE, tag) and (TEXT, text) in page order.

    Elements that are left open are closed where the next one implies it, or at the end.
    """
    out: list[tuple] = []
    stack: list[str] = []
    places: dict[str, list[int]] = {}  # of the open elements of each name

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            name = stack.pop()
            places[name].pop()
            out.append((CLOSE, name))

    def innermost(names) -> int:
        depth = -1
        for n in names:
            if (open_ones := places.get(n)) and open_ones[-1] > depth:
                depth = open_ones[-1]
        return depth

    def close_back_to(names, barriers) -> None:
        depth = innermost(names)
        if depth >= 0 and depth > innermost(barriers):
            close_to(depth)

    at = 0
    found = tags(page)
    for start, end, ending, tag, rest in found:
        if start > at:
            out.append((TEXT, page[at:start]))
        at = end
        if not tag:
            continue
        if ending:
            if tag not in _VOID and (open_ones := places.get(tag)):
                close_to(open_ones[-1])
            continue
        if tag in _ENDS_P and places.get("p"):
            close_back_to(_ONLY_P, _P_SCOPE)
        if tag in _CLOSES:
            close_back_to(*_CLOSES[tag])
        words = ()
        if rest and ("=" in rest) and (named := _ATTRIBUTE.findall(rest)):
            words = tuple((a[0].lower(), w) for a in named
                          for name in (a[1] or a[2] or a[3]).lower().split()
                          for w in ((name,) if _LAYOUT.search(name) else _WORD.findall(name)))
        out.append(_opening(tag, words))
        if tag in _VOID:
            out.append((CLOSE, tag))
        elif tag in _RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            out.append((CLOSE, tag))
            gt = page.find(">", end.end()) if end else -1
            at = len(page) if gt < 0 else gt + 1
            found.send(at)
        elif not rest.endswith("/") or tag in _ENDS_P or tag in _INLINE:
            if tag in places:
                places[tag].append(len(stack))
            else:
                places[tag] = [len(stack)]
            stack.append(tag)
        else:
            out.append((CLOSE, tag))
    if at < len(page):
        out.append((TEXT, page[at:]))
    close_to(0)
    return out


def digests(page: list[tuple]) -> dict[int, int]:
    """Hash of each element subtree (tag, classes, text, children) by the place of its OPEN event."""
    out: dict[int, int] = {}
    stack: list[tuple[int, xxhash.xxh64]] = []
    for i, event in enumerate(page):
        if event[0] == OPEN:
            stack.append((i, xxhash.xxh64(event[3].key)))
        elif event[0] == TEXT:
            said = " ".join(event[1].split())
            if said and stack:
                stack[-1][1].update(said.encode("utf-8", "surrogatepass"))
        else:
            start, state = stack.pop()
            digest = state.intdigest()
            out[start] = digest - (1 << 63)
            if stack:
                stack[-1][1].update(digest.to_bytes(8, "little"))
    return out


@lru_cache(maxsize=4096)
def _usual_build(tag: str, below: tuple) -> int:
    return xxhash.xxh64_intdigest(repr((tag, below)).encode("utf-8", "surrogatepass"))


def _build(tag: str, below: list[int]) -> int:
    """Hash of an element's tag and the builds of its children; small ones are kept for the next."""
    return (_usual_build if len(tag) <= 32 and len(below) <= 8 else _usual_build.__wrapped__)(tag, tuple(below))


def shapes(page: list[tuple], least: int = 2) -> dict[int, int]:
    """Hash of the structure of each block whose text is all in ``least`` links or more, by its place.

    The structure is the tags and classes on the way to the block, its own, and the tags below
    it; a run of children of one build counts once, so the number of links does not matter.
    """
    out: dict[int, int] = {}
    # Of each open element: event, way to it once it is asked for, children's builds, links, text outside links.
    stack: list[list] = [[None, 0, [], 0, False]]
    places: list[int] = [-1]
    in_link = 0

    def way_to_last() -> int:
        known = len(stack) - 1
        while stack[known][1] is None:
            known -= 1
        for k in range(known + 1, len(stack)):
            stack[k][1] = xxhash.xxh64_intdigest(stack[k - 1][1].to_bytes(8, "little") + stack[k][0][3].key)
        return stack[-1][1]

    for i, event in enumerate(page):
        if event[0] == OPEN:
            stack.append([event, None, [], 0, False])
            places.append(i)
            in_link += event[1] == "a"
        elif event[0] == TEXT:
            if not in_link and not event[1].isspace():
                stack[-1][4] = True
        else:
            opened, _, below, links, plain = stack[-1]
            tag = event[1]
            if tag == "a":
                in_link -= 1
                links += 1
            if plain:  # so is all that it stands in, which needs no build
                stack.pop()
                places.pop()
                stack[-1][4] = True
                continue
            build = _build(tag, below)
            if links >= least and opened[3].block and tag not in _ROOTS:
                out[places[-1]] = xxhash.xxh64_intdigest(repr((way_to_last(), build)).encode()) - (1 << 63)
            stack.pop()
            places.pop()
            over = stack[-1]
            if not over[2] or over[2][-1] != build:
                over[2].append(build)
            over[3] += links
    return out


def _boilerplate(tag: str, words: tuple, inside: bool, names: bool = True) -> bool:
    if not names:
        return tag in _DROP_TAGS and tag not in _NAMED_TAGS
    if tag in _DROP_TAGS or (tag == "header" and not inside):
        return True
    if tag in _ROOTS:
        return tag == "article" and any(w in _DROP_WORDS for k, w in words if k != "role")
    return any(w in _DROP_ROLES if k == "role" else w in _DROP_WORDS for k, w in words)


def _by_name(tag: str, words: tuple) -> bool:
    """Whether only class, id or a form tag tells that an element is boilerplate."""
    return ((tag not in _DROP_TAGS or tag == "form") and _boilerplate(tag, words, True)
            and not any(k == "role" and w in _DROP_ROLES and w != "form" for k, w in words))


def _spared(page: list[tuple]) -> set[int]:
    """Places of the elements that class, id or a form tag calls boilerplate, but that hold the page's main part.

    That is a ``main``, or the longest article or half of the text of all articles, unless
    the element stands in an article itself; or more than half of the page's text (nine
    tenths for comments and the like, and on pages with an article or main).  Text of links
    does not count.
    """
    if not any(event[0] == OPEN and event[3].by_name for event in page):
        return set()
    named: list[tuple] = []
    all_articles: list[int] = []
    # Of each open element: place, traits, article, chars, holds main, articles' chars, articles' most, inside.
    stack: list[list] = [[-1, None, False, 0, False, 0, -1, 0]]
    hard = links = inside = 0
    found_main = False
    for i, event in enumerate(page):
        if event[0] == OPEN:
            tag, traits = event[1], event[3]
            article = tag == "article" and not traits.by_name
            stack.append([i, traits, article, 0, traits.main, 0, -1, inside])
            hard += traits.hard
            links += tag == "a"
            inside += article
        elif event[0] == TEXT:
            if not hard and not links:
                stack[-1][3] += len("".join(event[1].split()))
        else:
            at, traits, article, chars, has_main, total, most, within = stack.pop()
            links -= event[1] == "a"
            hard -= traits.hard
            inside -= article
            if hard or traits.hard:
                continue
            if traits.by_name:
                named.append((at, chars, has_main, total, most, within, traits.own))
            if article and not within:
                total, most = total + chars, max(most, chars)
                all_articles.append(chars)
            found_main |= has_main
            over = stack[-1]
            over[3] += chars
            over[4] |= has_main
            over[5] += total
            over[6] = max(over[6], most)
    whole = stack[0][3]
    rooted = found_main or bool(all_articles)
    return {at for at, chars, has_main, total, most, within, own in named
            if has_main or (most >= 0 and not within and (most == max(all_articles) or 2 * total >= sum(all_articles)))
            or chars > whole * (0.9 if own or rooted else 0.5)}


def _kept(page: list[tuple], names: bool = True) -> list[tuple[int, tuple, bool]]:
    """Events that boilerplate rules leave, with whether they stand in the article (or main part).

    A block that is left out leaves a BREAK.
    """
    # The article is where the text is; without one the main part; without that the body.
    spared = _spared(page) if names else set()
    roots, dropped = set(), 0
    if names:
        for i, event in enumerate(page):
            if event[0] == OPEN:
                traits = event[3]
                if dropped or (traits.inside and i not in spared):
                    dropped += 1
                elif event[1] == "article":
                    roots.add("article")
                elif traits.main:
                    roots.add("main")
            elif event[0] == CLOSE and dropped:
                dropped -= 1
    root = "article" if "article" in roots else "main" if roots else None
    out: list[tuple[int, tuple, bool]] = []
    stack, inside, dropped = [], 0, 0
    wanted = root is None
    for i, event in enumerate(page):
        if event[0] == OPEN:
            if dropped:
                dropped += 1
                continue
            tag, traits = event[1], event[3]
            if ((traits.inside if inside else traits.outside) and i not in spared) if names else _boilerplate(
                    tag, event[2], False, False):
                dropped = 1
                if tag not in _UNSEEN:
                    out.append((i, (BREAK, tag), wanted))
                continue
            opens = root is not None and (tag == root or (root == "main" and traits.main))
            stack.append(opens)
            if opens:
                inside += 1
                wanted = True
            out.append((i, event, wanted))
        elif event[0] == CLOSE:
            if dropped:
                dropped -= 1
                continue
            out.append((i, event, wanted))
            if stack.pop():
                inside -= 1
                wanted = inside > 0
        elif not dropped:
            out.append((i, event, wanted))
    return out


def main_text(page: list[tuple], template: frozenset | set = frozenset(),
              few: frozenset | set = frozenset(), names: bool = True) -> str:
    """The article's blocks in page order, joined by blanks; subtrees of the template are left out.

    ``few`` has subtrees that stand on some pages only, and structures of links that recur: of these,
    blocks outside an article go, unless that takes more than half of the text.  A page that is
    nothing but template keeps its text.  Without ``names`` only recurrence tells what is boilerplate,
    and an article is an element like others.
    """
    hashed, built = (digests(page), shapes(page)) if template or few else ({}, {})
    return _text_without(
        page, _kept(page, names), {i for i, d in hashed.items() if d in template}, {i for i, d in hashed.items() if d in few},
        {i for i, d in built.items() if d in few}, names)


def _text_without(page: list[tuple], kept: list[tuple], template: Collection[int], few: Collection[int],
                  linked: Collection[int], names: bool = True) -> str:
    """``main_text`` by the places of subtrees in the template, of those on some pages, and of links that recur."""
    body_is_known = names and bool(template or few or linked) and _has_root(page)
    said = _said(kept, body_is_known, template, (), ())
    if not said and template:
        return _said(kept, body_is_known, (), (), ())
    less = _said(kept, body_is_known, template, few, linked) if few or linked else said
    return less if 2 * len(less) >= len(said) else said


def _has_root(page: list[tuple]) -> bool:
    return any(e[0] == OPEN and (e[3].main or e[1] == "article") for e in page)


def judged(page: list[tuple], kept: list[tuple] | None = None) -> set[int]:
    """Places of the elements that recurrence may delete: all blocks but an article's own paragraphs and headings.

    ``kept`` is what ``_kept`` says of the page, if it is known.
    """
    own = set()
    if _has_root(page):
        own = {i for i, event, wanted in (_kept(page) if kept is None else kept)
               if wanted and event[0] == OPEN and not event[3].container}
    return {i for i, event in enumerate(page) if event[0] == OPEN and event[3].judged and i not in own}


def _said(kept: list[tuple], has_root: bool, template: Collection[int], few: Collection[int], linked: Collection[int]) -> str:
    blocks, current, gone = [], [], 0
    for i, event, wanted in kept:
        if gone:
            gone += (event[0] == OPEN) - (event[0] == CLOSE)
            continue
        if event[0] == TEXT:
            if wanted:
                current.append(event[1])
            continue
        if current and event[1] not in _INLINE:
            blocks.append("".join(current))
            current = []
        if (i in template or i in few or i in linked) and event[0] == OPEN and event[1] not in _ROOTS:
            body, container = wanted and has_root, event[3].container
            if (i in template and (container or not body)) or (
                    i in few and container and not body) or (i in linked and not body):
                gone = 1
    blocks.append("".join(current))
    joined = [" ".join(html.unescape(b).split()) for b in blocks]
    return " ".join(b for b in joined if b)


# Main texts of so many words that differ in numbers only are near copies.
_NEAR_WORDS = 20


def _plain(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, host, copy``: equal pages of a host have equal copies."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        text_or_empty("html").alias("html"), host_of(F.col("url")).alias("host")).withColumn(
                            "copy", F.xxhash64("host", "html"))


def _recurring(pages: DataFrame, share: float, least: int, names: bool) -> DataFrame:
    """``site, subtree, links, copy, places, most``: subtrees that recur on a host, for each different page with them.

    ``places`` are those where a rule by name leaves the subtree (without ``names`` all), so that the page
    need not be hashed again; ``most`` tells whether it is on ``share`` of the host's pages.
    """
    schema = pa.schema([("site", pa.int64()), ("subtree", pa.int64()), ("links", pa.bool_()), ("copy", pa.int64()),
                        ("main", pa.int64()), ("places", pa.list_(pa.int32()))])
    whole = 0  # stands for the page itself

    def task(batches: Batches) -> Batches:
        done = set()  # a page stored many times leaves each task once
        for batch in pieces(batches, 500):
            sites, subtrees, links, copies, mains, places = [], [], [], [], [], []
            for site, copy, text in zip(*(c.to_pylist() for c in batch.columns)):
                if copy in done:
                    continue
                done.add(copy)
                parsed = events(text)
                kept = _kept(parsed)
                judged_at = judged(parsed, kept) if names else range(len(parsed))
                left = {i for i, event, _ in kept if event[0] == OPEN} if names else judged_at
                found: dict[int, list[int]] = {whole: []}
                built: dict[int, list[int]] = {}
                for hashes, at in ((digests(parsed), found), (shapes(parsed), built)):
                    for i, d in hashes.items():
                        if i in judged_at:
                            here = at.setdefault(d, [])
                            if i in left:
                                here.append(i)
                words = re.sub(r"\d+", "", _text_without(parsed, kept, (), (), ())).split()
                main = copy
                if len(words) >= _NEAR_WORDS:
                    main = xxhash.xxh64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")) - (1 << 63)
                n = len(found) + len(built)
                sites += [site] * n
                subtrees += [*found, *built]
                links += [False] * len(found) + [True] * len(built)
                copies += [copy] * n
                mains += [main] * n
                places += [*found.values(), *built.values()]
            yield to_batch(schema, sites, subtrees, links, copies, mains, places)

    plain = _plain(pages).filter("host <> ''").select(F.xxhash64("host").alias("site"), "copy", "html")
    seen = kept_table(in_arrow(plain, task, "site long, subtree long, links boolean, copy long, main long, places array<int>"),
                      "site-subtrees")
    counted = (seen.select("site", "subtree", "links", "main").distinct().groupBy("site", "subtree", "links")
               .agg(F.count("*").alias("n")).filter(F.col("n") >= least))
    counted = kept_table(counted, "site-counts")
    totals = counted.filter(F.col("subtree") == whole).select("site", F.col("n").alias("_pages"))
    recurring = counted.filter(F.col("subtree") != whole).join(totals, "site").select(
        "site", "subtree", "links", (~F.col("links") & (F.col("n") >= F.col("_pages") * share)).alias("most"))
    return seen.drop("main").join(recurring, ["site", "subtree", "links"])


def site_templates(pages: DataFrame, share: float = 0.5, least: int = 3, names: bool = True) -> DataFrame:
    """``copy, template, few``: of each different page with a host, the hashes of its subtrees that recur there.

    A subtree recurs if it stands on at least ``least`` different pages of its host;
    ``template`` has those on ``share`` of them, ``few`` the others and all structures of links that recur.  Copies of a page count
    once, and so do pages whose main texts, of 20 words at least, differ in numbers only.
    Only what a rule may delete is counted, which without ``names`` is everything.  A list is bounded by the subtrees of its page, whatever the host.
    """
    return _recurring(pages, share, least, names).groupBy("copy").agg(
        F.collect_set(F.when(F.col("most"), F.col("subtree"))).alias("template"),
        F.collect_set(F.when(~F.col("most"), F.col("subtree"))).alias("few"))


def _template_places(pages: DataFrame, share: float, least: int) -> DataFrame:
    """``copy, template, few, linked``: as ``site_templates``, with the places on the page; structures of links apart."""
    def places(which):  # a page that several tasks have seen has its places from each
        return F.flatten(F.collect_set(F.when(which, F.col("places"))))

    most, links = F.col("most"), F.col("links")
    return _recurring(pages, share, least, True).filter(F.size("places") > 0).groupBy("copy").agg(
        places(most).alias("template"), places(~most & ~links).alias("few"), places(links).alias("linked"))


def extract_main(pages: DataFrame, share: float = 0.5, least: int = 3) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page row.

    A NULL or empty page has an empty text.  Repeated rows give equal rows, other columns
    are ignored, an empty table gives no rows.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    packed = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("copy", pa.int64()), ("html", pa.binary())])

    def pack(batches: Batches) -> Batches:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield to_batch(packed, *batch.columns[:3], [
                squeeze.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column(3)])

    def task(batches: Batches) -> Batches:
        for batch in pieces(batches, 500):
            ids, urls, packed, *lists = (c.to_pylist() for c in batch.columns)
            said = []
            for p, *places in zip(packed, *lists):
                parsed = events(zstandard.decompress(p).decode("utf-8", "surrogatepass"))
                said.append(_text_without(parsed, _kept(parsed), *(frozenset(at or ()) for at in places)))
            yield to_batch(schema, ids, urls, said, [len(s) for s in said])

    templates = kept_table(_template_places(pages, share, least), "site-templates")
    # Pages meet their lists by a shuffle: they take it compressed.
    small = in_arrow(_plain(pages).select("page_id", "url", "copy", "html"), pack,
                     "page_id long, url string, copy long, html binary")
    joined = small.join(templates, "copy", "left").select("page_id", "url", "html", "template", "few", "linked")
    return in_arrow(joined, task, "page_id long, url string, text string, n_chars long")


def rule_effects(pages: DataFrame, share: float = 0.5, least: int = 3) -> DataFrame:
    """One row: ``pages`` with a host, and how many of them recurrence alone and names alone change.

    Both are counted against the text without scripts and the like.
    """
    schema = pa.schema([("recurrence", pa.bool_()), ("names", pa.bool_()), ("after_names", pa.bool_())])

    def task(batches: Batches) -> Batches:
        for batch in pieces(batches, 500):
            out = []
            for text, gone, some in zip(*(c.to_pylist() for c in batch.columns)):
                parsed, gone, some = events(text), set(gone or ()), set(some or ())
                bare, named = main_text(parsed, names=False), main_text(parsed)
                out.append((main_text(parsed, gone, some, names=False) != bare, named != bare,
                            main_text(parsed, gone, some) != named))
            if out:
                yield to_batch(schema, *(list(c) for c in zip(*out)))

    templates = kept_table(site_templates(pages, share, least, names=False), "site-templates")
    joined = _plain(pages).filter("host <> ''").join(templates, "copy", "left").select("html", "template", "few")
    return in_arrow(joined, task, "recurrence boolean, names boolean, after_names boolean").agg(
        F.count("*").alias("pages"), *[F.count_if(c).alias(c) for c in ("recurrence", "names", "after_names")])


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main(read(spark, folder, "pages"))
