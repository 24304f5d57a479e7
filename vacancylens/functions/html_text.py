"""Texts and attributes of page elements picked by simple selectors.

A small helper of the page extraction: it reads one page and answers the few
selector forms the layouts use (tag, ``.class``, ``[attr*='v']``, descendants,
comma lists, ``::text``).  It is neither a CSS engine nor a tree library.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# An opening tag on the right ends an open element on the left.
_ENDED_BY = {
    "p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
                   "header hr main nav ol p pre section table ul".split()),
    "li": frozenset({"li"}), "option": frozenset({"option"}), "tr": frozenset({"tr"}),
    "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}),
    "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
}
_PART = re.compile(r"([\w-]+|\*)?((?:\.[\w-]+|\[[\w-]+\*?='[^']*'\])*)$")
_TEST = re.compile(r"\.([\w-]+)|\[([\w-]+)(\*?)='([^']*)'\]")


class Element:
    """A tag with its attributes; ``content`` holds texts and elements in order."""

    __slots__ = ("tag", "attrs", "parent", "content")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.content = tag, attrs, parent, []

    def elements(self):
        """This element and all below it, in document order."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.content) if isinstance(c, Element))

    def texts(self):
        """(text, element it stands in) of all text nodes, in document order."""
        stack = [(c, self) for c in reversed(self.content)]
        while stack:
            node, owner = stack.pop()
            if isinstance(node, Element):
                stack.extend((c, node) for c in reversed(node.content))
            else:
                yield node, owner


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Element("", {}, None)
        self.text = []

    def flush(self):
        if self.text:
            self.here.content.append("".join(self.text))
            self.text = []

    def handle_data(self, data):
        self.text.append(data)

    def handle_comment(self, data):
        self.flush()

    def handle_starttag(self, tag, attrs):
        self.flush()
        if tag in _ENDED_BY.get(self.here.tag, ()):
            self.here = self.here.parent
        node = Element(tag, {k: v or "" for k, v in attrs}, self.here)
        self.here.content.append(node)
        if tag not in _VOID:
            self.here = node

    def handle_endtag(self, tag):
        self.flush()
        node = self.here
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:  # else: no such open tag
            self.here = node.parent


def parse(html: str) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    builder.flush()
    return builder.root


@lru_cache(maxsize=256)
def selector(css: str):
    """Comma list -> [(compound parts, wants text, text at any depth)]."""
    chains = []
    for piece in css.split(","):
        path, text, _ = piece.strip().partition("::text")
        deep = bool(text) and (not path or path != path.rstrip())
        parts = []
        for word in path.split():
            match = _PART.match(word)
            if not match:
                raise ValueError(f"unsupported selector: {css}")
            tests = [("class", None, t[0]) if t[0] else (t[1], t[2] or "=", t[3])
                     for t in _TEST.findall(match[2])]
            parts.append((match[1] if match[1] != "*" else None, tests))
        chains.append((parts, bool(text), deep))
    return chains


def _is(node, part):
    tag, tests = part
    if tag and node.tag != tag:
        return False
    for attr, how, value in tests:
        have = node.attrs.get(attr)
        if have is None:
            return False
        if how is None and value not in have.split() or how == "*" and value not in have \
                or how == "=" and value != have:
            return False
    return True


def _matches(node, parts, scope):
    """``node`` ends the chain; its ancestors within ``scope`` fill the rest."""
    if not parts:
        return True
    if not _is(node, parts[-1]):
        return False
    left = len(parts) - 1
    while left and node is not scope:
        node = node.parent
        if _is(node, parts[left - 1]):
            left -= 1
    return not left


def select(scope: Element, css: str) -> list[Element]:
    """Elements below or at ``scope`` that match any selector of the list."""
    chains = selector(css)
    return [n for n in scope.elements() if n.tag and any(_matches(n, p, scope) for p, _, _ in chains)]


def select_texts(scope: Element, css: str) -> list[str]:
    """Text nodes picked by ``::text`` selectors, in document order."""
    chains = selector(css)
    picked = set()
    for node in scope.elements():
        for parts, _, deep in chains:
            if (node.tag or not parts) and _matches(node, parts, scope):
                picked.update(id(e) for e in (node.elements() if deep else (node,)))
    return [text for text, owner in scope.texts() if id(owner) in picked]
