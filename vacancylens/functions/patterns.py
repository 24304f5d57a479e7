"""What a regular expression needs in a text before it can match.

Searching for a word or a substring costs a fraction of running an expression;
where a need is absent, the expression need not run.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# Constructs that are not read below; such an expression always runs.
_UNREAD = re.compile(r"\[|\{|\(\?[^:!]|\\[^bsw+.#]|(?<!\\)[?*+][?+]|[$^]")
_PIECE = re.compile(r"(\\b)|(\\s\+?(?![*?]))|(\\[sw][*?+]?|\n)|(\\?.)([?*+]?)", re.S)
_EDGE, _GAP = "\x00", "\n"


@dataclass(frozen=True)
class Need:
    """What any match of one alternative must contain."""

    words: tuple[str, ...] = ()
    substring: str = ""
    exact: bool = False
    """The word alone decides; the expression need not run."""


def _needs_of(alternative: str) -> Need | None:
    flat = ""
    for edge, space, gap, char, repeat in _PIECE.findall(alternative):
        if edge:
            flat += _EDGE
        elif space:
            flat += _EDGE + _GAP + _EDGE
        elif gap or char == "." or repeat in ("?", "*"):
            flat += _GAP
        else:
            plain = char[-1]
            flat += plain if re.match(r"\w", plain) else _EDGE + plain + _EDGE
            flat += _GAP if repeat == "+" else ""
    words = tuple(re.findall(rf"(?<={_EDGE})\w+(?={_EDGE})", flat))
    longest = max(flat.replace(_EDGE, "").split(_GAP), key=len)
    exact = len(words) == 1 and flat == f"{_EDGE}{words[0]}{_EDGE}"
    return Need(words, longest, exact) if words or longest else None


def needs(pattern: str) -> list[Need] | None:
    """One entry per alternative; None if an alternative gives nothing to test."""
    if _UNREAD.search(pattern):
        return None
    flat = re.sub(r"\([^()]*\)[?*+]?", "\n", pattern)  # a group may be anything
    if "(" in flat or ")" in flat:
        return None
    found = [_needs_of(a) for a in flat.split("|")]
    return None if None in found else found


GRAM = 3  # letters of a substring that texts are looked up by


@dataclass(frozen=True)
class Probe:
    """What a text must show before an expression is tried on it."""

    kind: str
    """``word``: a whole word, ``gram``: a few letters in a row, ``always``: nothing."""
    value: str = ""
    decides: bool = False
    """Showing it is enough; the expression need not run."""


def probes(pattern: str) -> list[Probe]:
    """One probe per alternative of ``pattern``; a text that shows none of them cannot match."""
    alternatives = needs(pattern)
    if alternatives is None:
        return [Probe("always")]
    found = []
    for need in alternatives:
        if need.words:
            found.append(Probe("word", max(need.words, key=len), need.exact))
        else:
            found.append(Probe("gram", need.substring[:GRAM]))
    return list(dict.fromkeys(found))
