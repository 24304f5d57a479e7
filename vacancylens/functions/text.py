"""Text clean-up as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CleanConfig
from .patterns import needs

# Whitespace as in Unicode, with the four separator control characters.
SPACE = r"[\s\x1c-\x1f]"


def strip_space(c: Column) -> Column:
    """Remove whitespace of any kind at both ends."""
    return F.regexp_replace(c, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def clean_text(c: Column) -> Column:
    """NULL -> "", whitespace runs -> one space, drop ``&word;``, strip.

    Entities go after the runs are merged, so "a &amp; b" keeps two spaces.
    Only plain spaces are left by then, so ``trim`` is enough.
    """
    merged = F.regexp_replace(F.coalesce(c, F.lit("")), rf"(?U){SPACE}+", " ")
    return F.trim(F.regexp_replace(merged, r"(?U)&\w+;", ""))


# Letters beyond ASCII that equal an ASCII letter when case is ignored, and that letter.
_CASE_TWINS = ("".join(map(chr, (0x17F, 0x212A, 0x131, 0x130))), "skii")


def _caseless(c: Column) -> Column:
    """ASCII words match in this form as they do when case is ignored."""
    return F.lower(F.translate(c, *_CASE_TWINS))


def _bind(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f(c)`` with ``c`` computed once per row.

    Filters, unlike projections, compute a repeated subexpression every time; a
    lambda's variable is a value.
    """
    return F.transform(F.array(c), f)[0]


def cut_junk(c: Column, patterns: Sequence[str]) -> Column:
    """Cut a cleaned text at the first match of each pattern, in list order.

    Most titles hold none; a plain search for the texts the patterns need says so.
    """
    found = [needs(p) for p in patterns]

    def cut(t: Column) -> Column:
        for pattern in patterns:
            t = F.regexp_replace(t, f"(?isU){pattern}.*", "")
        return t

    if not patterns or not all(found):
        return F.trim(cut(c))
    needed = [n.substring.lower() for alternatives in found for n in alternatives]
    return F.trim(_bind(c, lambda t: F.when(
        _bind(_caseless(t), lambda low: contains_any(low, needed)), cut(t)).otherwise(t)))


def strip_place(c: Column, places: Sequence[str]) -> Column:
    """Remove one trailing place name, with or without a space before it."""
    names = "|".join(re.escape(p) for p in places)

    def ends_in_place(low: Column) -> Column:
        hit = F.lit(False)
        for place in places:
            hit = hit | low.endswith(place.lower())
        return hit

    return F.trim(_bind(c, lambda t: F.when(
        _bind(_caseless(t), ends_in_place), F.regexp_replace(t, f"(?iU)(?:{names})$", "")).otherwise(t)))


def strip_division(c: Column, pattern: str) -> Column:
    """Remove a trailing division name."""
    return F.trim(F.regexp_replace(c, f"(?iU){pattern}", ""))


def scrub_title(c: Column, cfg: CleanConfig = CleanConfig()) -> Column:
    """Junk, place and division removal on a cleaned title, in that order; NULL -> "".

    A cleaned text has no whitespace but plain spaces, so ``trim`` strips it.
    """
    cut = cut_junk(F.coalesce(c, F.lit("")), cfg.junk_patterns)
    return strip_division(strip_place(cut, cfg.trailing_places), cfg.trailing_division)


def clean_location(c: Column) -> Column:
    """Cleaned text: drop a "Location" prefix, dashes to ", ", strip commas and spaces."""
    bare = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?iU)^Location\s*", ""))
    return F.btrim(F.regexp_replace(bare, r"(?U)\s*[-–—]\s*", ", "), F.lit(", "))


def location_prefix(c: Column) -> Column:
    """The card's own prefix rule: case-sensitive, nothing else changes."""
    return strip_space(F.regexp_replace(c, r"(?U)^Location\s*", ""))


def strip_company(c: Column) -> Column:
    """Remove trailing spaces and hyphens."""
    return strip_space(F.rtrim(strip_space(c), F.lit(" -")))


def non_job(title: Column, cfg: CleanConfig = CleanConfig()) -> Column:
    """True for navigation texts and titles that are too short.

    One pattern for both rules, so a filter evaluates the scrubbed title once.
    """
    short = f".{{0,{max(cfg.min_title_length - 1, 0)}}}"
    texts = "|".join(re.escape(t) for t in cfg.non_job_titles)
    return F.lower(F.trim(title)).rlike(rf"(?s)\A(?:{short}|{texts})\z")


def join_tags(texts: Column, sep: str = ", ") -> Column:
    """Strip each text, drop the blank ones, join."""
    return F.array_join(F.filter(F.transform(texts, strip_space), lambda x: x != ""), sep)


def first_text(texts: Column, default: str = "") -> Column:
    """First text, stripped; ``default`` if there is none."""
    return F.coalesce(strip_space(F.try_element_at(texts, F.lit(1))), F.lit(default))


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """True if ``c`` contains any of the literal words."""
    hit = c.contains(words[0])
    for word in words[1:]:
        hit = hit | c.contains(word)
    return hit


def pick_text(texts: Column, words: Sequence[str]) -> Column:
    """First text that contains one of the words in any case, stripped; else ""."""
    any_word = "|".join(re.escape(w) for w in words)
    return first_text(F.filter(texts, lambda x: F.lower(x).rlike(any_word)))


def pick_salary(texts: Column, default: str) -> Column:
    """First text stripped, or ``default`` if it is missing or blank."""
    return F.coalesce(F.nullif(first_text(texts), F.lit("")), F.lit(default))


def full_text(description: Column, requirements: Column, fallback: Column) -> Column:
    """Description and requirement texts; all section texts if both are blank."""
    # Each part is stripped already; only the joining space can stand at an end.
    found = F.trim(F.concat_ws(" ", join_tags(description, " "), join_tags(requirements, " ")))
    return F.coalesce(F.nullif(found, F.lit("")), F.array_join(fallback, " "), F.lit(""))


def has_text(c: Column) -> Column:
    """The "has a value" rule: not NULL and not the empty string."""
    return c.isNotNull() & (c != "")
