"""Link resolution as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def _drop_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(s))))
    ends_in_dot = F.element_at(parts, -1).isin(".", "..")
    joined = F.array_join(kept, "/")
    return F.when(ends_in_dot, F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve_url(href: Column, page_url: Column) -> Column:
    """``href`` as an absolute URL, read against the page it stands on."""
    no_fragment = F.regexp_replace(page_url, "#.*$", "")
    scheme = F.regexp_extract(page_url, f"({_SCHEME[1:]})", 1)
    origin = F.regexp_extract(page_url, f"({_SCHEME}//[^/?#]*)", 1)
    path = F.regexp_extract(page_url, f"{_SCHEME}//[^/?#]*([^?#]*)", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", ""))
    href_path = F.regexp_extract(href, "^[^?#]*", 0)
    href_rest = F.regexp_extract(href, "[?#].*$", 0)
    absolute_path = F.when(href.startswith("/"), href_path).otherwise(F.concat(folder, href_path))
    return (
        F.when(href == "", page_url)
        .when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(origin, path, href))
        .otherwise(F.concat(origin, _drop_dots(absolute_path), href_rest)))
