"""URL rules as column expressions: which hrefs to follow, how to resolve and to cut them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import ABSOLUTE_HREF_PREFIX, LINK_CUT_PATTERN, SKIPPED_HREF_PREFIXES
from .html import starts_with_any

ORIGIN_PATTERN = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*"
SCHEME_PATTERN = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"


def is_followable(href: Column) -> Column:
    """Hrefs worth following: not empty, not a fragment, not a mail address."""
    return (href != "") & ~starts_with_any(href, SKIPPED_HREF_PREFIXES)


def canonical_url(url: Column) -> Column:
    """Cut a URL at its first ``?`` or ``#``."""
    return F.regexp_replace(url, LINK_CUT_PATTERN, "")


def _without_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` in an absolute path; a trailing one leaves a closing slash."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, seg: F.when(seg == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(seg == ".", done)
        .otherwise(F.concat(done, F.array(seg))),
    )
    closing = F.when(path.rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    resolved = F.concat(F.array_join(kept, "/"), closing)
    rooted = F.regexp_replace(F.concat(F.lit("/"), resolved), "^//", "/")
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), rooted).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve an href against the URL of its page, before cutting.

    Hrefs that start with ``http`` and those with another scheme are returned as they are.
    """
    origin = F.regexp_extract(base, ORIGIN_PATTERN, 0)
    scheme = F.regexp_extract(base, SCHEME_PATTERN, 0)
    base_path = F.regexp_replace(F.substr(canonical_url(base), F.length(origin) + 1), "^$", "/")
    path = F.regexp_extract(href, r"^[^?#]*", 0)
    tail = F.substr(href, F.length(path) + 1)
    folder = F.regexp_replace(base_path, "[^/]*$", "")
    joined = F.regexp_replace(F.concat(folder, path), "/{2,}", "/")
    own_path = F.substr(canonical_url(base), F.length(origin) + 1)
    return (
        F.when(F.startswith(href, F.lit(ABSOLUTE_HREF_PREFIX)) | href.rlike(SCHEME_PATTERN), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(path == "", F.concat(origin, own_path, tail))
        .when(F.startswith(href, F.lit("/")), F.concat(origin, _without_dot_segments(path), tail))
        .otherwise(F.concat(origin, _without_dot_segments(joined), tail))
    )
