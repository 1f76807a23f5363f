"""Links of a page table: extraction, filtering, resolution, and the link graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import anchor_hrefs
from ..functions.urls import canonical_url, is_followable, resolve_url
from ..sources.documents import html_pages, page_url


def page_links(pages: DataFrame, keys: list[str] = ["url"]) -> DataFrame:
    """``keys + href``: every ``href`` of an ``<a>``, repeats kept."""
    return pages.select(*keys, F.explode(anchor_hrefs(F.col("html"))).alias("href"))


def followable_links(links: DataFrame) -> DataFrame:
    """Links without fragments, mail addresses and empty hrefs."""
    return links.filter(is_followable(F.col("href")))


def resolved_links(links: DataFrame, base: str = "url") -> DataFrame:
    """Add ``resolved``: the href as an absolute URL, not yet cut."""
    return links.withColumn("resolved", resolve_url(F.col(base), F.col("href")))


def link_edges(pages: DataFrame) -> DataFrame:
    """Distinct ``src, dst`` between canonical URLs; relative links resolve against where redirects ended."""
    pages = html_pages(pages)
    based = pages.select("url", page_url(pages).alias("_base"), "html")
    links = resolved_links(followable_links(page_links(based, ["url", "_base"])), "_base")
    return links.select(
        canonical_url(F.col("url")).alias("src"), canonical_url(F.col("resolved")).alias("dst")
    ).distinct()
