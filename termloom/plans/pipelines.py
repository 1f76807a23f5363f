"""End-to-end jobs: index a folder, index a page table, crawl and index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.fixed_values import DEFAULT_MAX_DEPTH
from ..index import Index
from ..operators.crawl import crawl, visited_documents
from ..session import stage
from ..sources.documents import page_documents, read_text_folder
from ..sources.index_store import add_documents, open_index


def index_folder(
    spark: SparkSession, folder: str, path: str, load: str, doc_id: str = "basename", **options
) -> Index:
    """Index every file below a folder; of files with the same id the first by path is kept."""
    add_documents(read_text_folder(spark, folder, doc_id), path, load, order_by="path", **options)
    return open_index(spark, path)


def index_pages(pages: DataFrame, path: str, load: str, **options) -> Index:
    """Index the HTML pages of a page table."""
    add_documents(page_documents(pages, keep=("url",)), path, load, order_by="url", **options)
    return open_index(pages.sparkSession, path)


def crawl_and_index(
    pages: DataFrame,
    seeds: DataFrame,
    path: str,
    load: str,
    max_depth: int = DEFAULT_MAX_DEPTH,
    max_pages: int | None = None,
    **options,
) -> tuple[DataFrame, Index]:
    """Crawl a page table from seeds and index what was visited; returns the crawl state and the index."""
    state = stage(crawl(pages, seeds, max_depth, max_pages), "crawl")
    add_documents(visited_documents(pages, state), path, load, **options)
    return state, open_index(pages.sparkSession, path)
