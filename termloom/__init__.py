"""Text retrieval on Spark DataFrames: index documents, search them by boolean and ranked queries, walk link graphs."""

from .index import Index
from .operators.bitmaps import Bitmaps, bitmap_bulk, bitmap_search, open_bitmaps, write_bitmaps
from .operators.boolean import BadQuery, all_of, any_of, boolean_bulk, boolean_search, none_of
from .operators.counts import collection_counts, doc_norms, index_documents, posting_lists, term_counts
from .operators.crawl import crawl, known_links, visited_documents
from .operators.links import link_edges
from .operators.lookups import UnknownDocument, UnknownTerm, missing_terms, term_documents, term_postings
from .operators.ranked import vector_bulk, vector_search
from .plans.pipelines import crawl_and_index, index_folder, index_pages
from .session import local_session
from .sources.documents import page_documents, read_text_folder, stream_text_folder
from .sources.index_store import (
    add_documents, compact_loads, lay_out, merge_loads, open_index, open_tables, result_lines, tidy_index, write_results,
)
from .streaming.upkeep import keep_current

__all__ = [
    "BadQuery", "Bitmaps", "Index", "UnknownDocument", "UnknownTerm", "add_documents", "all_of", "any_of",
    "bitmap_bulk", "bitmap_search", "boolean_bulk", "boolean_search", "collection_counts", "compact_loads", "crawl",
    "crawl_and_index", "doc_norms", "index_documents", "index_folder", "index_pages", "keep_current", "known_links",
    "lay_out", "link_edges", "local_session", "merge_loads", "missing_terms", "none_of", "open_bitmaps",
    "open_index", "open_tables", "page_documents", "posting_lists", "read_text_folder", "result_lines",
    "stream_text_folder", "term_counts", "term_documents", "term_postings", "tidy_index", "vector_bulk",
    "vector_search", "visited_documents", "write_bitmaps", "write_results",
]
