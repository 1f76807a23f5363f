"""Every operator as a named query over the standard tables: ``name -> f(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import html_text
from ..functions.text import explode_terms, is_term, raw_words, split_words, strip_links, strip_punctuation, tf_weight
from ..functions.urls import canonical_url
from ..index import Index
from ..operators.analysis import query_terms, text_terms
from ..operators.bitmaps import Bitmaps, bitmap_bulk, bitmap_search, write_bitmaps
from ..operators.boolean import all_of, any_of, boolean_bulk, boolean_search, none_of
from ..operators.counts import (
    collection_counts,
    doc_norms,
    document_frequency,
    inverse_document_frequency,
    posting_lists,
    term_counts,
)
from ..operators.crawl import crawl, known_links, reach, reach_recursive
from ..operators.links import followable_links, link_edges, page_links, resolved_links
from ..operators.lookups import document_norms, missing_terms, term_documents, term_postings
from ..operators.ranked import rank_all, score_sums, vector_bulk, vector_search
from ..operators.stems import stem_counts, stem_vocabulary
from ..session import new_path, stage
from ..sources.documents import html_pages, new_documents, page_documents, read_text_folder, write_text_folder
from ..sources.index_store import add_documents, compact_loads, lay_out, open_index, result_lines
from ..streaming.upkeep import keep_current
from .pipelines import crawl_and_index

ENTITY_FOOTER = """&apos;x&apos; &copy y &hellip;&nbsp;&#8364;&#x41; &notit; &nosuch; <i title="a>b">z</i>"""
SEARCH_TEXT = "tion retion ther ther and"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_stored: dict[tuple, object] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under the name of its function, less a leading ``query_``."""
    QUERIES[function.__name__.removeprefix("query_")] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def r6(column: Column, name: str) -> Column:
    return F.round(column, 6).alias(name)


def _once(spark: SparkSession, folder: str, what: str, make: Callable[[], object]):
    """Things many queries share are stored once per application and input folder."""
    key = (spark.sparkContext.applicationId, folder, what)
    if key not in _stored:
        _stored[key] = make()
    return _stored[key]


def stored_index(spark: SparkSession, folder: str, stem: bool = False) -> Index:
    """The index of ``documents``, written to the shared folder on first use and read by all searches."""

    def make() -> Index:
        path = new_path(spark, "index")
        add_documents(documents(spark, folder), path, "documents", stem=stem)
        return open_index(spark, path)

    return _once(spark, folder, f"index stem={stem}", make)


def benchmark_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def linked_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The page table with links between its own pages: page p also links to (3p+1) and (7p+2) modulo n.

    Hrefs of every kind are appended, since those in the table are all root-relative and lead out of it.
    """
    pages = table(spark, folder, "pages")
    n = pages.agg(F.count("*").alias("n")).scalar()
    page = F.col("page_id")
    keyed = pages.select("page_id", "url", "html", ((3 * page + 1) % n).alias("_a"), ((7 * page + 2) % n).alias("_b"))
    target = pages.select(page.alias("_id"), F.col("url").alias("_to"))
    a = target.select(F.col("_id").alias("_a"), F.col("_to").alias("_url_a"))
    b = target.select(F.col("_id").alias("_b"), F.col("_to").alias("_url_b"))
    footer = F.concat(
        F.lit("""<a href="#top">top</a><a class='m' href='mailto:info@example.org'>mail</a><a href="">none</a>"""),
        F.lit("""<!-- <a href="/hidden">hidden</a> --><a href='../up/./"""),
        page.cast("string"),
        F.lit("""?x=1#f'>up</a><a href="?q=2">again</a><a href="//cdn.example.org/k">cdn</a><a href=\""""),
        F.col("_url_a"),
        F.lit("""">a</a><A HREF=\""""),
        F.col("_url_b"),
        F.lit("""">b</A>"""),
    )
    return keyed.join(a, "_a").join(b, "_b").select("page_id", "url", F.concat("html", footer).alias("html"))


def first_page(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").filter("page_id = 0").select("url")


def crawl_state(spark: SparkSession, folder: str) -> DataFrame:
    make = lambda: stage(crawl(linked_pages(spark, folder), first_page(spark, folder), max_depth=4), "crawl")
    return _once(spark, folder, "crawl", make)


# Sources and sinks


@query
def text_folder(spark, folder):
    """All pages written as text, one file per page, and read back as documents."""
    files = new_path(spark, "texts")
    pages = table(spark, folder, "pages").select("page_id", F.regexp_replace("html", "[\r\n]+", " ").alias("text"))
    # One folder per page with one file in it; ids come from the path.
    write_text_folder(pages, "page_id", files)
    found = read_text_folder(spark, files, doc_id="path")
    number = F.regexp_extract("path", r"/page_id=(\d+)/", 1).cast("bigint")
    return found.filter(F.startswith(F.element_at(F.split("path", "/"), -1), F.lit("part-"))).select(
        number.alias("page_id"), F.regexp_replace("text", "\n$", "").alias("text")
    )


@query
def pages_source(spark, folder):
    """HTML pages only; the media type stands in the table or, as here, is derived from the page's own doctype."""
    pages = table(spark, folder, "pages")
    doctype = F.when(F.startswith(F.lower("html"), F.lit("<!doctype html")), F.lit("text/html; charset=utf-8"))
    pages = html_pages(pages.withColumn("content_type", F.coalesce(doctype, F.lit("application/octet-stream"))))
    return pages.select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


@query
def query_new_documents(spark, folder):
    docs = documents(spark, folder).select("doc_id", "lang", "source", "n_chars")
    return new_documents(docs, table(spark, folder, "labels"))


@query
def first_documents(spark, folder):
    """Rows that share an id: the first by order is kept, unless the id is known."""
    turns = table(spark, folder, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", "role", "text")
    return new_documents(turns, table(spark, folder, "labels"), order_by="turn")


def _postings(index: Index) -> DataFrame:
    return index.postings.select("term", "doc_id", "tf", r6(F.col("l_d"), "l_d"))


@query
def build_index(spark, folder):
    path = new_path(spark, "index")
    add_documents(documents(spark, folder), path, "all")
    return _postings(open_index(spark, path))


@query
def index_append(spark, folder):
    """Two loads, the second with every document again: known ones are skipped."""
    path = new_path(spark, "index")
    docs = documents(spark, folder)
    add_documents(docs.join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi"), path, "1")
    add_documents(docs, path, "2")
    return _postings(open_index(spark, path))


def bucketed_index(spark: SparkSession, folder: str) -> Index:
    def make() -> Index:
        path = new_path(spark, "tables")
        return lay_out(stored_index(spark, folder), "t" + path.rsplit("-", 1)[1], path)

    return _once(spark, folder, "tables", make)


@query
def index_bucketed(spark, folder):
    """Per document on the bucketed layout: no exchange."""
    postings = bucketed_index(spark, folder).postings
    return postings.groupBy("doc_id").agg(F.count("*").alias("n_terms"), F.sum("tf").alias("n_words"))


@query
def search_output(spark, folder):
    return result_lines(vector_search(stored_index(spark, folder), SEARCH_TEXT))


@query
def search_output_boolean(spark, folder):
    return result_lines(boolean_search(stored_index(spark, folder), "tion and not ther"), boolean=True)


# Text preparation


@query
def query_strip_links(spark, folder):
    pages = table(spark, folder, "pages")
    return pages.select("page_id", strip_links(F.concat_ws(" ", "url", "html")).alias("text"))


@query
def strip_punct(spark, folder):
    return documents(spark, folder).select("doc_id", strip_punctuation(F.col("text")).alias("text"))


@query
def query_split_words(spark, folder):
    words = documents(spark, folder).select("doc_id", F.explode(split_words(strip_punctuation(F.col("text")))).alias("word"))
    return words.filter("word <> ''")


@query
def remove_stopwords(spark, folder):
    words = documents(spark, folder).select("doc_id", F.explode(raw_words(F.col("text"))).alias("term"))
    return words.groupBy("term").agg(F.count("*").alias("n")).filter(is_term(F.col("term")))


@query
def preprocess_tokens(spark, folder):
    return explode_terms(documents(spark, folder), ["doc_id"])


@query
def preprocess_queries(spark, folder):
    """The same preparation for query texts."""
    return text_terms(table(spark, folder, "conversations"), ["conv_id", "turn"]).drop("position")


@query
def query_stem_vocabulary(spark, folder):
    return stem_vocabulary(explode_terms(documents(spark, folder), ["doc_id"]))


@query
def stemmed_counts(spark, folder):
    return stem_counts(term_counts(documents(spark, folder)))


@query
def pages_text(spark, folder):
    return table(spark, folder, "pages").select("page_id", html_text(F.col("html")).alias("text"))


@query
def pages_entities(spark, folder):
    """Text of pages to which character references of all kinds and a quoted ``>`` were added."""
    footer = F.lit(ENTITY_FOOTER)
    return table(spark, folder, "pages").select("page_id", html_text(F.concat("html", footer)).alias("text"))


@query
def pages_documents(spark, folder):
    return page_documents(table(spark, folder, "pages"))


@query
def query_page_links(spark, folder):
    return page_links(table(spark, folder, "pages"), ["page_id"])


@query
def query_followable_links(spark, folder):
    return followable_links(page_links(linked_pages(spark, folder), ["page_id"]))


@query
def query_resolved_links(spark, folder):
    links = followable_links(page_links(linked_pages(spark, folder), ["page_id", "url"]))
    return resolved_links(links).select("page_id", "href", "resolved")


@query
def canonical_links(spark, folder):
    links = resolved_links(followable_links(page_links(linked_pages(spark, folder), ["page_id", "url"])))
    return links.select("page_id", canonical_url(F.col("resolved")).alias("link"))


# Counts


@query
def doc_term_counts(spark, folder):
    return term_counts(documents(spark, folder))


@query
def query_doc_norms(spark, folder):
    return doc_norms(documents(spark, folder)).select("doc_id", r6(F.col("l_d"), "l_d"))


@query
def postings_lists(spark, folder):
    lists = posting_lists(stored_index(spark, folder), segment_docs=256)
    written = F.transform("docs", lambda d: F.concat_ws(":", d.doc_id.cast("string"), d.tf.cast("string")))
    return lists.select("term", "segment", F.array_join(written, ",").alias("docs"))


@query
def term_df(spark, folder):
    return document_frequency(stored_index(spark, folder).postings)


@query
def term_idf(spark, folder):
    return inverse_document_frequency(stored_index(spark, folder)).select("term", "n_t", r6(F.col("idf"), "idf"))


@query
def query_collection_counts(spark, folder):
    return collection_counts(stored_index(spark, folder))


@query
def tf_weights(spark, folder):
    weight = r6(tf_weight(F.col("tf")), "weight")
    return stored_index(spark, folder).postings.select("term", "doc_id", weight)


@query
def query_score_sums(spark, folder):
    sums = score_sums(stored_index(spark, folder), SEARCH_TEXT)
    return sums.select("doc_id", r6(F.col("score_sum"), "score_sum"))


# Lookups and boolean retrieval


@query
def query_term_postings(spark, folder):
    return term_postings(stored_index(spark, folder), ["retion"], strict=True)


@query
def term_docs(spark, folder):
    return term_documents(stored_index(spark, folder), ["ther"])


@query
def query_missing_terms(spark, folder):
    terms = query_terms(benchmark_queries(spark, folder), ["query_id"])
    return missing_terms(stored_index(spark, folder), terms)


@query
def query_document_norms(spark, folder):
    norms = document_norms(stored_index(spark, folder), table(spark, folder, "labels"))
    return norms.select("doc_id", r6(F.col("l_d"), "l_d"))


@query
def bool_and(spark, folder):
    return all_of(stored_index(spark, folder), ["tion", "and", "ther"])


@query
def bool_or(spark, folder):
    return any_of(stored_index(spark, folder), ["tion", "retion"])


@query
def bool_not(spark, folder):
    return none_of(stored_index(spark, folder), ["and"])


@query
def bool_not_not(spark, folder):
    return boolean_search(stored_index(spark, folder), "not not Tion")


@query
def bool_expr(spark, folder):
    return boolean_search(stored_index(spark, folder), "tion and not ther or retion and ther")


@query
def bool_expr_paren(spark, folder):
    return boolean_search(stored_index(spark, folder), "not (tion or ther) and not retion")


def benchmark_clauses(spark: SparkSession, folder: str) -> DataFrame:
    """Per benchmark text: all of its terms, or its first term by alphabet but not its last."""
    terms = stage(query_terms(benchmark_queries(spark, folder), ["query_id"]), "query-terms")
    every = terms.select("query_id", F.lit(1).alias("clause_id"), "term", F.lit(False).alias("negated"))
    ends = terms.groupBy("query_id").agg(F.min("term").alias("first"), F.max("term").alias("last"))
    mixed = ends.filter("first <> last").select(
        "query_id", F.lit(2).alias("clause_id"), F.explode(F.create_map("first", F.lit(False), "last", F.lit(True)))
    ).withColumnsRenamed({"key": "term", "value": "negated"})
    return every.union(mixed)


def mixed_clauses(spark: SparkSession) -> DataFrame:
    """Clauses with positive and negated terms, with negated ones only, and with a term that no document holds."""
    rows = [
        (1, 1, "tion", False), (1, 1, "and", True), (1, 2, "ther", False), (1, 2, "retion", False),
        (2, 1, "and", True), (3, 1, "and", True), (3, 1, "tion", True), (3, 2, "nosuchterm", False),
    ]
    return spark.createDataFrame(rows, "query_id bigint, clause_id int, term string, negated boolean")


@query
def bool_bulk(spark, folder):
    return boolean_bulk(stored_index(spark, folder), benchmark_clauses(spark, folder))


@query
def bool_dnf(spark, folder):
    return boolean_bulk(stored_index(spark, folder), mixed_clauses(spark))


# The same on bitmaps


def stored_bitmaps(spark: SparkSession, folder: str) -> Bitmaps:
    make = lambda: write_bitmaps(stored_index(spark, folder), new_path(spark, "bitmaps"))
    return _once(spark, folder, "bitmaps", make)


@query
def bitmap_expr(spark, folder):
    return bitmap_search(stored_bitmaps(spark, folder), "tion and not ther or retion and ther")


@query
def bitmap_expr_paren(spark, folder):
    return bitmap_search(stored_bitmaps(spark, folder), "not (tion or ther) and not retion")


@query
def bitmap_not_not(spark, folder):
    return bitmap_search(stored_bitmaps(spark, folder), "not not Tion")


@query
def query_bitmap_bulk(spark, folder):
    return bitmap_bulk(stored_bitmaps(spark, folder), benchmark_clauses(spark, folder))


@query
def bitmap_dnf(spark, folder):
    return bitmap_bulk(stored_bitmaps(spark, folder), mixed_clauses(spark))


# Ranked retrieval


def _scores(results: DataFrame) -> DataFrame:
    return results.select(*[r6(F.col(c), c) if c == "score" else F.col(c) for c in results.columns])


@query
def query_vector_search(spark, folder):
    return _scores(vector_search(stored_index(spark, folder), SEARCH_TEXT))


@query
def vector_above(spark, folder):
    return _scores(vector_search(stored_index(spark, folder), SEARCH_TEXT, above=0.5))


@query
def vector_all(spark, folder):
    return _scores(vector_search(stored_index(spark, folder), SEARCH_TEXT, above=0))


@query
def vector_ranked(spark, folder):
    """Full ranking with the rank computed over all tasks."""
    return _scores(rank_all(vector_search(stored_index(spark, folder), SEARCH_TEXT, above=0)))


@query
def vector_topk(spark, folder):
    return _scores(vector_search(stored_index(spark, folder), SEARCH_TEXT, above=0, top=10))


@query
def vector_repeat(spark, folder):
    return _scores(vector_search(stored_index(spark, folder), "retion Retion", above=0))


@query
def vector_skip(spark, folder):
    return _scores(vector_search(stored_index(spark, folder), "retion nosuchterm", above=0, on_missing="skip"))


@query
def query_vector_bulk(spark, folder):
    return _scores(vector_bulk(stored_index(spark, folder), benchmark_queries(spark, folder), above=0, top=3))


@query
def vector_bulk_bucketed(spark, folder):
    """The same on the bucketed layout: scores add up without an exchange."""
    return _scores(vector_bulk(bucketed_index(spark, folder), benchmark_queries(spark, folder), above=0, top=3))


@query
def vector_bulk_ranked(spark, folder):
    """All hits of each query above the floor, ranked over all tasks."""
    return _scores(vector_bulk(stored_index(spark, folder), benchmark_queries(spark, folder)))


@query
def vector_conversations(spark, folder):
    """Every user turn as a query."""
    turns = table(spark, folder, "conversations").filter("role = 'user'")
    return _scores(vector_bulk(stored_index(spark, folder), turns, ["conv_id", "turn"], top=5))


@query
def vector_stemmed(spark, folder):
    return _scores(vector_search(stored_index(spark, folder, stem=True), "tions ering ther and", above=0, stem=True))


@query
def bool_stemmed(spark, folder):
    return boolean_search(stored_index(spark, folder, stem=True), "tions and not ering", stem=True)


# Link graph and crawl


@query
def query_link_edges(spark, folder):
    return link_edges(linked_pages(spark, folder))


@query
def page_edges(spark, folder):
    """Link graph of the page table as it is: every target lies outside."""
    return link_edges(table(spark, folder, "pages"))


@query
def crawl_reach(spark, folder):
    """Everything in reach of the first page, without a depth limit."""
    edges = stage(link_edges(linked_pages(spark, folder)), "edges")
    seeds = first_page(spark, folder).select(canonical_url(F.col("url")).alias("node"))
    return reach(edges, seeds).select("node", "depth")


@query
def crawl_reach_recursive(spark, folder):
    """Three levels from the first page as one recursive statement."""
    edges = stage(link_edges(linked_pages(spark, folder)), "edges")
    seeds = first_page(spark, folder).select(canonical_url(F.col("url")).alias("node"))
    return reach_recursive(edges, seeds, 3)


@query
def crawl_status(spark, folder):
    return crawl_state(spark, folder).select("url", "depth", "status")


@query
def crawl_all_pages(spark, folder):
    """All pages of the table as seeds, as it is: depth 1 leads nowhere."""
    pages = table(spark, folder, "pages")
    return crawl(pages, pages.select("url"), max_depth=1)


@query
def crawl_budget(spark, folder):
    return crawl(linked_pages(spark, folder), first_page(spark, folder), max_pages=50)


@query
def crawl_resume(spark, folder):
    """Go on from a crawl of depth 1 with a second seed; the pages visited before stay as they were."""
    pages = linked_pages(spark, folder)
    state = stage(crawl(pages, first_page(spark, folder), max_depth=1), "crawl")
    more = table(spark, folder, "pages").filter("page_id = 5").select("url")
    return crawl(pages, more, max_depth=2, state=state)


@query
def crawl_links(spark, folder):
    return known_links(crawl_state(spark, folder))


@query
def crawl_index(spark, folder):
    _, index = crawl_and_index(
        linked_pages(spark, folder), first_page(spark, folder), new_path(spark, "index"), "crawl", max_depth=4
    )
    return index.postings.select("term", "doc_id", "tf", r6(F.col("l_d"), "l_d"))


# Streaming


def _stream(spark: SparkSession, folder: str, batches: int, **options) -> str:
    """Index the documents as they arrive in so many batches, one more bringing some of them again; path of the index.

    Each arrival is written by as many tasks as read the table, and taken up by the stream where it stopped before.
    """
    path, source, checkpoint = new_path(spark, "index"), new_path(spark, "arriving"), new_path(spark, "stream")
    docs = documents(spark, folder)
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for arrival in [*[docs.filter(batch == number) for number in range(batches)], docs.filter("doc_id % 10 = 0")]:
        arrival.write.mode("append").parquet(source)
        arriving = spark.readStream.schema(docs.schema).parquet(source)
        keep_current(arriving, path, checkpoint, **options).awaitTermination()
    return path


def _document_terms(index: Index) -> DataFrame:
    n_terms = index.postings.groupBy("doc_id").agg(F.count("*").alias("n_terms"))
    stats = index.doc_stats.join(n_terms, "doc_id", "left")
    return stats.select("doc_id", r6(F.col("l_d"), "l_d"), F.coalesce("n_terms", F.lit(0)).alias("n_terms"))


@query
def stream_index(spark, folder):
    """Documents arrive as a stream; the index ends up as the batch one, merged by hand."""
    path = _stream(spark, folder, 3)
    compact_loads(spark, path, "all")
    return _document_terms(open_index(spark, path))


@query
def stream_levels(spark, folder):
    """The same from more batches, whose loads are merged by size as they come."""
    return _document_terms(open_index(spark, _stream(spark, folder, 6, fan=2)))
