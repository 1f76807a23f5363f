"""Term counts, norms, frequencies and posting lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fixed_values import STOPWORDS
from ..functions.text import idf_weight, is_term, raw_words, tf_weight
from ..index import Index
from .joins import tasks_for
from .stems import stem_counts

SEGMENT_DOCS = 100_000


def term_counts(
    docs: DataFrame,
    stem: bool = False,
    stopwords: Iterable[str] = STOPWORDS,
    keep_empty: bool = False,
) -> DataFrame:
    """``doc_id, term, tf``. With ``keep_empty`` every document also has one row with a null term and tf 0.

    The texts are shuffled once, by document; counting then needs no further exchange, and neither does anything
    else that works per document. That moves each text once instead of one row per (document, term). Their length is
    added up before, so that a task counts a bounded amount of text however many documents there are.
    """
    words = (
        docs.select("doc_id", "text")
        .repartition(tasks_for(docs, "text"), "doc_id")
        .select("doc_id", F.explode_outer(raw_words(F.col("text"))).alias("word"))
    )
    term = F.when(is_term(F.col("word"), stopwords), F.col("word"))
    counts = words.select("doc_id", term.alias("term")).groupBy("doc_id", "term").agg(F.count("term").alias("tf"))
    if not keep_empty:
        counts = counts.filter(F.col("term").isNotNull())
    return stem_counts(counts) if stem else counts


def with_norms(counts: DataFrame) -> DataFrame:
    """Add the document norm and mark one row per document: ``doc_id, term, tf, l_d, is_first``.

    Takes counts with ``keep_empty``, whose null-term rows weigh nothing but keep empty documents (norm 0). The first
    row is that with the smallest of some number, so rows are sorted by document only and no terms are compared.
    """
    whole_doc = W.partitionBy("doc_id")
    weight = F.when(F.col("term").isNull(), F.lit(0.0)).otherwise(tf_weight(F.col("tf")))
    numbered = counts.withColumn("_row", F.monotonically_increasing_id())
    return numbered.select(
        "doc_id",
        "term",
        "tf",
        F.sqrt(F.sum(weight * weight).over(whole_doc)).alias("l_d"),
        (F.col("_row") == F.min("_row").over(whole_doc)).alias("is_first"),
    )


def doc_norms(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, l_d``: root of the summed squared tf weights; 0 for an empty document."""
    counts = term_counts(docs, keep_empty=True, **options)
    weight = F.when(F.col("term").isNull(), F.lit(0.0)).otherwise(tf_weight(F.col("tf")))
    return counts.groupBy("doc_id").agg(F.sqrt(F.sum(weight * weight)).alias("l_d"))


def index_frames(counted: DataFrame) -> Index:
    """Split the output of :func:`with_norms` into the two frames of an index."""
    return Index(
        postings=counted.filter(F.col("term").isNotNull()).select("term", "doc_id", "tf", "l_d"),
        doc_stats=counted.filter("is_first").select("doc_id", "l_d"),
    )


def index_documents(docs: DataFrame, **options) -> Index:
    """Index of a frame of documents, nothing stored: each use computes it again."""
    return index_frames(with_norms(term_counts(docs, keep_empty=True, **options)))


def document_frequency(postings: DataFrame) -> DataFrame:
    """``term, n_t``: in how many documents each term occurs."""
    return postings.groupBy("term").agg(F.count("*").alias("n_t"))


def inverse_document_frequency(index: Index) -> DataFrame:
    """``term, n_t, idf``."""
    frequency = document_frequency(index.postings)
    return frequency.select("term", "n_t", idf_weight(index.n_docs(), F.col("n_t")).alias("idf"))


def collection_counts(index: Index) -> DataFrame:
    """One row: number of documents and of distinct terms."""
    vocabulary = document_frequency(index.postings).agg(F.count("*").alias("n_terms"))
    return vocabulary.select(index.n_docs().alias("n_docs"), "n_terms")


def posting_lists(index: Index, segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """``term, segment, docs``: posting lists as arrays of ``(doc_id, tf)`` in document order.

    Documents are hashed into ``ceil(N / segment_docs)`` segments, so that no array grows with the collection, be a
    term ever so frequent. A collection of up to ``segment_docs`` documents has one list per term; beyond that a reader
    must gather all segments of a term.
    """
    segments = F.greatest(F.lit(1), F.ceil(index.n_docs() / F.lit(segment_docs)))
    number = F.conv(F.substr(F.md5(F.col("doc_id").cast("string")), F.lit(1), F.lit(8)), 16, 10).cast("bigint")
    # Lists are made of rows dealt already: those of a scan would be gathered in one sort per task first.
    return (
        index.postings.select("term", F.pmod(number, segments).alias("segment"), F.struct("doc_id", "tf").alias("doc"))
        .repartition(tasks_for(index.postings), "term", "segment")
        .groupBy("term", "segment")
        .agg(F.sort_array(F.collect_list("doc")).alias("docs"))
    )
