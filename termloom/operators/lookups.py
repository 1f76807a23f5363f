"""Lookups by term and by document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..index import Index


class UnknownTerm(LookupError):
    """A ranked query used a term that no document holds."""


class UnknownDocument(LookupError):
    """A document that is not in the collection."""


def term_postings(index: Index, terms: list[str], strict: bool = False) -> DataFrame:
    """Postings of prepared terms. The filter reaches the Parquet scan. With ``strict`` an unknown term is an error."""
    postings = index.postings.filter(F.col("term").isin(list(terms)))
    if strict:
        found = {row["term"] for row in postings.select("term").distinct().collect()}
        unknown = [t for t in terms if t not in found]
        if unknown:
            raise UnknownTerm(f"no document holds the term {unknown[0]!r}")
    return postings.select("term", "doc_id", "tf")


def term_documents(index: Index, terms: list[str]) -> DataFrame:
    """Distinct documents that hold any of the terms; none for unknown terms."""
    hits = index.postings.filter(F.col("term").isin(list(terms))).select("doc_id")
    return hits.distinct() if len(set(terms)) > 1 else hits


def documents_not_in(index: Index, documents: DataFrame) -> DataFrame:
    """All documents of the collection, empty ones too, that are not in the given set."""
    return index.doc_stats.select("doc_id").join(documents.select("doc_id"), "doc_id", "left_anti")


def document_norms(index: Index, documents: DataFrame) -> DataFrame:
    """``doc_id, l_d`` of a frame of documents; reading an unknown one raises an error."""
    joined = documents.select("doc_id").join(index.doc_stats, "doc_id", "left")
    message = F.concat(F.lit("not in the collection: "), F.col("doc_id").cast("string"))
    return joined.select("doc_id", F.when(F.col("l_d").isNull(), F.raise_error(message)).otherwise(F.col("l_d")).alias("l_d"))


def document_norm(index: Index, doc_id) -> float:
    """Norm of one document."""
    row = index.doc_stats.filter(F.col("doc_id") == doc_id).select("l_d").first()
    if row is None:
        raise UnknownDocument(f"not in the collection: {doc_id!r}")
    return row["l_d"]


def missing_terms(index: Index, query_terms: DataFrame) -> DataFrame:
    """Distinct terms of a frame of query terms that no document holds.

    The terms are reduced to those found before the anti-join, so no frequent term is shuffled whole.
    """
    wanted = query_terms.select("term").distinct()
    found = index.postings.select("term").distinct()
    return wanted.join(found, "term", "left_anti")
