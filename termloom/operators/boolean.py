"""Boolean retrieval: per document one flag per query term, and one predicate over the flags."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import STOPWORDS
from ..functions.text import is_term, raw_words
from ..index import Index
from ..session import stage
from .analysis import analyze
from .clause_blocks import NO_TERM, clause_blocks
from .joins import fits_broadcast, join_small_or_hot, tasks_for
from .lookups import documents_not_in, term_documents
from .stems import stem_of

CONNECTIVES = ("and", "or", "not")


class BadQuery(ValueError):
    """A boolean query that cannot be read; the message names the culprit."""


def all_of(index: Index, terms: list[str]) -> DataFrame:
    """Documents that hold every one of the prepared terms."""
    wanted = sorted(set(terms))
    hits = index.postings.filter(F.col("term").isin(wanted)).groupBy("doc_id").agg(F.count("*").alias("held"))
    return hits.filter(F.col("held") == len(wanted)).select("doc_id")


def any_of(index: Index, terms: list[str]) -> DataFrame:
    """Documents that hold at least one of the prepared terms."""
    return term_documents(index, terms)


def none_of(index: Index, terms: list[str]) -> DataFrame:
    """Documents, empty ones too, that hold none of the prepared terms."""
    return documents_not_in(index, index.postings.filter(F.col("term").isin(list(terms))))


def flag_predicate(
    index: Index, query: str, stem: bool = False, stopwords: Iterable[str] = STOPWORDS
) -> tuple[str, dict[str, str]]:
    """The query as an SQL predicate over flags, and the term behind each flag.

    Operands are prepared like documents and replaced by generated flag names; what is left are the words and, or, not
    and parentheses, which Spark reads with its usual precedence (not, and, or). No user text reaches it.
    """
    pieces = re.findall(r"[()]|[\w-]+", re.sub(r"https?\S+", " ", query).lower())
    operands = sorted({p for p in pieces if p not in CONNECTIVES and p not in "()"})
    terms: dict[str, str] = {}
    for operand, prepared in zip(operands, analyze(index.spark, operands, stem, stopwords) if operands else []):
        if len(prepared) != 1:
            raise BadQuery(f"operand {operand!r} is a stopword or not a term")
        terms[operand] = prepared[0]
    flag_of = {term: f"f{i}" for i, term in enumerate(sorted(set(terms.values())))}
    written, ended = [], False
    for piece in pieces:
        if ended != (piece in (")", "and", "or")):
            raise BadQuery(f"{'operator' if ended else 'operand'} expected before {piece!r}")
        ended = piece == ")" or (piece not in CONNECTIVES and piece != "(")
        written.append(flag_of[terms[piece]] if piece in terms else piece)
    if not ended:
        raise BadQuery("operand expected at the end of the query")
    return " ".join(written), {flag: term for term, flag in flag_of.items()}


def holds_for_none(index: Index, query: str, predicate: str, terms: dict[str, str]) -> bool:
    """Whether a predicate holds for a document with none of the terms; one that Spark cannot read is an error."""
    nothing = index.spark.range(1).select(*[F.lit(False).alias(flag) for flag in terms])
    try:
        return nothing.select(F.expr(predicate).alias("holds")).first()["holds"]
    except (ParseException, AnalysisException) as error:
        raise BadQuery(f"cannot read the query {query!r}") from error


def boolean_search(index: Index, query: str, **options) -> DataFrame:
    """``doc_id, score`` (score 1) of the documents that satisfy an and/or/not expression; parentheses group.

    Only postings of the query's terms are read. The list of all documents is joined only if the expression holds
    for a document with none of the terms, and then as an anti-join with those that fail.
    """
    predicate, terms = flag_predicate(index, query, **options)
    flags = index.postings.filter(F.col("term").isin(list(terms.values()))).groupBy("doc_id").agg(
        *[F.bool_or(F.col("term") == term).alias(flag) for flag, term in terms.items()]
    )
    if holds_for_none(index, query, predicate, terms):
        found = documents_not_in(index, flags.filter(~F.expr(predicate)))
    else:
        found = flags.filter(F.expr(predicate)).select("doc_id")
    return found.select("doc_id", F.lit(1).cast("bigint").alias("score"))


def prepare_clauses(clauses: DataFrame, stem: bool = False, stopwords: Iterable[str] = STOPWORDS) -> DataFrame:
    """Prepare the operands of a clause table like documents. An operand that is not one term is an error."""
    kept = F.filter(raw_words(F.col("term")), lambda word: is_term(word, stopwords))
    operand = F.when(F.size(kept) == 1, F.get(kept, F.lit(0))).otherwise(
        F.raise_error(F.concat(F.lit("operand is a stopword or not a term: "), F.coalesce("term", F.lit("null"))))
    )
    term = stem_of(operand) if stem else operand
    return clauses.select("query_id", "clause_id", term.alias("term"), "negated")


def boolean_bulk(index: Index, clauses: DataFrame, **options) -> DataFrame:
    """``query_id, doc_id`` for a table of queries in disjunctive normal form.

    ``clauses(query_id, clause_id, term, negated)``: a document satisfies a query if for some clause it holds all
    terms that are not negated and none that are. The terms of all clauses are numbered, the postings that hold one are
    dealt by document once, and :func:`clause_blocks` answers all queries where the documents are. If some clauses have
    negated terms only, all documents come along.
    """
    keys = ["query_id", "clause_id"]
    terms = stage(prepare_clauses(clauses, **options).distinct(), "clauses")
    distinct = terms.select("term").distinct()
    small = fits_broadcast(distinct)
    numbered = stage(distinct.withColumn("term_no", F.monotonically_increasing_id()), "clause-terms")
    # A clause without an id is met by no posting.
    entry = F.when(
        F.col("query_id").isNotNull() & F.col("clause_id").isNotNull(), F.struct("term_no", "negated")
    )
    listed = join_small_or_hot(terms, numbered, "term", keys, small=small).groupBy(*keys).agg(
        F.coalesce(F.bool_or(~F.col("negated")), F.lit(False)).alias("positive"), F.collect_list(entry).alias("terms")
    )
    # Where only negated terms are listed any hit breaks the clause; elsewhere a term that is neither says nothing.
    turned = F.transform("terms", lambda e: F.struct(e.term_no.alias("term_no"), F.lit(True).alias("negated")))
    said = F.filter("terms", lambda e: e.negated.isNotNull())
    listed = stage(
        listed.select("query_id", "positive", F.when(F.col("positive"), said).otherwise(turned).alias("terms")), "listed"
    )
    hits = join_small_or_hot(index.postings.select("term", "doc_id"), numbered, "term", ["doc_id"], small=small)
    hits = hits.select("doc_id", "term_no")
    if not listed.filter(~F.col("positive")).isEmpty():
        # A document with none of the terms satisfies clauses of negated terms only.
        hits = hits.union(index.doc_stats.select("doc_id", F.lit(NO_TERM).cast("bigint").alias("term_no")))
    dealt = hits.repartition(tasks_for(index.postings), "doc_id").sortWithinPartitions("doc_id")
    return clause_blocks(dealt, listed)
