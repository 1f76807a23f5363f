"""Boolean retrieval on bitmaps: documents are numbered, and one row holds what 64 of them say about a term."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import STOPWORDS
from ..index import Index
from ..session import stage
from .boolean import flag_predicate, holds_for_none, prepare_clauses
from .joins import fits_broadcast, join_small_or_hot, pair_all, tasks_for
from .numbering import number_rows

WORD_BITS = 64
# The predicate of a query, on 64 documents at once; Spark reads these with the same precedence.
_BITWISE = {"and": "&", "or": "|", "not": "~"}


@dataclass(frozen=True)
class Bitmaps:
    """``words(term, word, bits)`` and ``docs(word, ids)``.

    Documents are numbered without gaps in the order of their ids; 64 of them are a word. Bit i of ``bits`` says whether
    document i of the word holds the term; words without any are left out. ``ids`` lists the documents of a word, 64
    but for the last one.
    """

    words: DataFrame
    docs: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.words.sparkSession


def write_bitmaps(index: Index, path: str) -> Bitmaps:
    """Number the documents of an index and store a bitmap of each term, laid out by term and word.

    A frequent term is spread over many rows and files, 64 documents to a row; a rare one costs as many rows as postings.
    """
    numbered = number_rows(index.doc_stats.select("doc_id"), [], [F.col("doc_id")], "number")
    place = F.col("number") - 1
    numbered = numbered.select(
        "doc_id", F.expr(f"(number - 1) div {WORD_BITS}").alias("word"), F.pmod(place, F.lit(WORD_BITS)).cast("int").alias("bit")
    )
    numbered = stage(numbered, "numbered-documents")
    tasks = tasks_for(index.postings)
    held = index.postings.select("term", "doc_id").repartition(tasks, "doc_id").join(numbered, "doc_id")
    held = held.select("term", "word", "bit").repartition(tasks, "term", "word")
    words = held.groupBy("term", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    words.repartitionByRange(tasks, "term", "word").sortWithinPartitions("term", "word").write.parquet(f"{path}/words")
    ids = F.transform(F.sort_array(F.collect_list(F.struct("bit", "doc_id"))), lambda d: d["doc_id"])
    docs = numbered.groupBy("word").agg(ids.alias("ids"))
    docs.repartitionByRange("word").sortWithinPartitions("word").write.parquet(f"{path}/docs")
    return open_bitmaps(index.spark, path)


def open_bitmaps(spark: SparkSession, path: str) -> Bitmaps:
    """Open what :func:`write_bitmaps` stored."""
    return Bitmaps(spark.read.parquet(f"{path}/words"), spark.read.parquet(f"{path}/docs"))


def _filled() -> Column:
    """The bits of a word that stand for documents."""
    full = F.size("ids") == WORD_BITS
    return F.when(full, F.lit(-1).cast("bigint")).otherwise(F.expr("shiftleft(1L, size(ids)) - 1"))


def _listed() -> Column:
    """The ids of the set bits of a word, a row each."""
    is_set = F.filter("ids", lambda _, i: F.call_function("shiftright", F.col("bits"), i).bitwiseAND(F.lit(1)) == 1)
    return F.explode(is_set).alias("doc_id")


def _list(answer: DataFrame, docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., doc_id`` of the set bits of ``answer(keys..., word, bits)``; a small answer is brought to the documents."""
    answer = answer.filter("bits <> 0")
    answer = F.broadcast(answer) if fits_broadcast(answer) else answer
    return docs.join(answer, "word").select(*keys, _listed())


def bitmap_search(bitmaps: Bitmaps, query: str, **options) -> DataFrame:
    """``doc_id, score`` (score 1) of the documents that satisfy an and/or/not expression, as by ``boolean_search``.

    Only bitmaps of the query's terms are read, and the expression is taken on 64 documents at a time. Documents with
    none of the terms come in only if the expression holds for them.
    """
    predicate, terms = flag_predicate(bitmaps, query, **options)
    with_none = holds_for_none(bitmaps, query, predicate, terms)
    bitwise = F.expr(" ".join(_BITWISE.get(piece, piece) for piece in predicate.split(" ")))
    flags = bitmaps.words.filter(F.col("term").isin(list(terms.values()))).groupBy("word").agg(
        *[F.coalesce(F.bit_or(F.when(F.col("term") == term, F.col("bits"))), F.lit(0)).cast("bigint").alias(flag) for flag, term in terms.items()]
    )
    if with_none:
        every = bitmaps.docs.join(stage(flags, "flags"), "word", "left").na.fill(0, list(terms))
        found = every.select("ids", bitwise.bitwiseAND(_filled()).alias("bits")).select(_listed())
    else:
        found = _list(stage(flags.select("word", bitwise.alias("bits")), "answer"), bitmaps.docs, [])
    return found.select("doc_id", F.lit(1).cast("bigint").alias("score"))


def bitmap_bulk(bitmaps: Bitmaps, clauses: DataFrame, stem: bool = False, stopwords: Iterable[str] = STOPWORDS) -> DataFrame:
    """``query_id, doc_id`` for a table of queries in disjunctive normal form, as by ``boolean_bulk``.

    ``clauses(query_id, clause_id, term, negated)``. Every clause combines the words of its terms, every query those of
    its clauses. Clauses with negated terms only stay a set of violated words until the end: a query with such clauses
    is answered by what does not violate all of them, word by word over all documents.
    """
    keys = ["query_id", "clause_id"]
    terms = stage(prepare_clauses(clauses, stem, stopwords).distinct(), "clauses")
    sizes = terms.groupBy(*keys).agg(F.count_if(~F.col("negated")).alias("n_positive"))
    small = fits_broadcast(terms)
    wanted = terms.join(F.broadcast(sizes) if small else sizes, keys)
    hits = join_small_or_hot(bitmaps.words, wanted, "term", ["word"], [*keys, "negated"], small=small)
    bits, negated = F.col("bits"), F.col("negated")
    per_clause = hits.groupBy(*keys, "word").agg(
        F.bit_and(F.when(~negated, bits)).alias("held"),
        F.count_if(~negated).alias("n_held"),
        F.coalesce(F.bit_or(F.when(negated, bits)), F.lit(0).cast("bigint")).alias("violated"),
        F.max("n_positive").alias("n_positive"),
    )
    per_clause = stage(per_clause, "clause-words")
    positive = per_clause.filter((F.col("n_positive") > 0) & (F.col("n_held") == F.col("n_positive")))
    positive = positive.select("query_id", "word", F.col("held").bitwiseAND(F.bitwise_not("violated")).alias("bits"))
    found = stage(positive.filter("bits <> 0").groupBy("query_id", "word").agg(F.bit_or("bits").alias("bits")), "found-words")
    negative = sizes.filter("n_positive = 0").groupBy("query_id").agg(F.count("*").alias("n_clauses"))
    negative = stage(negative, "negative-queries")
    if negative.isEmpty():
        return _list(found, bitmaps.docs, ["query_id"])
    # What a query with all-negative clauses leaves out violates every one of them.
    broken = per_clause.filter("n_positive = 0").groupBy("query_id", "word").agg(
        F.bit_and("violated").alias("broken"), F.count("*").alias("n_broken")
    )
    broken = broken.join(negative, "query_id").filter("n_broken = n_clauses").select("query_id", "word", "broken")
    every = pair_all(bitmaps.docs.select("word", _filled().alias("filled")), negative.select("query_id"), "word")
    every = every.join(broken, ["query_id", "word"], "left").join(found, ["query_id", "word"], "left")
    none = F.lit(0).cast("bigint")
    left = F.col("filled").bitwiseAND(F.bitwise_not(F.coalesce("broken", none)))
    every = every.select("query_id", "word", left.bitwiseOR(F.coalesce("bits", none)).alias("bits"))
    rest = found.join(negative, "query_id", "left_anti").select("query_id", "word", "bits")
    return _list(stage(rest.unionByName(every), "answer-words"), bitmaps.docs, ["query_id"])
