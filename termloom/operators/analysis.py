"""Prepare query texts: one string for the driver, or a whole table of queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import STOPWORDS
from ..functions.text import is_term, raw_words
from .stems import stem_of


def text_terms(
    texts: DataFrame,
    keys: list[str],
    text_col: str = "text",
    stem: bool = False,
    stopwords: Iterable[str] = STOPWORDS,
) -> DataFrame:
    """Prepared terms of each text, one row per occurrence: ``keys, position, term``."""
    words = texts.select(*keys, F.posexplode(raw_words(F.col(text_col))).alias("position", "term"))
    words = words.filter(is_term(F.col("term"), stopwords))
    return words.select(*keys, "position", (stem_of(F.col("term")) if stem else F.col("term")).alias("term"))


def analyze(
    spark: SparkSession, texts: list[str], stem: bool = False, stopwords: Iterable[str] = STOPWORDS
) -> list[list[str]]:
    """Prepared terms of a few query strings, in order. The result is no longer than the strings themselves."""
    listed = F.array(*[F.lit(text) for text in texts])
    frame = spark.range(1, numPartitions=1).select(F.posexplode(listed).alias("n", "text"))
    terms: list[list[str]] = [[] for _ in texts]
    for row in sorted(text_terms(frame, ["n"], stem=stem, stopwords=stopwords).collect()):
        terms[row["n"]].append(row["term"])
    return terms


def query_terms(queries: DataFrame, query_id: list[str], stem: bool = False, stopwords=STOPWORDS) -> DataFrame:
    """``query_id..., term, qtf`` of a table of queries: a repeated word counts each time."""
    terms = text_terms(queries, query_id, stem=stem, stopwords=stopwords)
    return terms.groupBy(*query_id, "term").agg(F.count("*").alias("qtf"))
