"""Text preparation as column expressions: links out, punctuation out, lower case, words, stopwords."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed_values import LINK_PATTERN, NON_TERM_PATTERN, STOPWORDS


def strip_links(text: Column) -> Column:
    """Replace every ``http...`` or ``https...`` run of non-blank characters by a blank."""
    return F.regexp_replace(text, LINK_PATTERN, " ")


def strip_punctuation(text: Column) -> Column:
    """Replace runs of anything but letters, digits, ``_``, ``-`` and blanks by a blank."""
    return F.regexp_replace(text, NON_TERM_PATTERN, " ")


def split_words(text: Column) -> Column:
    """Blank-separated pieces, in order, repeats kept. May hold empty strings at either end."""
    return F.split(text, " +")


def raw_words(text: Column) -> Column:
    """Lower-cased words of a raw text, stopwords still in."""
    return split_words(F.lower(strip_punctuation(strip_links(text))))


def is_term(word: Column, stopwords: Iterable[str] = STOPWORDS) -> Column:
    """True for a word that is kept: not empty, not a stopword (false, never null, for null)."""
    kept = word.isNotNull() & (word != "")
    stopwords = list(stopwords)
    return kept & ~word.isin(stopwords) if stopwords else kept


def explode_terms(
    texts: DataFrame, keys: list[str], text_col: str = "text", stopwords: Iterable[str] = STOPWORDS
) -> DataFrame:
    """One row per kept word: ``keys + term``."""
    words = texts.select(*keys, F.explode(raw_words(F.col(text_col))).alias("term"))
    return words.filter(is_term(F.col("term"), stopwords))


def tf_weight(tf: Column) -> Column:
    """Weight of a term count: 1 + ln(tf), which is 1 for tf = 1."""
    return F.when(tf > 1, F.lit(1.0) + F.log(tf)).otherwise(F.lit(1.0))


def idf_weight(n_docs: Column, n_t: Column) -> Column:
    """Inverse document frequency ln(1 + N / n_t)."""
    return F.log(F.lit(1.0) + n_docs / n_t)
