"""English stemming (Porter2) as one native column expression. Apply it to counted terms, not to every token."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from .joins import fits_broadcast

# At most so many terms are taken for frequent.
FREQUENT_SHARE = 100_000

VOWEL = f"[{V.STEM_VOWELS}]"
CONSONANT = f"[^{V.STEM_VOWELS}]"
REGION = f"^{CONSONANT}*{VOWEL}+{CONSONANT}"
SHORT_END = f"(^{VOWEL}{CONSONANT}|{CONSONANT}{VOWEL}[^{V.STEM_VOWELS}wxY])$"


def _cut(word: Column, n: int) -> Column:
    return F.substr(word, F.lit(1), F.length(word) - n)


def _within(word: Column, suffix: str, region: Column) -> Column:
    return F.length(word) - len(suffix) >= region


def _longest_first(suffixes) -> list[str]:
    return sorted(suffixes, key=lambda s: (-len(s), s))


def _replace_longest(word: Column, table: dict[str, str], condition) -> Column:
    """Replace the longest suffix of the table that the word ends in, provided its condition holds."""
    result = None
    for suffix in _longest_first(table):
        new = F.when(condition(suffix), F.concat(_cut(word, len(suffix)), F.lit(table[suffix]))).otherwise(word)
        ends = F.endswith(word, F.lit(suffix))
        result = F.when(ends, new) if result is None else result.when(ends, new)
    return result.otherwise(word)


def _ends(word: Column, *suffixes: str) -> Column:
    """Whether the word ends in one of the suffixes; far cheaper than a regular expression."""
    return reduce(lambda a, b: a | b, [F.endswith(word, F.lit(suffix)) for suffix in suffixes])


def _step_1a(w: Column) -> Column:
    ies = F.when(F.length(w) > 4, _cut(w, 2)).otherwise(_cut(w, 1))
    return (
        F.when(_ends(w, "sses"), _cut(w, 2))
        .when(_ends(w, "ied", "ies"), ies)
        .when(~_ends(w, "s") | _ends(w, "us", "ss"), w)
        .when(w.rlike(f"{VOWEL}.+s$"), _cut(w, 1))
        .otherwise(w)
    )


def _step_1b_cut(w: Column) -> Column:
    """The word without a removable ed/edly/ing/ingly, null when there is none."""
    bare = F.regexp_replace(w, "(ingly|edly|ing|ed)$", "")
    candidate = _ends(w, "ed", "ing", "edly", "ingly") & ~_ends(w, "eed", "eedly")
    return F.when(candidate, F.when(bare.rlike(VOWEL), bare))


def _step_1b(w: Column, bare: Column, r1: Column) -> Column:
    eed = F.when(_ends(w, "ly"), _cut(w, 3)).otherwise(_cut(w, 1))
    in_r1 = F.when(_ends(w, "ly"), _within(w, "eedly", r1)).otherwise(_within(w, "eed", r1))
    mended = (
        F.when(_ends(bare, "at", "bl", "iz"), F.concat(bare, F.lit("e")))
        .when(_ends(bare, *V.STEM_DOUBLES), _cut(bare, 1))
        .when((F.length(bare) <= r1) & bare.rlike(SHORT_END), F.concat(bare, F.lit("e")))
        .otherwise(bare)
    )
    return F.when(bare.isNotNull(), mended).when(_ends(w, "eed", "eedly") & in_r1, eed).otherwise(w)


def _step_1c(w: Column) -> Column:
    turned = F.regexp_replace(w, f"^(.+{CONSONANT})[yY]$", "$1i")
    return F.when(_ends(w, "y", "Y"), turned).otherwise(w)


def _step_2(w: Column, r1: Column) -> Column:
    def holds(suffix: str) -> Column:
        inside = _within(w, suffix, r1)
        if suffix == "ogi":
            return inside & _ends(w, "logi")
        if suffix == "li":
            return inside & _ends(w, *[f"{letter}li" for letter in V.STEM_LI_ENDINGS])
        return inside

    return _replace_longest(w, V.STEM_STEP_2, holds)


def _step_3(w: Column, r1: Column, r2: Column) -> Column:
    return _replace_longest(w, V.STEM_STEP_3, lambda s: _within(w, s, r2 if s == "ative" else r1))


def _step_4(w: Column, r2: Column) -> Column:
    def holds(suffix: str) -> Column:
        inside = _within(w, suffix, r2)
        return inside & _ends(w, "sion", "tion") if suffix == "ion" else inside

    return _replace_longest(w, dict.fromkeys(V.STEM_STEP_4, ""), holds)


def _step_5(w: Column, r1: Column, r2: Column) -> Column:
    short_before = _cut(w, 1).rlike(SHORT_END)
    drop_e = _ends(w, "e") & (_within(w, "e", r2) | (_within(w, "e", r1) & ~short_before))
    drop_l = _ends(w, "ll") & _within(w, "l", r2)
    return F.when(drop_e | drop_l, _cut(w, 1)).otherwise(w)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _region_end(word: Column) -> Column:
    """Length up to the start of the region after the first consonant that follows a vowel."""
    head = F.length(F.regexp_extract(word, REGION, 0))
    return F.when(head == 0, F.length(word)).otherwise(head)


def _region_1(word: Column) -> Column:
    special = [F.when(F.startswith(word, F.lit(prefix)), F.lit(len(prefix))) for prefix in V.STEM_R1_PREFIXES]
    return F.coalesce(*special, _region_end(word))


def _from_step_1b(w: Column, r1: Column, r2: Column) -> Column:
    ended = _bind(_step_1b_cut(w), lambda bare: _step_1b(w, bare, r1))
    with_i = _bind(ended, _step_1c)
    suffixed = _bind(
        with_i,
        lambda b: F.when(F.length(b) - 2 < r1, b).otherwise(
            _bind(_step_2(b, r1), lambda c: _bind(_step_3(c, r1, r2), lambda d: _step_4(d, r2)))
        ),
    )
    return _bind(suffixed, lambda e: F.replace(_step_5(e, r1, r2), F.lit("Y"), F.lit("y")))


def _by_steps(marked: Column) -> Column:
    return _bind(
        _region_1(marked),
        lambda r1: _bind(
            r1 + _region_end(F.substr(marked, r1 + 1)),
            lambda r2: _bind(
                _step_1a(marked),
                lambda w: F.when(w.isin(list(V.STEM_STOP_AFTER_1A)), w).otherwise(_from_step_1b(w, r1, r2)),
            ),
        ),
    )


def stem_of(term: Column) -> Column:
    """The stem of a prepared term; null stays null.

    Every step is bound to a lambda variable, so the expression grows with the number of steps only, and filters on
    the stem can be pushed down without multiplying it.
    """
    exceptions = F.create_map(*[F.lit(x) for pair in V.STEM_EXCEPTIONS.items() for x in pair])

    def stemmed(raw: Column) -> Column:
        with_y = F.regexp_replace(F.regexp_replace(raw, "^y", "Y"), f"({VOWEL})y", "$1Y")
        marked = F.when(F.contains(raw, F.lit("y")), with_y).otherwise(raw)
        return (
            F.when(F.length(raw) <= 2, raw)
            .when(raw.isin(list(V.STEM_EXCEPTIONS)), exceptions[raw])
            .otherwise(_bind(marked, _by_steps))
        )

    return F.when(term.isNotNull(), _bind(term, stemmed))


def stem_vocabulary(terms: DataFrame) -> DataFrame:
    """``term, stem`` for the distinct terms of a frame with a ``term`` column."""
    distinct = terms.select("term").filter(F.col("term").isNotNull()).distinct()
    return distinct.select("term", stem_of(F.col("term")).alias("stem"))


def stem_counts(counts: DataFrame, frequent: DataFrame | None = None) -> DataFrame:
    """Replace terms by stems and add up: ``doc_id, term, tf`` in and out (null terms stay).

    The counts are grouped by document already, so stemming them in place and adding up needs no exchange at all;
    looking stems up in a vocabulary would shuffle every posting by term, hot terms included. ``frequent(term, stem)``
    saves work for the terms in it, while it is small enough to be broadcast: they are looked up, all others are
    stemmed in place, with the same result.
    """
    stem = stem_of(F.col("term"))
    if frequent is not None and fits_broadcast(frequent):
        stems = F.broadcast(frequent.select("term", F.col("stem").alias("_stem")).filter(F.col("_stem").isNotNull()))
        counts = counts.join(stems, "term", "left")
        stem = F.coalesce("_stem", stem)
    return (
        counts.select("doc_id", stem.alias("term"), "tf")
        .groupBy("doc_id", "term")
        .agg(F.sum("tf").alias("tf"))
        .select("doc_id", "term", "tf")
    )


def frequent_stems(counts: DataFrame, share: int = FREQUENT_SHARE) -> DataFrame:
    """``term, stem`` of the terms that make up at least one in ``share`` of the rows of counts, so at most ``share``."""
    by_term = counts.groupBy("term").agg(F.count("*").alias("n"))
    total = counts.agg(F.count("*").alias("n")).scalar()
    return by_term.filter(F.col("term").isNotNull() & (F.col("n") * share >= total)).select(
        "term", stem_of(F.col("term")).alias("stem")
    )
