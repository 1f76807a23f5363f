"""The index handle: two frames, in long form."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Index:
    """``postings(term, doc_id, tf, l_d)`` and ``doc_stats(doc_id, l_d)``.

    ``(term, doc_id)`` is unique in ``postings`` and ``doc_id`` in ``doc_stats``. The norm ``l_d`` depends on its
    document only, so each posting carries it and ranked search needs no join with ``doc_stats``. The collection
    size and the document frequencies are never stored: appended loads cannot make them stale.
    """

    postings: DataFrame
    doc_stats: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.postings.sparkSession

    def n_docs(self) -> Column:
        """Collection size as a scalar subquery, usable inside any projection."""
        return self.doc_stats.agg(F.count("*").alias("n_docs")).scalar()
