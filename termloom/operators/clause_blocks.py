"""Boolean retrieval for many queries at once: chunks of documents against blocks of queries, a bit per document."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_path
from .blocks import _changes, chunk_tables, query_blocks

# Bytes of flags, and answers, that are kept at a time.
FLAG_BYTES, TILE_ANSWERS = 1 << 23, 1 << 22
NO_TERM = -1

# Functions of this module go to the executors whole, which need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _bits(doc: np.ndarray, starts: np.ndarray, ends: np.ndarray, n_docs: int) -> np.ndarray:
    """A row of packed bits per posting list, a bit per document; ``FLAG_BYTES`` of flags are unpacked at a time."""
    packed = np.zeros((len(starts), -(-n_docs // 8)), np.uint8)
    step = max(1, FLAG_BYTES // n_docs)
    for low in range(0, len(starts), step):
        begin, size = starts[low : low + step], (ends - starts)[low : low + step]
        flags = np.zeros((len(size), n_docs), bool)
        after = np.cumsum(size)
        posting = np.arange(after[-1]) + np.repeat(begin - after + size, size)
        flags[np.repeat(np.arange(len(size)), size), doc[posting]] = True
        packed[low : low + step] = np.packbits(flags, axis=1)
    return packed


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and values of a column of lists, from 0."""
    bounds = column.offsets.to_numpy()
    return bounds - bounds[0], column.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]


def _answers(table: pa.Table, block: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """Query and document of what satisfies the queries of a block in a chunk of documents, and the ids of the latter.

    A clause is the conjunction of the bits of its terms, turned over for negated ones; a query is the disjunction of
    its clauses. A run of whole queries holds about ``TILE_ANSWERS`` answers and bytes of bits at most, or is a single
    query. A clause without terms holds for all documents if nothing is asked for, else for none.
    """
    column = table.column("doc_id").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    new = _changes(column)
    doc, ids = np.cumsum(new) - 1, column.take(pa.array(np.flatnonzero(new)))
    n_docs, term = len(ids), table.column("term_no").to_numpy()
    order = np.argsort(term, kind="stable")
    terms, starts = np.unique(term[order], return_index=True)
    doc, starts = doc[order], np.append(starts, len(term))
    # A document without an id is never told apart by a clause of negated terms only.
    nameless = np.packbits(ids.is_null().to_numpy(zero_copy_only=False))
    of_query, positive = _lists(block.column("positive"))
    of_clause, numbers = _lists(block.column("term_nos"))
    _, negated = _lists(block.column("negated"))
    _, n_terms = _lists(block.column("n_terms"))
    cost = np.cumsum(n_docs * (1 + np.diff(of_query) / 8 + np.diff(of_clause) / 8))
    first_term = np.append(0, np.cumsum(n_terms))
    begin = 0
    while begin < len(block):
        limit = TILE_ANSWERS + (cost[begin - 1] if begin else 0)
        end = max(begin + 1, int(np.searchsorted(cost, limit, "right")))
        low, high = of_query[begin], of_query[end]
        asked, turned = (x[first_term[low] : first_term[high]] for x in (numbers, negated))
        here = np.intersect1d(asked, terms)
        at = np.searchsorted(terms, here)
        bits = _bits(doc, starts[at], starts[at + 1], n_docs)
        # The last row is that of a term that no document of the chunk holds.
        bits = np.vstack([bits, np.zeros((1, bits.shape[1]), np.uint8)])
        row = np.searchsorted(here, asked)
        row[~np.isin(asked, here)] = len(here)
        held = bits[row] ^ np.where(turned, np.uint8(255), np.uint8(0))[:, None]
        clauses = np.full((high - low, bits.shape[1]), 255, np.uint8)
        clauses[(n_terms[low:high] == 0) & positive[low:high]] = 0
        filled = np.flatnonzero(n_terms[low:high])
        if len(filled):
            clauses[filled] = np.bitwise_and.reduceat(held, first_term[low:high][filled] - first_term[low], axis=0)
        clauses[~positive[low:high]] |= nameless
        found = np.bitwise_or.reduceat(clauses, of_query[begin:end] - low, axis=0)
        query, place = np.nonzero(np.unpackbits(found, axis=1, count=n_docs))
        yield query + begin, place, ids
        begin = end


def clause_blocks(hits: DataFrame, clauses: DataFrame) -> DataFrame:
    """``query_id, doc_id``: every query of ``clauses`` answered from the documents of ``hits``, each pair once.

    ``hits(doc_id, term_no)`` are the postings of the queries' terms, rows of a document next to each other; a row with
    ``NO_TERM`` stands for a document as such. ``clauses(query_id, positive, terms)`` has a row per clause: whether
    it asks for a term, and its ``(term_no, negated)``. They are written to the shared folder, a row per query. No row
    per query and hit is ever made: a task takes a chunk of documents, reads the queries block by block, and hands on
    the answers only. Memory follows the size of chunk and tile.
    """
    folder = new_path(hits.sparkSession, "clauses")
    listed = clauses.groupBy("query_id").agg(F.collect_list(F.struct("positive", "terms")).alias("clauses"))
    entries = F.flatten("clauses.terms")
    listed.select(
        "query_id",
        F.col("clauses.positive").alias("positive"),
        F.transform("clauses.terms", lambda terms: F.size(terms)).alias("n_terms"),
        F.transform(entries, lambda entry: entry.term_no).alias("term_nos"),
        F.transform(entries, lambda entry: entry.negated).alias("negated"),
    ).write.parquet(folder)
    schema = f"query_id {dict(clauses.dtypes)['query_id']}, doc_id {dict(hits.dtypes)['doc_id']}"

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunk_tables(batches):
            for block in query_blocks(folder):
                for query, place, ids in _answers(table, block):
                    columns = [block.column("query_id").take(pa.array(query)), ids.take(pa.array(place))]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "doc_id"])

    return hits.mapInArrow(answer, schema)
