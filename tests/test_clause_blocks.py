"""Clause tables answered in blocks: against brute force, in tiny tiles, and without a row per clause and document."""

import random
import re

import pytest

from termloom.index import Index
from termloom.operators import blocks, boolean, clause_blocks
from termloom.session import stage

WORDS = [f"w{i}" for i in range(12)]


def postings_of(spark, held):
    rows = [(term, doc, 1, 1.0) for doc, terms in held for term in terms]
    index = spark.createDataFrame(rows, "term string, doc_id bigint, tf bigint, l_d double")
    return Index(index, spark.createDataFrame([(doc, 1.0) for doc, _ in held], "doc_id bigint, l_d double"))


def brute_force(held, clauses):
    queries = {}
    for query, clause, term, negated in set(clauses):
        queries.setdefault(query, {}).setdefault(clause, []).append((term, negated))
    found = set()
    for query, listed in queries.items():
        for doc, terms in held:
            for clause, asked in listed.items():
                known = query is not None and clause is not None
                wanted = {t for t, n in asked if n is False}
                if wanted:
                    holds = known and wanted <= terms and not any(n and t in terms for t, n in asked)
                else:
                    holds = not known or doc is None or not any(t in terms for t, _ in asked)
                if holds:
                    found.add((query, doc))
    return found


@pytest.mark.parametrize("small", [True, False])
def test_clause_blocks_equal_brute_force(spark, monkeypatch, small):
    rng = random.Random(5)
    held = [(doc, {w for w in WORDS[:10] if rng.random() < rng.choice((0.1, 0.5, 0.9))}) for doc in [None, *range(60)]]
    clauses = [
        (rng.choice([None, *range(25)]), rng.choice([None, 1, 2, 3]), rng.choice(WORDS), rng.choice([True, True, False, False, None]))
        for _ in range(200)
    ]
    monkeypatch.setattr(boolean, "fits_broadcast", lambda *a, **k: small)
    monkeypatch.setattr(blocks, "CHUNK_POSTINGS", 20)
    monkeypatch.setattr(blocks, "BLOCK_QUERIES", 4)
    monkeypatch.setattr(clause_blocks, "FLAG_BYTES", 30)
    monkeypatch.setattr(clause_blocks, "TILE_ANSWERS", 100)
    frame = spark.createDataFrame(clauses, "query_id int, clause_id int, term string, negated boolean")
    found = list(map(tuple, boolean.boolean_bulk(postings_of(spark, held), frame).collect()))
    assert len(found) == len(set(found)) and set(found) == brute_force(held, clauses)


def test_no_row_per_clause_and_document_is_dealt(spark, monkeypatch):
    """What is exchanged are the postings of the terms, however many clauses name them."""
    held = [(doc, set(WORDS[: 2 + doc % 9])) for doc in range(50)]
    clauses = [(q, c, w, c == 2) for q in range(30) for c in (1, 2) for w in WORDS[q % 3 :]]
    written = []
    monkeypatch.setattr(boolean, "stage", lambda frame, name: written.append(stage(frame, name)) or written[-1])
    frame = spark.createDataFrame(clauses, "query_id int, clause_id int, term string, negated boolean")
    index = postings_of(spark, held)
    found = boolean.boolean_bulk(index, frame)
    assert set(map(tuple, found.collect())) == brute_force(held, clauses)
    assert max(rows.count() for rows in written) <= len(clauses) < 50 * 30
    text = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(doc_id#", text) and not re.search(r"hashpartitioning\((query|clause)_id#", text)
