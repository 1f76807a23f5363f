"""Boolean retrieval on bitmaps gives what it gives on postings."""

import random

import pytest
from test_bulk import ANSWERS, CLAUSES

from termloom import BadQuery, bitmap_bulk, bitmap_search, boolean_bulk, boolean_search, index_documents, write_bitmaps

EXPRESSIONS = [
    "w0", "not w0", "not not w1", "w0 and w1", "w0 or w1 and not w2", "not (w0 or w1) and not w2", "w3 and nosuch", "not nosuch",
    "(w4 or w5) and (w6 or not w7)", "not w0 or w9", "w1 and not w1", "w1 or not w1",
]


def rows(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.fixture(scope="module")
def index(spark):
    draw = random.Random(3)
    docs = [(i * 7, " ".join(f"w{k}" for k in range(12) if draw.random() < 0.9 / (k + 1))) for i in range(333)]
    found = index_documents(spark.createDataFrame(docs, "doc_id bigint, text string"))
    return type(found)(found.postings.cache(), found.doc_stats.cache())


@pytest.fixture(scope="module")
def maps(index, tmp_path_factory):
    return write_bitmaps(index, str(tmp_path_factory.mktemp("maps") / "b"))


@pytest.mark.parametrize("query", EXPRESSIONS)
def test_expressions(index, maps, query):
    assert rows(bitmap_search(maps, query)) == rows(boolean_search(index, query))


def test_shape(index, maps):
    assert maps.docs.count() == -(-333 // 64)
    assert maps.words.count() < index.postings.count() / 4
    ids = [i for r in sorted(maps.docs.collect(), key=lambda r: r["word"]) for i in r["ids"]]
    assert ids == sorted(i * 7 for i in range(333))


def test_bad_queries(maps):
    for query in ("w0 and", "(w0", "the", "w0 w1"):
        with pytest.raises(BadQuery):
            bitmap_search(maps, query)


def clause_table(spark):
    draw = random.Random(4)
    found = [(q, c, f"w{draw.randrange(13)}", draw.random() < 0.5) for q in range(40) for c in range(draw.randint(1, 3)) for _ in range(draw.randint(1, 3))]
    found += [(100, 1, "w0", True), (101, 1, "w0", True), (101, 2, "w1", True), (102, 1, "nosuch", True), (103, 1, "nosuch", False)]
    return spark.createDataFrame(found, "query_id int, clause_id int, term string, negated boolean")


@pytest.mark.parametrize("fits", [True, False])
def test_clause_tables(spark, index, maps, monkeypatch, fits):
    clauses = clause_table(spark)
    expected = rows(boolean_bulk(index, clauses))
    if not fits:
        for module in ("bitmaps", "boolean", "joins"):
            monkeypatch.setattr(f"termloom.operators.{module}.fits_broadcast", lambda *a, **k: False)
        monkeypatch.setattr("termloom.operators.joins.MIN_CELL_ROWS", 1)
        monkeypatch.setattr("termloom.operators.joins.PAIRS_PER_CELL", 3)
        assert rows(boolean_bulk(index, clauses)) == expected
    assert rows(bitmap_bulk(maps, clauses)) == expected


def test_text_ids(spark, english, tmp_path):
    maps = write_bitmaps(english, str(tmp_path / "b"))
    clauses = spark.createDataFrame(CLAUSES, "query_id int, clause_id int, term string, negated boolean")
    assert rows(bitmap_bulk(maps, clauses)) == sorted((q, d) for q, docs in ANSWERS.items() for d in docs)
    assert rows(bitmap_search(maps, "gulf or typhoon and not katrina")) == [("d1.txt", 1), ("d2.txt", 1)]


def test_empty_index(spark, tmp_path):
    none = index_documents(spark.createDataFrame([], "doc_id bigint, text string"))
    maps = write_bitmaps(none, str(tmp_path / "b"))
    assert rows(bitmap_search(maps, "not w0")) == [] and rows(bitmap_bulk(maps, clause_table(spark))) == []
