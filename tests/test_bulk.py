import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termloom import UnknownTerm, boolean_bulk, vector_bulk, vector_search
from termloom.operators import boolean, ranked
from termloom.operators.joins import fits_broadcast, hot_keys, join_hot


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def scores(frame):
    return rows(frame.select(*[F.round(c, 6).alias(c) if c == "score" else F.col(c) for c in frame.columns]))


@pytest.fixture(scope="module")
def queries(spark):
    texts = ["katrina hurricane", "hurricane hurricane nosuch", "tropical cyclone and storm", "", "and and or"]
    return spark.createDataFrame(list(enumerate(texts)), "query_id bigint, text string")


def test_bulk_equals_one_by_one(english, queries):
    found = scores(vector_bulk(english, queries, above=0))
    expected = []
    for query in queries.collect():
        best = vector_search(english, query["text"], above=0, on_missing="skip").collect()
        expected += [(query["query_id"], r["doc_id"], round(r["score"], 6), i) for i, r in enumerate(best, 1)]
    assert found == sorted(expected)
    assert scores(vector_bulk(english, queries, above=0, top=2)) == [r for r in found if r[3] <= 2]
    assert scores(vector_bulk(english, queries, top=0)) == []
    with pytest.raises(UnknownTerm, match="nosuch"):
        vector_bulk(english, queries, on_missing="error")


def test_bulk_beyond_the_broadcast_bound(english, queries, monkeypatch):
    expected = scores(vector_bulk(english, queries, above=0))
    monkeypatch.setattr(ranked, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr("termloom.operators.joins.MIN_CELL_ROWS", 1)
    assert scores(vector_bulk(english, queries, above=0)) == expected


def test_join_hot_meets_each_pair_once(spark):
    left = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).alias("k"), "id")
    right = spark.range(200).select((F.when(F.col("id") < 80, 0).otherwise(F.col("id") % 60)).alias("k"), F.col("id").alias("r"))
    joined = join_hot(left, right, "k", ["id"], ["r"], min_cell_rows=30)
    assert rows(joined.select("k", "id", "r")) == rows(left.join(right, "k").select("k", "id", "r"))
    assert hot_keys(left, "k", "n", 30).filter("k = 0").first()["n"] > 10
    unique = spark.range(40).withColumnRenamed("id", "k")
    assert rows(join_hot(left, unique, "k", ["id"], min_cell_rows=30)) == rows(left.join(unique, "k"))


def test_size_check(spark):
    frame = spark.range(100).select(F.repeat(F.lit("x"), 10).alias("s"))
    assert fits_broadcast(frame) and not fits_broadcast(frame, rows=99) and not fits_broadcast(frame, chars=999)


def test_rank_of_one_hot_query_with_ties(spark):
    frame = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5).alias("query_id"),
        F.col("id").alias("doc_id"),
        (F.col("id") % 4).cast("double").alias("score"),
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    expected = frame.withColumn("rank", F.row_number().over(order).cast("bigint"))
    assert rows(ranked.rank_all(frame.repartition(16), ["query_id"])) == rows(expected)


CLAUSES = [
    (1, 1, "Katrina", False), (1, 1, "gulf", True), (1, 2, "typhoon", False),
    (2, 1, "katrina", True),
    (3, 1, "nosuch", False), (3, 2, "nosuch", False), (3, 2, "katrina", False),
    (4, 1, "nosuch", True), (4, 2, "katrina", False),
    (5, 1, "typhoon", True), (5, 2, "gulf", True), (5, 2, "katrina", True),
    (6, 1, "katrina", False), (6, 1, "katrina", True),
]
ANSWERS = {1: ["d2.txt", "d3.txt"], 2: ["d2.txt"], 4: ["d1.txt", "d2.txt", "d3.txt"], 5: ["d1.txt", "d2.txt", "d3.txt"]}


@pytest.mark.parametrize("pairs", [4_000_000, 1])
def test_clause_tables(spark, english, monkeypatch, pairs):
    monkeypatch.setattr("termloom.operators.joins.PAIRS_PER_CELL", pairs)
    clauses = spark.createDataFrame(CLAUSES, "query_id int, clause_id int, term string, negated boolean")
    assert rows(boolean_bulk(english, clauses)) == sorted((q, d) for q, docs in ANSWERS.items() for d in docs)


def test_clause_tables_beyond_the_broadcast_bound(spark, english, monkeypatch):
    monkeypatch.setattr(boolean, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr("termloom.operators.joins.MIN_CELL_ROWS", 1)
    clauses = spark.createDataFrame(CLAUSES, "query_id int, clause_id int, term string, negated boolean")
    assert rows(boolean_bulk(english, clauses)) == sorted((q, d) for q, docs in ANSWERS.items() for d in docs)


def test_clause_operands_are_checked(spark, english):
    clauses = spark.createDataFrame([(1, 1, "the", False)], "query_id int, clause_id int, term string, negated boolean")
    with pytest.raises(Exception, match="stopword or not a term: the"):
        boolean_bulk(english, clauses).collect()


def test_stems_looked_up_equal_stems_in_place(spark, english, monkeypatch):
    from termloom.operators import stems

    counts = english.postings.select("doc_id", "term", "tf")
    expected = rows(stems.stem_counts(counts))
    whole = stems.stem_vocabulary(counts)
    frequent = stems.frequent_stems(counts, share=60)
    assert 0 < frequent.count() < whole.count()
    for fits in (True, False):
        monkeypatch.setattr(stems, "fits_broadcast", lambda *a, fits=fits, **k: fits)
        for vocabulary in (whole, frequent, whole.limit(3), whole.limit(0)):
            assert rows(stems.stem_counts(counts, vocabulary)) == expected


def test_terms_beyond_the_vocabulary_are_stemmed_too(spark, monkeypatch):
    from termloom.operators import stems

    counts = spark.createDataFrame([(1, "storms", 2), (1, "winds", 1), (1, None, 0)], "doc_id bigint, term string, tf bigint")
    vocabulary = spark.createDataFrame([("storms", "storm")], "term string, stem string")
    for fits in (True, False):
        monkeypatch.setattr(stems, "fits_broadcast", lambda *a, fits=fits, **k: fits)
        found = {r["term"]: r["tf"] for r in stems.stem_counts(counts, vocabulary).collect()}
        assert found == {"storm": 2, "wind": 1, None: 0}
