"""The plans that matter at scale: what is pushed down, what is shuffled, what is cut before a shuffle."""

import re

from pyspark.sql import functions as F

from termloom import add_documents, boolean_search, index_documents, lay_out, open_index, vector_bulk, vector_search
from termloom.operators import joins
from termloom.operators.bitmaps import write_bitmaps
from termloom.operators.counts import doc_norms, posting_lists, term_counts
from termloom.sources.documents import first_per_document


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path):
    rows = [(i, f"storm wind w{i} {'rain' if i % 2 else 'sun'}") for i in range(40)]
    add_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path / "ix"), "a")
    return open_index(spark, str(tmp_path / "ix"))


def test_terms_reach_the_scan_without_a_shuffle_of_postings_by_term(spark, tmp_path):
    index = stored(spark, tmp_path)
    for found in (vector_search(index, "rain storm", above=0), boolean_search(index, "rain and storm")):
        text = plan(found)
        assert re.search(r"PushedFilters: \[[^\]]*In\(term, \[rain,storm\]\)", text)
        assert "hashpartitioning(term" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "doc_stats" not in plan(vector_search(index, "rain storm", above=0))
    assert "doc_stats" not in plan(boolean_search(index, "rain and storm"))


def test_one_shuffle_of_texts_for_counts_and_norms(spark, tmp_path):
    docs = spark.range(10).select(F.col("id").alias("doc_id"), F.lit("storm wind").alias("text"))
    for frame in (term_counts(docs), term_counts(docs, stem=True), doc_norms(docs), index_documents(docs).postings):
        assert plan(frame).count("Exchange ") == 1


def test_top_k_is_cut_before_the_shuffle(spark, tmp_path):
    queries = spark.createDataFrame([(1, "rain storm"), (2, "sun")], "query_id bigint, text string")
    text = plan(vector_bulk(stored(spark, tmp_path), queries, top=3))
    assert text.count("WindowGroupLimit") == 2 and "NestedLoop" not in text and "CartesianProduct" not in text


def test_repeated_ids_are_cut_before_the_shuffle(spark):
    docs = spark.range(10).select((F.col("id") % 2).alias("doc_id"), F.col("id").alias("path"))
    assert plan(first_per_document(docs, "path")).count("WindowGroupLimit") == 2


def test_bucketed_scores_need_no_exchange(spark, tmp_path):
    laid = lay_out(stored(spark, tmp_path), "plans", str(tmp_path / "tables"), 4)
    queries = spark.createDataFrame([(1, "rain storm"), (2, "sun")], "query_id bigint, text string")
    text = plan(vector_bulk(laid, queries, top=3))
    assert "hashpartitioning(query_id#" in text and not re.search(r"hashpartitioning\(query_id#\w+, doc_id", text)


def test_no_order_by_text(spark, tmp_path):
    pages = spark.createDataFrame([("http://a/1", "<p>x")], "url string, html string")
    from termloom.sources.documents import page_documents

    text = plan(first_per_document(page_documents(pages, keep=("url",)), "url"))
    assert "Sort" in text and not any("text" in line.split("[", 1)[-1].split("]")[0] for line in text.splitlines() if "Sort [" in line)


def test_bulk_boolean_reads_postings_and_clauses_once(spark, tmp_path, monkeypatch):
    from termloom.operators import boolean

    index, staged = stored(spark, tmp_path), []
    monkeypatch.setattr(boolean, "stage", lambda frame, name: staged.append(plan(frame)) or stage(frame, name))
    from termloom.session import stage

    rows = [(1, 1, "rain", False), (1, 1, "storm", True), (2, 1, "sun", True), (3, 1, "w1", True)]
    clauses = stage(spark.createDataFrame(rows, "query_id bigint, clause_id int, term string, negated boolean"), "c")
    found = boolean.boolean_bulk(index, clauses)
    whole = "".join(staged) + plan(found)
    assert len(re.findall(r"FileScan parquet \[term#\d+,doc_id#\d+L?\]", whole)) == 1
    assert len(re.findall(r"FileScan parquet \[query_id[^\]]*clause_id[^\]]*term[^\]]*negated", staged[0])) == 1
    assert sorted(map(tuple, found.collect()))[:2] == [(2, 1), (2, 3)]


def rows_read(frame):
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_rare_term_reads_few_row_groups_of_many_loads(spark, tmp_path):
    """Every load has terms before and after the wanted one, so only the filter of terms tells."""
    path = str(tmp_path / "ix")
    for load in range(6):
        rows = [(load * 1000 + i, f"a{load}x{i} storm{load}x{i} z{load}x{i}") for i in range(300)]
        add_documents(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), path, str(load))
    index = open_index(spark, path)
    found = index.postings.filter("term = 'storm3x77'").select("doc_id")
    assert [r["doc_id"] for r in found.collect()] == [3077]
    assert 0 < rows_read(found) <= 900 and index.postings.count() == 6 * 900
    assert rows_read(index.postings.filter("term = 'storm9x9'").select("doc_id")) == 0


def test_tasks_follow_the_input(spark, tmp_path, monkeypatch):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("storm wind w"), "id").alias("text"))
    monkeypatch.setattr(joins, "TASK_TEXT", 500)
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    for frame in (term_counts(docs), term_counts(docs, stem=True), doc_norms(docs)):
        assert 25 <= int(re.search(r"hashpartitioning\(doc_id#\w+, (\d+)\)", plan(frame))[1]) <= 40
    add_documents(docs, str(tmp_path / "ix"), "a")
    index = open_index(spark, str(tmp_path / "ix"))
    assert len(index.postings.inputFiles()) >= 20
    assert "segment#" in re.search(r"hashpartitioning\(.*, 30\)", plan(posting_lists(index, 10)))[0]
    words = write_bitmaps(index, str(tmp_path / "maps")).words
    assert len(words.inputFiles()) >= 20
    assert words.agg(F.sum(F.bit_count("bits"))).first()[0] == index.postings.count() == 3000
