"""What a stream of documents costs a batch: no shuffle of texts, no sort by term for norms, no load written twice."""

import re

from pyspark.sql import functions as F

from termloom import add_documents, merge_loads, open_index
from termloom.operators.counts import term_counts, with_norms
from termloom.plans import registered
from termloom.sources import index_store
from termloom.sources.index_store import load_names


def docs(spark, low, high):
    text = F.concat(F.lit("storm wind w"), "id")
    return spark.range(low, high).select(F.col("id").alias("doc_id"), text.alias("text"))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_norms_sort_by_document_only(spark):
    rows = [(1, "the storm storm wind"), (2, "storm"), (3, ""), (4, None)]
    frame = with_norms(term_counts(spark.createDataFrame(rows, "doc_id bigint, text string"), keep_empty=True))
    sorts = [line for line in plan(frame).splitlines() if re.search(r"\bSort \[", line)]
    assert sorts and not any("term#" in line for line in sorts)
    found = frame.groupBy("doc_id").agg(F.count_if("is_first").alias("n"), F.round(F.max("l_d"), 6).alias("l_d"))
    weight = round(((1 + 0.6931471805599453) ** 2 + 1) ** 0.5, 6)
    assert sorted(map(tuple, found.collect())) == [(1, 1, weight), (2, 1, 1.0), (3, 1, 0.0), (4, 1, 0.0)]


def test_known_ids_are_looked_up_without_a_shuffle_of_texts(spark, tmp_path, monkeypatch):
    path, plans, write = str(tmp_path / "ix"), [], index_store._count_and_write
    add_documents(docs(spark, 0, 20), path, "a")
    monkeypatch.setattr(index_store, "_count_and_write", lambda s, d, *rest: plans.append(plan(d)) or write(s, d, *rest))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        add_documents(docs(spark, 10, 30), path, "b")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in plans[0] and "BroadcastHashJoin" in plans[0] and "hashpartitioning" not in plans[0]
    assert open_index(spark, path).doc_stats.count() == 30


def test_loads_that_merge_again_at_once_are_written_once(spark, tmp_path, monkeypatch):
    path, written, write = str(tmp_path / "ix"), [], index_store.write_load
    for name, low, high in (("a", 0, 2), ("b", 2, 3), ("c", 3, 4), ("d", 4, 12)):
        add_documents(docs(spark, low, high), path, name)
    monkeypatch.setattr(index_store, "write_load", lambda *a, **k: written.append(k["replaces"]) or write(*a, **k))
    merge_loads(spark, path, fan=2)
    assert written == [["a", "b", "c"]] and len(load_names(spark, path)) == 2
    index = open_index(spark, path)
    assert index.doc_stats.count() == 12 and index.postings.count() == 36


def test_arrivals_are_written_by_many_tasks(spark, tmp_path):
    folder = str(tmp_path)
    rows = docs(spark, 0, 200).withColumn("text", F.when(F.col("doc_id") != 7, F.col("text")))
    rows.repartition(5).write.parquet(f"{folder}/documents.parquet")
    paths = []
    original = registered.new_path
    try:
        registered.new_path = lambda s, name: paths.append(original(s, name)) or paths[-1]
        index = open_index(spark, registered._stream(spark, folder, 2))
    finally:
        registered.new_path = original
    arrived = spark.read.parquet(next(p for p in paths if "/arriving-" in p))
    assert arrived.count() == 220 and len(arrived.inputFiles()) > 3
    assert index.doc_stats.count() == 200 and index.postings.count() == 3 * 199
