"""Quality rules and the quality classifier."""

from collections import Counter

import numpy as np
import pytest
from conftest_llm import WORD, words
from pyspark.sql import functions as F

from termloom.llm.gam import FEATURES, Settings, classify, features, fit
from termloom.llm.quality_rules import SYMBOLS, CompressionBands, passing, quality_rules
from termloom.llm.registered import id_hash


def base(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    repeat = len(covered)
    failed = len(w) < 10 or 100 * repeat > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in SYMBOLS for c in text), len(lines) - len(set(lines)), repeat, failed


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_equal_brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    found = quality_rules(docs).select("doc_id", *COLUMNS).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((r["doc_id"], *base(r["text"]))) for r in rows)


def test_counts_on_the_table(table):
    docs = table("documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in quality_rules(docs).collect():
        assert tuple(row[c] for c in COLUMNS) == base(texts[row["doc_id"]])
        assert not (row["base_failed"] and row["kept"])


def test_bands_reject_repetition_and_noise(spark):
    rng = np.random.default_rng(3)
    prose = " ".join("".join(rng.choice(list("etaoinshr"), rng.integers(2, 9))) for _ in range(900))
    noise = " ".join("".join(chr(c) for c in rng.integers(0x4E00, 0x9FFF, 5)) for _ in range(900))
    hidden = " ".join(f"same{i % 3} phrase{i % 7} again{i % 5}" for i in range(900))
    rows = [(1, prose), (2, noise), (3, hidden)]
    found = {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[1]["kept"] and not found[2]["kept"] and not found[3]["kept"]
    strict = CompressionBands(bad_chunk_share=-1.0)
    assert not any(r["kept"] for r in quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string"), strict).collect())


def test_passing_keeps_rows_and_columns(docs, no_docs):
    kept = passing(docs)
    assert kept.columns == docs.columns
    verdicts = quality_rules(docs).filter("kept").groupBy("doc_id").count().collect()
    assert kept.count() == sum(r["count"] for r in verdicts) and quality_rules(no_docs).count() == 0


def test_model_finds_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit(x[:3000], y[:3000])
    assert {tuple(sorted(p[:2])) for p in model.pairs[:1]} == {(0, 1)}
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert fit(x, y, Settings(pairs=0)).pairs == []


def test_model_without_choice():
    assert fit(np.zeros((0, 2)), np.zeros(0)).score(np.zeros((1, 2))) == 1
    assert fit(np.zeros((3, 2)), np.zeros(3)).score(np.zeros((1, 2))) == 0
    assert fit(np.zeros((3, 2)), np.ones(3)).score(np.zeros((1, 2))) == 1


def test_awkward_documents_are_scored(docs, no_docs, spark):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 0), (7, 1, 0), (8, None, 0), (15, 1, 0), (None, 0, 0)],
                                   "doc_id bigint, quality bigint, toxic bigint")
    found = classify(docs, labels, held_out=id_hash() % 4 == 2).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    assert all(len(r["x"]) == len(FEATURES) and np.isfinite(r["x"]).all() for r in features(docs).collect())
    assert classify(no_docs, labels.filter("false"), held_out=id_hash() % 4 == 2).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    pytest.importorskip("os").path.isdir(folder) or pytest.skip("test tables not there")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    found = classify(docs, labels, held_out=id_hash() % 4 == 2)
    rows = found.filter("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert len(rows) > 50 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    # Labels of the held-out fold have no influence.
    flipped = labels.withColumn("quality", F.when(id_hash() % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = classify(docs, flipped, held_out=id_hash() % 4 == 2)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect()))
