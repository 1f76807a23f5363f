"""The pipeline: what each stage keeps, against the operators and brute force."""

import zlib

import numpy as np
import pytest
from conftest_llm import words

import corpus_pipeline

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = "/root/testdata/sf0.001"
    pytest.importorskip("os").path.isdir(folder) or pytest.skip("test tables not there")
    kept = [spark.read.parquet(f"{folder}/documents.parquet")]
    for k, (_, apply) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        apply(spark, kept[-1], folder).write.parquet(path)
        kept.append(spark.read.parquet(path))
    return kept


def ids(frame):
    return {r["doc_id"] for r in frame.select("doc_id").collect()}


def test_stages_only_remove(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert after.columns == before.columns and ids(after) <= ids(before) and 0 < after.count() <= before.count()


def test_dedup_and_decontamination(stages, spark):
    from test_documents import brute_groups

    groups = brute_groups([(r["doc_id"], r["text"]) for r in stages[2].collect()])
    assert ids(stages[3]) == {d for d, (_, top) in groups.items() if d == top}
    flat = lambda t: " ".join(words((t or "").lower()))
    items = [flat(r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    assert not any(b in flat(r["text"]) for r in stages[4].collect() for b in items)


def test_packing_holds_all_that_is_left(stages, spark):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(corpus_pipeline.default_tokenizer_file()).encode
    pieces = {}
    for r in stages[5].orderBy("doc_id", "start").collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == ids(stages[4])
    for r in stages[4].limit(20).collect():
        tokens = np.array(encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        for p in pieces[r["doc_id"]]:
            assert p["ids_crc32"] == zlib.crc32(tokens[p["start"] : p["start"] + p["length"]].tobytes())
    run = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    key = lambda rows: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert key(run.collect()) == key(stages[5].collect())


def test_awkward_rows_pass_through(spark, docs, no_docs, tmp_path):
    folder = str(tmp_path)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").filter("false").write.parquet(f"{folder}/{name}.parquet")
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, docs, folder).count() > 0
        assert apply(spark, no_docs, folder).count() == 0
