"""Exact top-k search against brute force."""

import math
import random

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from termloom.llm import top_k as module
from termloom.llm.top_k import nearest_vectors, top_k

SCHEMA = "vec_id bigint, embedding array<float>"
EVERY_20TH = "vec_id % 20 = 0"


def expected(rows, k=20, scale=64, query=lambda i: i % 20 == 0):
    import numpy as np

    kept = []
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(scale * float(np.float32(x))) for x in vector]))
    asked = {}
    for vec_id, vector in kept:
        if query(vec_id):
            asked[vec_id] = min(asked.get(vec_id, vector), vector)
    found = []
    for query_id, wanted in asked.items():
        scored = [(-sum(a * b for a, b in zip(wanted, v)), i) for i, v in kept if i != query_id and len(v) == len(wanted)]
        found += [(query_id, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found)


def check(spark, rows, k=20, parts=4):
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = nearest_vectors(table.withColumns({"query_id": F.lit("x"), "score": F.lit(None), "rank": F.lit(0)}), F.expr(EVERY_20TH), k)
    assert sorted(map(tuple, found.collect())) == expected(rows, k)


def vectors(n, size, spread=1.0, seed=0):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, spread) for _ in range(size)]) for i in range(n)]


@pytest.mark.parametrize("size,spread", [(8, 0.2), (64, 1.0), (3, 0.01), (5, 300.0), (4, 1e6)])
def test_equals_brute_force(spark, size, spread):
    check(spark, vectors(700, size, spread))


def test_small_chunks_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK_VECTORS", 50)
    monkeypatch.setattr(module, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(module, "TILE_SCORES", 60)
    # Workers get the module as it is here, sizes included.
    cloudpickle.register_pickle_by_value(module)
    try:
        check(spark, vectors(400, 6), k=5)
        check(spark, [(i, [0.5, -0.25] if i % 3 else [0.25, 0.25]) for i in range(300)], parts=3)
    finally:
        cloudpickle.unregister_pickle_by_value(module)


def test_ties_and_very_common_vectors(spark):
    rows = [(i, [0.5, -0.25] if i % 3 else [0.25, 0.25]) for i in range(600)]
    check(spark, rows, parts=9)
    check(spark, [(i, [0.0, 0.0]) for i in range(100)], k=3)


def test_fewer_candidates_than_asked_for(spark):
    check(spark, vectors(6, 4))
    check(spark, vectors(21, 4))
    check(spark, [(0, [1.0])])


def test_nulls_lengths_and_repeated_ids(spark):
    rows = vectors(90, 3) + [
        (None, [1.0, 1.0, 1.0]), (1000, None), (1020, [1.0, None, 1.0]), (1040, [float("nan"), 0.0, 0.0]),
        (1060, [float("inf"), 0.0, 0.0]), (1080, []), (1100, []), (1120, [1.0, 2.0]), (1121, [3.0, 4.0]), (20, [9.0, 9.0, 9.0]),
        (20, [-9.0, 0.0, 1.0]), (41, [5.0, 5.0, 5.0]), (41, [5.0, 5.0, 5.0]), (-40, [2.0, 2.0, 2.0]),
    ]
    check(spark, rows)


def test_empty_table_and_no_queries(spark):
    assert nearest_vectors(spark.createDataFrame([], SCHEMA), F.expr(EVERY_20TH)).collect() == []
    assert nearest_vectors(spark.createDataFrame([(1, [1.0]), (2, [2.0])], SCHEMA), F.expr(EVERY_20TH)).collect() == []


def test_scores_beyond_64_bits_are_an_error(spark):
    table = spark.createDataFrame([(0, [1e30]), (1, [1e30])], SCHEMA)
    with pytest.raises(OverflowError):
        nearest_vectors(table, F.expr(EVERY_20TH))
    with pytest.raises(ValueError):
        top_k(table, table, 0)


def test_whole_numbers_beyond_floating_point(spark):
    big = (1 << 29) + 1
    rows = [(i, [big + i, big - 3 * i, i]) for i in range(50)]
    found = top_k(
        spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>"),
        spark.createDataFrame(rows[:1], "query_id bigint, vector array<bigint>"), k=4,
    )
    scored = sorted((-sum(a * b for a, b in zip(rows[0][1], v)), i) for i, v in rows[1:])
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in found.collect()) == [(n, i, -s) for n, (s, i) in enumerate(scored[:4], 1)]
