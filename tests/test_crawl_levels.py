"""Traversal from both sides: the links of the frontier, or those that lead to nodes not seen yet."""

import random
import re

import pytest
from pyspark.sql import functions as F

from termloom.operators import crawl as module
from termloom.operators.crawl import _Graph, _Seen, _Size, next_level, reach, reach_recursive
from termloom.session import stage


def graph(spark, n=300, seed=5):
    draw = random.Random(seed)
    # A third of all links lead to one node; a chain makes some levels small again.
    pairs = {(draw.randrange(n), 0 if draw.random() < 0.33 else draw.randrange(n)) for _ in range(3 * n)}
    pairs |= {(n + i, n + i + 1) for i in range(6)} | {(n - 1, n), (n + 6, n + 7)} | {(n + 7, n + 8 + k) for k in range(50)}
    return pairs, stage(spark.createDataFrame(sorted(pairs), "src bigint, dst bigint"), "graph")


def depths(pairs, seeds, limit=10**9, known=()):
    found, level, depth = {s: 0 for s in seeds if s not in known}, [s for s in seeds if s not in known], 0
    while level and depth <= limit:
        depth += 1
        level = sorted({b for a, b in pairs if a in set(level)} - set(found) - set(known))
        found |= dict.fromkeys(level, depth)
    return found


def run(spark, edges, seeds, **options):
    rows = reach(edges, spark.createDataFrame([(s,) for s in seeds], "node bigint"), **options).collect()
    assert len({r["node"] for r in rows}) == len(rows)
    return rows


@pytest.mark.parametrize("share,fits", [(0, True), (1 << 40, True), (20, True), (20, False)])
def test_both_ways_reach_the_same(spark, monkeypatch, share, fits):
    monkeypatch.setattr(module, "BOTTOM_UP_SHARE", share)
    monkeypatch.setattr(module, "BOTTOM_UP_EDGES", 1)
    if not fits:
        monkeypatch.setattr(module, "BROADCAST_ROWS", -1)
        monkeypatch.setattr("termloom.operators.joins.MIN_CELL_ROWS", 1)
    pairs, edges = graph(spark)
    used, both = [], module.next_level
    monkeypatch.setattr(module, "next_level", lambda g, f, n, s: used.append("by_target" in g.__dict__) or both(g, f, n, s))
    assert {r["node"]: r["depth"] for r in run(spark, edges, [1, 7])} == depths(pairs, [1, 7])
    if share == 20 and fits:
        # Small, large, small again.
        assert used[0] is False and used[-1] is True
    known = spark.createDataFrame([(0,), (7,), (9,)], "node bigint")
    rows = run(spark, edges, [1, 7], max_depth=2, known=known)
    assert {r["node"]: r["depth"] for r in rows} == depths(pairs, [1, 7], 2, {0, 7, 9})
    assert all(r["attempted"] == (r["depth"] <= 2) for r in rows)


@pytest.mark.parametrize("budget", [0, 1, 40])
def test_budget_over_levels(spark, budget):
    pairs, edges = graph(spark)
    rows = run(spark, edges, [1, 7], max_pages=budget)
    attempted = sorted((r["depth"], r["node"]) for r in rows if r["attempted"])
    order = sorted((d, n) for n, d in depths(pairs, [1, 7]).items())
    assert attempted == order[:budget]


def test_without_seeds(spark):
    _, edges = graph(spark)
    assert run(spark, edges, []) == []
    known = spark.createDataFrame([(1,)], "node bigint")
    assert run(spark, edges, [1], known=known) == []


def test_the_seen_nodes_are_never_shuffled(spark, monkeypatch):
    monkeypatch.setattr(module, "BOTTOM_UP_EDGES", 1)
    pairs, edges = graph(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        seen, links = _Seen(spark), _Graph(edges)
        for depth in range(4):
            seen.add(spark.range(40 * depth, 40 * depth + 40).select(F.col("id").alias("node")), depth)
        frontier = seen.level(3)
        for share, exchanges in ((0, 1), (1 << 40, 0)):
            monkeypatch.setattr(module, "BOTTOM_UP_SHARE", share)
            found = next_level(links, frontier, _Size(40, 0), seen)
            text = found._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"Exchange hashpartitioning", text)) == exchanges, text
            assert {r["node"] for r in found.collect()} == {b for a, b in pairs if 120 <= a < 160} - set(range(160))
        links.close()
        seen.close()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("seen_", "links_"))]


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_one_recursive_statement(spark, depth):
    pairs, edges = graph(spark)
    seeds = spark.createDataFrame([(1,), (7,), (7,)], "node bigint")
    found = {r["node"]: r["depth"] for r in reach_recursive(edges, seeds, depth).collect()}
    assert found == {n: d for n, d in depths(pairs, [1, 7]).items() if d <= depth}
    with pytest.raises(ValueError):
        reach_recursive(edges, seeds, -1)
