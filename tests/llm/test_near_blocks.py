"""Large groups of near copies: blocks inside tasks instead of a row per pair, with the same groups."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import shingles

from termloom.llm import near_dup as nd
from termloom.llm.near_dup import common_counts, near_duplicates


def chain(n, draw):
    """Each copy differs from the one before in one of 120 words."""
    words, found = [f"c{k}" for k in range(120)], []
    for i in range(n):
        words[draw.randrange(120)] = f"n{i}"
        found.append(" ".join(words))
    return found


def family(n, draw, share):
    """Copies of one text, each with some of its words replaced: most pairs are alike, but not enough."""
    words = [f"f{k}" for k in range(150)]
    return [" ".join(f"r{draw.randrange(10**9)}" if draw.random() < share else w for w in words) for _ in range(n)]


def groups(texts):
    sets = [shingles(t) for t in texts]
    top = list(range(len(texts)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {(i, len(s), root(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize("paired,cell,edges", [(32, 512, 200_000), (2, 16, 0)])
def test_chain_and_family_equal_brute_force(spark, monkeypatch, paired, cell, edges):
    monkeypatch.setattr(nd, "PAIRED_MEMBERS", paired)
    monkeypatch.setattr(nd, "CELL_MEMBERS", cell)
    monkeypatch.setattr(nd, "EDGES_PER_TASK", edges)
    draw = random.Random(paired)
    texts = chain(150, draw) + family(150, draw, 0.02) + family(60, draw, 0.006) + ["", "one two", "one two", "alone in here"]
    draw.shuffle(texts)
    sizes, compared = [], nd._paired
    monkeypatch.setattr(nd, "_paired", lambda signed: sizes.append(compared(signed)) or sizes[-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = near_duplicates(docs).collect()
    expected = groups(texts)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"] if r["n_shingles"] else r["doc_id"]) for r in found} == expected
    # Rows follow the members: those of small buckets, times the members that a bucket may pair.
    assert all(frame.count() <= 32 * paired * len(texts) for frame in sizes)


def test_no_candidates_end_early(spark, monkeypatch):
    monkeypatch.setattr(nd, "verify", lambda *a: pytest.fail("nothing to verify"))
    docs = spark.createDataFrame([(i, " ".join(f"u{i}x{k}" for k in range(40))) for i in range(50)], "doc_id bigint, text string")
    assert all(r["kept"] and r["component_id"] == r["doc_id"] for r in near_duplicates(docs).collect())


def test_rows_that_share_an_id_in_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(nd, "PAIRED_MEMBERS", 1)
    monkeypatch.setattr(nd, "BANDS_PER_BUCKET", (1,))
    draw = random.Random(9)
    one, other = chain(3, draw), family(3, draw, 0.004)
    rows = [(1, one[0]), (2, one[1]), (2, other[0]), (3, other[1]), (4, other[2]), (4, other[2]), (None, one[2])]
    found = {(r["doc_id"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 1), (None, None)}


def test_common_counts(monkeypatch):
    monkeypatch.setattr(nd, "COLUMNS", 7)
    draw = random.Random(5)
    sets = [sorted(draw.sample(range(80), draw.randint(0, 40))) for _ in range(30)]
    flat = np.array([x for s in sets for x in s], np.int64)
    owner = np.repeat(np.arange(30), [len(s) for s in sets])
    assert common_counts(flat, owner, 30).tolist() == [[len(set(a) & set(b)) if a is not b else common_self(a, sets, i) for b in sets] for i, a in enumerate(sets)]


def common_self(own, sets, i):
    """Only shingles that another set holds too are counted with the set itself."""
    return sum(any(x in s for j, s in enumerate(sets) if j != i) for x in own)


def test_a_block_of_two_cells_compares_across(monkeypatch):
    sets = [[1, 2, 3, 4], [1, 2, 3, 4, 5], [1, 2, 3, 4, 6], [9, 10]]
    bits = [[0] * 8] * 4
    table = lambda cells: pa.table({
        "block": [0] * 4, "cell": cells, "doc_id": [1, 2, 3, 4], "component_id": [1, 2, 3, 4], "n_shingles": [len(s) for s in sets],
        "bits": bits, "shingles": sets,
    })
    pairs = lambda cells: sorted(zip(*nd._compare_block(table(cells)).to_pydict().values()))
    assert pairs([0, 0, 0, 0]) == [(2, 1), (3, 1)] and pairs([0, 0, 1, 1]) == [(3, 1)] and pairs([0, 1, 1, 0]) == [(2, 1), (3, 1)]
