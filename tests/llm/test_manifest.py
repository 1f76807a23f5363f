"""Merkle manifest against a plain computation."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from termloom.llm import merkle
from termloom.llm.merkle import leaves, manifest, manifest_proofs, proofs

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"
TAMPERED = "crc32(cast(doc_id AS string)) % 5 = 0"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_digest(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """Root of a list of digests, and for each of them the siblings before and after it on every level."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for k, place in enumerate(at):
            run = runs[place // 16]
            steps[k].append((run[: place % 16], run[place % 16 + 1 :]))
        nodes, at = [sha("".join(run)) for run in runs], [place // 16 for place in at]
    return nodes[0], steps


def expected(rows):
    sources = {}
    for row in rows:
        doc_id, source, lang, n_chars, text = row
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        changed = row_digest((doc_id, source, lang, n_chars, lowered(text))) if hit else None
        sources.setdefault(source, []).append((doc_id, row_digest(row), changed))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    within = []
    for source in order:
        sources[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] or ""))
        within.append(climb([r[1] for r in sources[source]]))
    root, over = climb([top for top, _ in within])
    found = []
    for source, (subroot, steps), more in zip(order, within, over):
        for (doc_id, leaf, changed), own in zip(sources[source], steps):
            node = changed or leaf
            for before, after in own + more:
                node = sha("".join(before) + node + "".join(after))
            proof = sha("".join("".join(b + a) for b, a in own + more))
            found.append((doc_id, leaf, subroot, root, proof, node, node == root))
    return sorted(map(repr, found))


def check(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = manifest_proofs(docs.withColumns({"leaf": F.lit(1), "tree": F.lit("x"), "idx": F.lit(None)}), F.expr(TAMPERED))
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected(rows)


def corpus(n, sources):
    draw = random.Random(n)
    return [(i, sources(i), draw.choice(["en", "de", None]), i * 3, f"Text {i % 7} NUMBER ünd {i}") for i in range(n)]


def test_one_source_and_one_row(spark):
    check(spark, [(5, "a", "en", 4, "Text")])
    check(spark, corpus(2, lambda i: "a"))
    check(spark, corpus(17, lambda i: None))


def test_many_levels_with_a_hot_source(spark):
    # 4,500 rows of one source take four levels, 300 of others one or none, and the top three.
    rows = corpus(4500, lambda i: "hot") + [(10_000 + i, f"s{i % 290}", "en", i, f"More {i}") for i in range(300)]
    check(spark, rows, parts=7)


def test_sources_with_one_row_each(spark):
    check(spark, corpus(300, lambda i: f"s{i}" if i else None))


def test_nulls_repeats_and_long_texts(spark):
    rows = [
        (None, None, None, None, None), (None, "a", "en", 1, "x"), (1, "a", "en", 1, ""), (1, "a", "en", 1, ""),
        (1, "a", "en", 1, "other"), (-7, "a", None, None, "Ñandú ΟΔΟΣ 日本語"), (2, "", "", 0, "A" * 300_000), (3, "Ä", "en", 2, "ZZ"),
        (4, "z", "en", 2, "-"), (10, "z", "en", 2, "1:a"), (20, "-", "en", 2, None),
    ]
    check(spark, rows)
    check(spark, rows * 5)


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(merkle, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr("termloom.operators.joins.MIN_CELL_ROWS", 1)
    check(spark, corpus(900, lambda i: "hot" if i % 3 else f"s{i}"))


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    made = manifest(leaves(docs, F.expr(TAMPERED)))
    assert made.root is None and proofs(made).count() == 0
    assert manifest_proofs(docs, F.expr(TAMPERED)).count() == 0


def test_proofs_are_those_of_the_stated_root(spark):
    made = manifest(leaves(spark.createDataFrame(corpus(40, lambda i: "ab"[i % 2]), SCHEMA), F.lit(False)))
    for row in proofs(made).collect():
        node = row["leaf"]
        for step in row["steps"]:
            node = sha(step["before"] + node + step["after"])
        assert node == made.root == row["root"] and row["changed"] is None


@pytest.mark.parametrize("n", [16, 256, 257])
def test_full_runs(spark, n):
    check(spark, corpus(n, lambda i: "a"))
