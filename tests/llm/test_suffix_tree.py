"""The suffix tree learns from whatever occurs, and contexts too frequent for a bucket change nothing."""

import random
import zlib

import pytest
from test_documents import brute_tree
from termloom.llm import suffix_tree as st
from termloom.llm.registered import id_hash


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def learnt_ids(n):
    return [d for d in range(10 * n) if not held_out(d)][:n]


def test_what_occurs_twice_is_learnt_in_a_large_corpus(spark):
    """Words and passages far below any share of 250,000 tokens: two copies score better than a text of its own."""
    ids = learnt_ids(53)
    rows = [(d, " ".join(f"w{(i * 7 + d) % 97}" for i in range(5000))) for d in ids[3:]]
    passage = " ".join(f"rare{k}" for k in range(60))
    rows += [(ids[0], passage), (ids[1], passage), (ids[2], " ".join(f"alone{k}" for k in range(60)))]
    found = st.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), id_hash() % 7 == 2).collect()
    score = {r["doc_id"]: r["score"] / r["n_tokens"] for r in found}
    base = {r["doc_id"]: r["base_score"] / r["n_tokens"] for r in found}
    assert score[ids[0]] == pytest.approx(score[ids[1]]) and score[ids[0]] > base[ids[0]] + 3.5
    assert score[ids[0]] > score[ids[2]] + 0.2


@pytest.mark.parametrize("share, entry", [(0.0, 0.0), (0.004, 0.001)])
def test_frequent_contexts_are_dealt_by_older_symbols(spark, monkeypatch, share, entry):
    rnd = random.Random(3)
    rows = [(d, " ".join(rnd.choice(["a", "a", "a", "b", "c", f"x{rnd.randrange(40)}"]) for _ in range(60))) for d in range(90)]
    rows += [(200 + d, "the same line comes again and again") for d in range(60)] + [(300 + d, "") for d in range(40)]
    monkeypatch.setattr(st, "BUCKET_TOKENS", 15)
    monkeypatch.setattr(st, "MIN_SHARE", share)
    monkeypatch.setattr(st, "ENTRY_SHARE", entry)
    expected = brute_tree(rows, held_out)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    blocks, counts = st.number_tokens(frame, id_hash() % 7 != 2)
    frequent, _ = st.frequent_contexts(blocks, st.Shape.of(counts), sum(e[0] for e in expected.values()))
    assert set(frequent.length) == {1, 2, 3, 4}
    found = st.score_documents(frame, id_hash() % 7 == 2).collect()
    assert len(found) == len(rows)
    for r in found:
        n_tokens, n_known, n, base, score = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-6)


def test_words_are_numbered_by_falling_count():
    counts = st.WordCounts(counts=st.np.array([9, 4, 1]), last=st.np.array([1, 3, 7]), end=2, n_tokens=21, n_words=7)
    assert counts.of(st.np.arange(8)).tolist() == [0, 9, 4, 4, 1, 1, 1, 1]
    assert [counts.at_least(n) for n in (10, 9, 5, 4, 0)] == [0, 1, 1, 3, 7]


def test_starts_of_texts_are_dealt_to_all_buckets_of_the_end():
    """Nothing stands before a start, and there are as many as texts."""
    frequent = st.Frequent(plain=3)
    frequent.add(st.np.array([-1]), st.np.array([7]), st.np.array([5]))
    starts = [st.np.full(1000, 7, "uint32"), *(st.np.zeros(1000, "uint32") for _ in range(3))]
    sizes = st.np.bincount(frequent.bucket(starts), minlength=8)
    assert not sizes[:3].any() and sizes[3:].max() < 300
    older = [starts[0], st.np.full(1000, 9, "uint32"), *starts[2:]]
    assert len(set(frequent.bucket(older))) == 1
