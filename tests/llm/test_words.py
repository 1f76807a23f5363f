import random

import numpy as np
import pyarrow as pa
from conftest_llm import LOWER, WORD

from termloom.llm.words import Spans, find_words, range_hashes, text_groups, window_hashes


def test_words_of_awkward_texts(texts):
    found = []
    for group in text_groups(pa.array(texts), group_bytes=200):
        words = find_words(group)
        data = group.data.tobytes()
        cut = [data[a:b].decode() for a, b in zip(words.start, words.end)]
        at = np.cumsum(words.per_text)
        found += [cut[a:b] for a, b in zip(at - words.per_text, at)]
    assert found == [WORD.findall(t or "") for t in texts]


def test_hash_depends_on_the_bytes_alone(texts):
    known, back = {}, {}
    for size in (50, 1000, 1 << 20):
        for group in text_groups(pa.array(texts), group_bytes=size):
            words = find_words(group, lower=True)
            for h, a, b in zip(words.hash.tolist(), words.start, words.end):
                word = group.data[a:b].tobytes().decode().translate(LOWER)
                assert known.setdefault(word, h) == h and back.setdefault(h, word) == word


def test_blocks_give_the_same_hashes():
    data = np.frombuffer(random.Random(5).randbytes(4000), np.uint8)
    start = np.arange(0, 3900, 13)
    whole = Spans(data).hash(start, start + 13)
    assert (range_hashes(data, start, start + 13, block_bytes=100) == whole).all()


def test_windows_stay_inside_texts():
    (group,) = text_groups(pa.array(["a b c", "a b c d", "b"]))
    hashes, first = window_hashes(find_words(group), 3)
    assert first.tolist() == [0, 3, 4] and hashes[0] == hashes[1] != hashes[2]
    assert len(window_hashes(find_words(group), 9)[0]) == 0


def test_sliced_and_empty_columns():
    column = pa.array(["x y", None, "z"]).slice(1)
    assert [find_words(g).per_text.tolist() for g in text_groups(column)] == [[0, 1]]
    assert list(text_groups(pa.array([], pa.string()))) == []
