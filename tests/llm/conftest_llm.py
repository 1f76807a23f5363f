"""Words as the contracts define them, for brute-force comparisons."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def shingles(text, size=5):
    w = words(text, lower=True)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
