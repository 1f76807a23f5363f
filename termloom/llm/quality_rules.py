"""Quality rules: counts of words, symbols and repeats, and bands of compression ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import IS_SPACE, NEWLINE, Texts, find_words, keyed, range_hashes, text_groups, window_hashes

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Band:
    """Limits for texts of at least ``from_bytes``: bytes before over bytes after compression, whole and per chunk."""

    from_bytes: int
    lowest: float
    highest: float


@dataclass(frozen=True)
class CompressionBands:
    """Which compression ratios are taken for natural text.

    ``whole`` is looked up by the length of the document, ``chunk`` by that of the chunk; the last chunk is joined to
    the one before it when it is shorter than half a chunk. A document fails when its own ratio is outside its band,
    or when more than ``bad_chunk_share`` of its bytes lie in chunks outside theirs.
    Short texts compress badly whatever they say, so that both limits rise with length.
    """

    whole: tuple[Band, ...] = (
        Band(0, 0.0, 2.2),
        Band(200, 0.85, 2.4),
        Band(500, 1.1, 2.7),
        Band(1000, 1.25, 3.1),
        Band(2000, 1.35, 3.5),
        Band(5000, 1.5, 4.2),
        Band(20000, 1.6, 5.0),
    )
    chunk: tuple[Band, ...] = (
        Band(0, 0.0, 2.2),
        Band(200, 0.85, 2.4),
        Band(500, 1.1, 2.7),
        Band(1000, 1.25, 3.1),
        Band(2000, 1.35, 3.5),
    )
    chunk_bytes: int = 4096
    bad_chunk_share: float = 0.3
    level: int = 3


SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, n_bytes bigint, whole_ratio double, bad_chunk_share double"
)


def _is(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


_IS_SYMBOL = _is(SYMBOLS)
_STARTS_CHARACTER = (np.arange(256) & 0xC0) != 0x80


def duplicate_lines(texts: Texts, word_starts: np.ndarray) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of it."""
    breaks = np.flatnonzero(texts.data == NEWLINE)
    start = np.unique(np.concatenate([breaks + 1, texts.bounds[:-1]]))
    start = start[start < len(texts.data)]
    if not len(start):
        return np.zeros(len(texts), np.int64)
    end = np.append(start[1:], len(texts.data))
    text = np.searchsorted(texts.bounds, start, "right") - 1
    end = end - (texts.data[end - 1] == NEWLINE)
    with_word = np.searchsorted(word_starts, end) > np.searchsorted(word_starts, start)
    start, end, text = start[with_word], end[with_word], text[with_word]
    lines = np.bincount(text, minlength=len(texts))
    hashes = keyed(range_hashes(texts.data, start, end), text)
    _, first = np.unique(hashes, return_index=True)
    return lines - np.bincount(text[first], minlength=len(texts))


def repeated_words(words, n_texts: int, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Per text: words inside windows of ``size`` words that occur at least twice in it, first occurrences too."""
    hashes, first = window_hashes(words, size)
    if not len(first):
        return np.zeros(n_texts, np.int64)
    hashes = keyed(hashes, words.text[first])
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(first), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(edges, first[twice], 1)
    np.add.at(edges, first[twice] + size, -1)
    return np.bincount(words.text[np.cumsum(edges[:-1]) > 0], minlength=n_texts)


def _outside(ratio: float, n_bytes: int, bands: tuple[Band, ...]) -> bool:
    band = max((b for b in bands if b.from_bytes <= n_bytes), key=lambda b: b.from_bytes)
    return not band.lowest <= ratio <= band.highest


def compression(text: memoryview, bands: CompressionBands, zstd: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Ratio of the whole text, share of its bytes in chunks outside their band, and whether both are in order."""
    if not len(text):
        return 0.0, 0.0, True
    whole = len(text) / len(zstd.compress(text))
    size = bands.chunk_bytes
    n_chunks = max(1, (len(text) + size // 2) // size)
    bad = 0
    for k in range(n_chunks):
        chunk = text[k * size : (k + 1) * size if k + 1 < n_chunks else len(text)]
        ratio = len(chunk) / len(zstd.compress(chunk)) if n_chunks > 1 else whole
        bad += len(chunk) * _outside(ratio, len(chunk), bands.chunk)
    share = bad / len(text)
    return whole, share, not _outside(whole, len(text), bands.whole) and share <= bands.bad_chunk_share


def judge_texts(column: pa.Array, bands: CompressionBands) -> Iterator[dict[str, np.ndarray]]:
    """Counts and verdicts of a column of texts, run by run."""
    zstd = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)
    for texts in text_groups(column):
        words = find_words(texts)
        n_words = words.per_text
        n_repeat = repeated_words(words, len(texts))
        failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
        ratios = [compression(texts.bytes_of(i), bands, zstd) for i in range(len(texts))]
        yield {
            "n_words": n_words,
            "word_chars": texts.count(_STARTS_CHARACTER[texts.data] & ~IS_SPACE[texts.data]),
            "n_symbols": texts.count(_IS_SYMBOL[texts.data]),
            "n_dup_lines": duplicate_lines(texts, words.start),
            "n_repeat_words": n_repeat,
            "base_failed": failed,
            "kept": ~failed & np.array([r[2] for r in ratios], bool),
            "n_bytes": np.diff(texts.bounds),
            "whole_ratio": np.array([r[0] for r in ratios], float),
            "bad_chunk_share": np.array([r[1] for r in ratios], float),
        }


def quality_rules(docs: DataFrame, bands: CompressionBands | None = None) -> DataFrame:
    """Counts and verdict for every row of ``docs(doc_id, text, ...)``; other columns are ignored.

    One pass without a shuffle. A null or empty text has no words and fails the base rule. Repeated rows are judged
    one by one, null ids are kept, an empty table gives no rows. Texts are read whole, up to 1 MB of them at a time;
    a longer text needs some 50 times its own size for as long as it is judged.
    """
    bands = bands or CompressionBands()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for found in judge_texts(batch.column(1), bands):
                n = len(found["n_words"])
                columns = [batch.column(0).slice(done, n), *map(pa.array, found.values())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *found])
                done += n

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(judge, SCHEMA)


def passing(docs: DataFrame, bands: CompressionBands | None = None) -> DataFrame:
    """The rows of ``docs`` that keep to the rules, all columns unchanged and nothing shuffled.

    The verdict is formed next to the row itself, so ids need not be unique.
    """
    bands = bands or CompressionBands()
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [found["kept"] for found in judge_texts(batch.column(at), bands)]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(keep, docs.schema)
