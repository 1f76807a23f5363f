"""Quality classifier: a generalised additive model with pairwise interactions, boosted feature by feature.

Every term of the model is a lookup table over bins of one feature, or over a grid of bins of two. Boosting goes round
the terms and adds a shallow tree to one table at a time, with a small step. A score is the sum of one table entry per
term, so that scoring is indexing and adding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .quality_rules import SYMBOLS, duplicate_lines, repeated_words
from .words import IS_SPACE, Texts, find_words, keyed, text_groups

MAX_TRAINING_ROWS = 20_000
THRESHOLD = 0.7
FEATURES = (
    "log_words", "word_length", "word_length_spread", "long_words", "short_words", "words_per_line", "upper", "digits",
    "symbols", "sentence_marks", "other_marks", "wide", "spaces", "capitalised", "marked_words", "wordless",
    "shouting", "same_as_next", "distinct_words", "top_word", "duplicate_lines", "repeated_words", "byte_entropy",
    "compression", "alternating_symbols",
)


def _mask(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


_UPPER = _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _mask("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _mask("0123456789")
_SYMBOL = _mask(SYMBOLS)
_SENTENCE = _mask(".,;:")
_OTHER = _mask("!?\"'()[]{}-_/\\=+@^~`")
_WIDE = np.arange(256) >= 0x80
_LETTER = _UPPER | _LOWER | _WIDE


def text_features(texts: Texts) -> np.ndarray:
    """One row of :data:`FEATURES` per text, from the whole text; zeros for an empty one."""
    n, data = len(texts), texts.data
    words = find_words(texts)
    n_bytes = np.maximum(np.diff(texts.bounds), 1)
    n_words = words.per_text
    some_words = np.maximum(n_words, 1)
    length = words.end - words.start

    def share(mask: np.ndarray) -> np.ndarray:
        return texts.count(mask[data]) / n_bytes

    def of_words(chosen: np.ndarray) -> np.ndarray:
        return np.bincount(words.text[chosen], minlength=n) / some_words

    def inside(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(mask[data], out=sums[1:])
        return sums[words.end] - sums[words.start]

    mean = np.bincount(words.text, length, n) / some_words
    spread = np.sqrt(np.maximum(np.bincount(words.text, length.astype(float) ** 2, n) / some_words - mean**2, 0))
    letters, upper, symbols = inside(_LETTER), inside(_UPPER), inside(_SYMBOL)
    same = np.zeros(len(words.hash), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.text[1:] == words.text[:-1])
    _, first, counts = np.unique(keyed(words.hash, words.text), return_index=True, return_counts=True)
    distinct = np.bincount(words.text[first], minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, words.text[first], counts)
    zstd = zstandard.ZstdCompressor(level=1, write_content_size=False)
    entropy, ratio = np.zeros(n), np.zeros(n)
    for i in range(n):
        text = data[texts.bounds[i] : texts.bounds[i + 1]]
        if len(text):
            p = np.bincount(text, minlength=256) / len(text)
            p = p[p > 0]
            entropy[i] = -(p * np.log2(p)).sum()
            ratio[i] = len(text) / len(zstd.compress(text.data))
    lines = texts.count(data == 0x0A) + 1
    columns = [
        np.log1p(n_words), mean, spread, of_words(length >= 16), of_words(length <= 3), n_words / lines,
        share(_UPPER), share(_DIGIT), share(_SYMBOL), share(_SENTENCE), share(_OTHER), share(_WIDE),
        texts.count(IS_SPACE[data]) / n_bytes, of_words(_UPPER[data[words.start]] if len(data) else same),
        of_words(symbols > 0), of_words(letters == 0), of_words((upper == letters) & (letters > 1)), of_words(same),
        distinct / some_words, top / some_words, duplicate_lines(texts, words.start) / lines,
        repeated_words(words, n) / some_words, entropy, ratio, of_words((symbols > 0) & (letters == 0)),
    ]
    return np.stack(columns, axis=1)


@dataclass(frozen=True)
class Settings:
    bins: int = 64
    pair_bins: int = 12
    pairs: int = 10
    rounds: int = 120
    pair_rounds: int = 60
    leaves: int = 3
    rate: float = 0.1
    ridge: float = 5.0


@dataclass
class AdditiveModel:
    """Cut points per feature, one table per feature, and grids for some pairs of features."""

    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, j], "right")]
        coarse = {j: np.searchsorted(self.pair_cuts[j], x[:, j], "right") for p in self.pairs for j in p[:2]}
        for i, j, grid in self.pairs:
            total += grid[coarse[i], coarse[j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(gradient: np.ndarray, hessian: np.ndarray, ridge: float) -> np.ndarray:
    return gradient / (hessian + ridge)


def _gain(gradient: np.ndarray, hessian: np.ndarray, ridge: float) -> np.ndarray:
    return gradient**2 / (hessian + ridge)


def _shallow_tree(gradient: np.ndarray, hessian: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Step function over bins with at most ``leaves`` levels: the best split of any leaf, until none is left."""
    spans = [(0, len(gradient))]
    while len(spans) < leaves:
        best = (1e-9, 0, 0)
        for k, (a, b) in enumerate(spans):
            if b - a < 2:
                continue
            g, h = np.cumsum(gradient[a:b]), np.cumsum(hessian[a:b])
            gains = _gain(g[:-1], h[:-1], ridge) + _gain(g[-1] - g[:-1], h[-1] - h[:-1], ridge)
            at = int(gains.argmax())
            best = max(best, (float(gains[at] - _gain(g[-1], h[-1], ridge)), k, a + at + 1))
        if best[0] <= 1e-9:
            break
        _, k, cut = best
        a, b = spans[k]
        spans[k : k + 1] = [(a, cut), (cut, b)]
    step = np.zeros(len(gradient))
    for a, b in spans:
        step[a:b] = _leaf(gradient[a:b].sum(), hessian[a:b].sum(), ridge)
    return step


def _quadrants(gradient: np.ndarray, hessian: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best cross of one cut per axis of a grid: its gain and the step it gives to each cell."""
    g, h = (np.cumsum(np.cumsum(x, 0), 1) for x in (gradient, hessian))

    def four(s: np.ndarray) -> list[np.ndarray]:
        a, row, column, total = s[:-1, :-1], s[:-1, -1:], s[-1:, :-1], s[-1, -1]
        return [a, row - a, column - a, total - row - column + a]

    parts = list(zip(four(g), four(h)))
    gains = sum(_gain(a, b, ridge) for a, b in parts) - _gain(g[-1, -1], h[-1, -1], ridge)
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    step = np.empty(gradient.shape)
    rows, columns = (slice(None, i + 1), slice(i + 1, None)), (slice(None, j + 1), slice(j + 1, None))
    for k, (a, b) in enumerate(parts):
        step[rows[k // 2], columns[k % 2]] = _leaf(a[i, j], b[i, j], ridge)
    return float(gains[i, j]), step


def fit(x: np.ndarray, y: np.ndarray, settings: Settings = Settings()) -> AdditiveModel:
    """Fit to rows ``x`` with labels ``y`` in 0 and 1. With one label only, the model is that label for every row."""
    if not len(y):
        return AdditiveModel(np.inf)
    if y.min() == y.max():
        return AdditiveModel(np.inf if y[0] else -np.inf)
    model = AdditiveModel(float(np.log(y.mean() / (1 - y.mean()))))
    model.cuts = [_cut_points(x[:, j], settings.bins) for j in range(x.shape[1])]
    model.pair_cuts = [_cut_points(x[:, j], settings.pair_bins) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.cuts)]
    margin = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(settings.rounds):
        for j, table in enumerate(model.tables):
            residual, weight = slopes()
            step = _shallow_tree(
                np.bincount(bins[j], residual, len(table)), np.bincount(bins[j], weight, len(table)),
                settings.leaves, settings.ridge,
            )
            table += settings.rate * step
            margin += settings.rate * step[bins[j]]
    coarse = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.pair_cuts)]
    shape = [len(c) + 1 for c in model.pair_cuts]

    def on_grid(i: int, j: int) -> tuple[float, np.ndarray, np.ndarray]:
        residual, weight = slopes()
        cell = coarse[i] * shape[j] + coarse[j]
        g, h = (np.bincount(cell, v, shape[i] * shape[j]).reshape(shape[i], shape[j]) for v in (residual, weight))
        return *_quadrants(g, h, settings.ridge), cell

    usable = [j for j in range(x.shape[1]) if shape[j] > 1]
    strength = sorted(((on_grid(i, j)[0], i, j) for i, j in combinations(usable, 2)), reverse=True)
    model.pairs = [(i, j, np.zeros((shape[i], shape[j]))) for _, i, j in strength[: settings.pairs]]
    for _ in range(settings.pair_rounds):
        for i, j, grid in model.pairs:
            _, step, cell = on_grid(i, j)
            grid += settings.rate * step
            margin += settings.rate * step.ravel()[cell]
    return model


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the features of every row as an array."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in text_groups(batch.column(1)):
                x = text_features(texts)
                offsets = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(x)), lists], ["doc_id", "x"])
                done += len(x)

    ids = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return ids.mapInArrow(extract, "doc_id bigint, x array<double>")


def train(found: DataFrame, labels: DataFrame, held_out: Column, max_rows: int = MAX_TRAINING_ROWS) -> AdditiveModel:
    """Fit on at most ``max_rows`` labelled rows outside ``held_out``, those with the smallest hash of their id.

    Only this bounded sample reaches the driver. Of several labels of one id the lowest counts, null ones never.
    """
    labels = labels.filter("quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    labels = labels.agg(F.min("quality").cast("int").alias("y"))
    rows = found.filter(~held_out).join(labels, "doc_id").withColumn("_order", F.xxhash64("doc_id"))
    rows = rows.orderBy("_order", "doc_id", "x").limit(max_rows).select("x", "y").toArrow()
    if not rows.num_rows:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
    return fit(x, rows.column("y").to_numpy().astype(float))


def apply_model(found: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` for every row of :func:`features`."""
    shared = found.sparkSession.sparkContext.broadcast(model)  # a few tables, their size fixed by the settings

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            scores = shared.value.score(x)
            columns = [batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    return found.select("doc_id", "x").mapInArrow(score, "doc_id bigint, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text, ...)``.

    ``held_out`` is a condition on ``doc_id`` alone; rows it holds for are scored but never learnt from. Features are
    computed once and stored. Null and empty texts are scored like any other, with features of zero; null ids have no
    label. Repeated rows get one score each. Without labelled rows every score is 1, with one label only it is that
    label. An empty table gives no rows.
    """
    found = stage(features(docs), "features")
    scored = apply_model(found, train(found, labels, held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")
