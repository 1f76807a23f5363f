"""Benchmark decontamination: rare n-gram seeds find passages, Smith-Waterman alignment scores them.

Words are compared in lower case, without punctuation at either end, so that re-punctuated copies still align. Each
benchmark item is cut into stretches of its n-grams. The n-grams that are rare in the corpus are seeds, and in each
stretch at least those that it holds least often; the others never lead anywhere. A seed in a document gives a passage as long as the item allows; passages of
one document and item that overlap are one. Passages with too few words of the item to count under any alignment are
passed over, the others are aligned with the item word by word: gaps and replaced words cost, and the matched share of
the item decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import IS_SPACE, Texts, Words, _ranges, range_hashes, sequence_hash, text_groups

SEED_WORDS = 3
STRETCH = 6
SEEDS_PER_STRETCH = 3
# An n-gram is rare in up to this share of the documents, and in up to this number of them.
RARE_SHARE = 0.01
RARE_DOCS = 16
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SHARE = 0.5
LONG_PASSAGE_WORDS = 30
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 8_000_000
PAIR_CELLS = 1 << 22
# Hits that a task looks at in one go.
HITS = 1 << 19

PAIRS = "doc_id bigint, item_id bigint, score double, matched_words int, item_words int, first_word bigint, n_words int"
_EDGE = np.zeros(256, bool)
_EDGE[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def folded_groups(column: pa.Array) -> Iterator[Texts]:
    """Runs of texts of a column in lower case, letters beyond ASCII too."""
    return text_groups(pc.utf8_lower(column))


def bare_words(texts: Texts) -> Words:
    """Words without ASCII punctuation at their ends; words of punctuation alone are left out."""
    start, end = _ranges(~IS_SPACE[texts.data], texts.bounds)
    plain = np.concatenate([~_EDGE[texts.data], [True]])
    n = len(texts.data)
    # The nearest byte that isn't punctuation, at or after each place and at or before it.
    places = np.where(plain, np.arange(n + 1), n)
    following = np.minimum.accumulate(places[::-1])[::-1]
    preceding = np.maximum.accumulate(np.where(plain[:n], np.arange(n), -1)) if n else np.zeros(0, np.int64)
    start, end = following[start], preceding[end - 1] + 1 if n else end
    whole = start < end
    start, end = start[whole], end[whole]
    text = np.searchsorted(texts.bounds, start, "right") - 1
    hashes = range_hashes(texts.data, start, end)
    return Words(hashes, text, start, end, np.bincount(text, minlength=len(texts)))


@dataclass
class Items:
    """A block of benchmark items: their words end to end, and their n-grams with the item and place of each."""

    ids: np.ndarray
    words: np.ndarray
    bounds: np.ndarray
    grams: np.ndarray
    gram_item: np.ndarray
    gram_place: np.ndarray

    @staticmethod
    def of(ids: list[int], column: pa.Array) -> Items:
        parts, bounds = [np.zeros(0, np.uint64)], [0]
        for texts in folded_groups(column):
            words = bare_words(texts)
            parts.append(words.hash)
            bounds += (bounds[-1] + np.cumsum(words.per_text)).tolist()
        words, bounds = np.concatenate(parts), np.array(bounds)
        item = np.repeat(np.arange(len(ids)), np.diff(bounds))
        grams, places = grams_of(words, item)
        return Items(np.array(ids, np.int64), words, bounds, grams, item[places], places - bounds[item[places]])


def grams_of(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``SEED_WORDS`` words inside a text and its first word; a shorter text has none."""
    n = len(words) - SEED_WORDS + 1
    first = np.flatnonzero(text[:n] == text[SEED_WORDS - 1 :]) if n > 0 else np.zeros(0, np.int64)
    hashes = sequence_hash([words[first + k] for k in range(SEED_WORDS)])
    return hashes, first


class Lookup:
    """Which of a fixed set of hashes each hash is: a bit table rules out nearly all before the search."""

    def __init__(self, known: np.ndarray):
        self.known = np.unique(known)
        self.bits = max(16, min(24, math.ceil(math.log2(len(self.known) + 1)) + 6))
        self.table = np.zeros(1 << self.bits, bool)
        self.table[(self.known >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that are known, and their number among the known."""
        place = np.flatnonzero(self.table[(hashes >> np.uint64(64 - self.bits)).astype(np.int64)])
        at = np.searchsorted(self.known, hashes[place])
        at[at == len(self.known)] = 0
        hit = self.known[at] == hashes[place] if len(self.known) else np.zeros(len(place), bool)
        return place[hit], at[hit]


def gram_frequencies(docs: DataFrame, grams: np.ndarray) -> tuple[dict[int, int], int]:
    """In how many rows of ``docs(text)`` each n-gram of the items occurs, and the number of rows.

    One row per n-gram reaches the driver.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.unique(grams))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value)
        total, n_rows = np.zeros(len(lookup.known), np.int64), 0
        for batch in batches:
            n_rows += batch.num_rows
            for texts in folded_groups(batch.column(0)):
                words = bare_words(texts)
                hashes, first = grams_of(words.hash, words.text)
                place, number = lookup.find(hashes)
                pairs = np.unique(words.text[first[place]] * len(total) + number)
                total += np.bincount(pairs % max(len(total), 1), minlength=len(total))
        used = np.flatnonzero(total)
        # The row without an n-gram counts all rows.
        found = [*lookup.known[used].view(np.int64).tolist(), None], [*total[used].tolist(), n_rows]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["gram", "n"])

    counts = docs.select(F.col("text").cast("string")).mapInArrow(count, "gram bigint, n bigint")
    rows = counts.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(rows.column("gram").to_pylist(), rows.column("n").to_pylist()))
    n_rows = found.pop(None, 0)
    return {gram % (1 << 64): n for gram, n in found.items()}, n_rows


def choose_seeds(items: Items, frequency: dict[int, int], rare: float = 0) -> np.ndarray:
    """Numbers of the n-grams of the items that are seeds: of each stretch those up to a bound on their frequency.

    The bound is ``rare``, or the frequency of the ``SEEDS_PER_STRETCH``-th rarest n-gram of the stretch if that is
    more (of those that reach it just then, the first count). N-grams that no document holds can't point at anything
    and are left out.
    """
    n = np.array([frequency.get(g, 0) for g in items.grams.tolist()], np.int64)
    held = np.flatnonzero(n)
    stretch = items.gram_item[held].astype(np.int64) << 32 | items.gram_place[held] // STRETCH
    order = np.lexsort((items.gram_place[held], n[held], stretch))
    held, stretch = held[order], stretch[order]
    first = np.flatnonzero(np.r_[True, stretch[1:] != stretch[:-1]]) if len(held) else np.zeros(0, np.int64)
    rank = np.arange(len(held)) - np.repeat(first, np.diff(np.r_[first, len(held)]))
    return np.sort(held[(rank < SEEDS_PER_STRETCH) | (n[held] <= rare)])


def align(item: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignments of many equally long pairs of word sequences at once (rows; 0 pads and matches nothing).

    Returns the score, the matched words, and the first and last word of the passage in the alignment. Matches and the
    start are carried along with the score of each cell, in one integer that keeps the order of scores.
    """
    rows, width = passage.shape
    # score in the high bits, then matched words, then the start counted down from the end (later start is better).
    shift = np.int64(1 << 40)
    unit = np.int64(1 << 20)
    columns = np.arange(width, dtype=np.int64)
    fresh = width - columns  # a start at this column, if nothing was aligned before
    best = np.zeros(rows, np.int64)
    best_end = np.zeros(rows, np.int64)
    above = np.zeros((rows, width), np.int64)
    gap = GAP * shift
    for i in range(item.shape[1]):
        same = (item[:, i : i + 1] == passage) & (item[:, i : i + 1] != 0)
        before = np.zeros_like(above)
        before[:, 1:] = above[:, :-1]
        start = np.where(before >= shift, before, fresh)
        cell = np.where(same, start + MATCH * shift + unit, before + MISMATCH * shift)
        cell = np.maximum(cell, above + gap)
        # Gaps along the passage: the best cell to the left, less the distance.
        cell = np.maximum.accumulate(cell - gap * columns, axis=1) + gap * columns
        cell[cell < shift] = 0
        top = cell.argmax(axis=1)
        value = cell[np.arange(rows), top]
        better = value > best
        best[better], best_end[better] = value[better], top[better]
        above = cell
    score, rest = best // shift, best % shift
    return score, rest // unit, width - rest % unit, best_end


@dataclass
class Seeds:
    """The seeds of a block of items by ascending hash, and for each hash the items and places that have it."""

    grams: np.ndarray
    bounds: np.ndarray
    item: np.ndarray
    place: np.ndarray

    @staticmethod
    def of(items: Items, chosen: np.ndarray) -> Seeds:
        chosen = chosen[np.argsort(items.grams[chosen], kind="stable")]
        grams, counts = np.unique(items.grams[chosen], return_counts=True)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return Seeds(grams, bounds, items.gram_item[chosen], items.gram_place[chosen])


def _each(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + count - 1`` of each pair, end to end."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


class _Places:
    """Where each word of a run of texts stands, for asking whether a passage holds it."""

    def __init__(self, words: np.ndarray):
        self.known, self.rank = np.unique(words, return_inverse=True)
        self.at = np.sort(self.rank.astype(np.int64) << 32 | np.arange(len(words)))

    def rank_of(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash among the different words, -1 for those that no text holds."""
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at, -1)

    def stands_in(self, rank: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the word of each rank stands in ``low .. high - 1``."""
        at = np.searchsorted(self.at, rank << 32 | low)
        return self.at[np.minimum(at, len(self.at) - 1)] - (rank << 32 | low) < high - low if len(at) else at > 0


def needed_words(length: np.ndarray, min_share: float) -> np.ndarray:
    """With fewer words of an item of a given length than this, no alignment with it counts."""
    return np.minimum(np.ceil(min_share * length - 1e-9).astype(np.int64), LONG_PASSAGE_WORDS)


def passages(words: Words, items: Items, seeds: Seeds, lookup: Lookup, min_share: float) -> Iterator[tuple[np.ndarray, ...]]:
    """Where seeds point and enough words of the item stand: arrays of text, item, first word and end of each passage.

    The hits are taken item by item, about ``HITS`` at a time, so memory doesn't grow with hits in common.
    """
    hashes, first = grams_of(words.hash, words.text)
    at, number = lookup.find(hashes)
    if not len(at):
        return
    order = np.argsort(number, kind="stable")
    found, occurs, n_occurs = np.unique(number[order], return_index=True, return_counts=True)
    word_of_hit = first[at[order]]
    # The seeds of items that are in these texts, and how often each occurs; then items in turn.
    per_gram = seeds.bounds[found + 1] - seeds.bounds[found]
    entry = _each(seeds.bounds[found], per_gram)
    gram = np.repeat(np.arange(len(found)), per_gram)
    by_item = np.argsort(seeds.item[entry], kind="stable")
    entry, gram = entry[by_item], gram[by_item]

    # Words of the items that these texts hold at all; items with too few of them can't count.
    places = _Places(words.hash)
    lengths = np.diff(items.bounds)
    hit_items, of_item = np.unique(seeds.item[entry], return_inverse=True)
    which = _each(items.bounds[hit_items], lengths[hit_items])
    rank = places.rank_of(items.words[which])
    owner = np.repeat(np.arange(len(hit_items)), lengths[hit_items])[rank >= 0]
    rank = rank[rank >= 0]
    n_held = np.bincount(owner, minlength=len(hit_items))
    rank_start = np.cumsum(n_held) - n_held
    needed = needed_words(lengths[hit_items], min_share)
    fits = (n_held >= needed)[of_item]
    entry, gram, of_item = entry[fits], gram[fits], of_item[fits]

    text_start = np.cumsum(words.per_text) - words.per_text
    text_end = text_start + words.per_text
    turns = np.flatnonzero(np.r_[True, of_item[1:] != of_item[:-1], True]) if len(entry) else np.zeros(1, np.int64)
    hits_before = np.concatenate([[0], np.cumsum(n_occurs[gram])])[turns]
    start = 0
    while start < len(turns) - 1:
        end = max(start + 1, int(np.searchsorted(hits_before, hits_before[start] + HITS, "right")) - 1)
        some = slice(turns[start], turns[end])
        start = end
        count = n_occurs[gram[some]]
        word = word_of_hit[_each(occurs[gram[some]], count)]
        place, mine = np.repeat(seeds.place[entry[some]], count), np.repeat(of_item[some], count)
        length, text = lengths[hit_items[mine]], words.text[word]
        # The item laid over the document, with a third of it (and four words) to spare on either side for insertions.
        spare = length // 3 + 4
        low = np.maximum(word - place - spare, text_start[text])
        high = np.minimum(word - place + length + spare, text_end[text])
        order = np.lexsort((low, text, mine))
        low, high, text, mine, span = (x[order] for x in (low, high, text, mine, length + 2 * spare))
        # Passages that overlap become one; a long run of them is cut where it has the length of a passage.
        apart = np.r_[True, (mine[1:] != mine[:-1]) | (text[1:] != text[:-1]) | (low[1:] > high[:-1])]
        runs = np.flatnonzero(apart)
        part = (low - np.repeat(low[runs], np.diff(np.r_[runs, len(low)]))) // span
        begin = np.flatnonzero(apart | np.r_[True, part[1:] != part[:-1]])
        low, high, text, mine = low[begin], np.maximum.reduceat(high, begin), text[begin], mine[begin]
        # Of those, the ones that hold enough words of the item.
        for few in _slices(n_held[mine], HITS):
            n = n_held[mine[few]]
            stands = places.stands_in(rank[_each(rank_start[mine[few]], n)], np.repeat(low[few], n), np.repeat(high[few], n))
            enough = np.bincount(np.repeat(np.arange(len(n)), n), stands, len(n)) >= needed[mine[few]]
            if enough.any():
                yield text[few][enough], hit_items[mine[few]][enough], low[few][enough], high[few][enough]


def _slices(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Ranges of a list whose sizes add up to about ``limit``, or of one alone."""
    before = np.concatenate([[0], np.cumsum(sizes)])
    start = 0
    while start < len(sizes):
        end = max(start + 1, int(np.searchsorted(before, before[start] + limit, "right")) - 1)
        yield slice(start, end)
        start = end


def aligned_pairs(words: Words, items: Items, seeds: Seeds, lookup: Lookup, min_share: float) -> Iterator[tuple]:
    """Align each passage that can count; yields text, item, score, matched words, and where."""
    text_start = np.cumsum(words.per_text) - words.per_text
    lengths = np.diff(items.bounds)
    for text, item, low, high in passages(words, items, seeds, lookup, min_share):
        sizes = np.stack([lengths[item], high - low], axis=1)
        for some in _batches(np.argsort(sizes[:, 0] * sizes[:, 1], kind="stable"), sizes):
            n, width = sizes[some, 0], sizes[some, 1]
            left, right = (np.zeros((len(some), size.max()), np.uint64) for size in (n, width))
            left[np.arange(left.shape[1]) < n[:, None]] = items.words[_each(items.bounds[item[some]], n)]
            right[np.arange(right.shape[1]) < width[:, None]] = words.hash[_each(low[some], width)]
            score, matched, begin, end = align(left, right)
            first = low[some] + begin - text_start[text[some]]
            yield from zip(*(x.tolist() for x in (text[some], item[some], score, matched, first, end - begin + 1)))


def _counts(score: int, full: int, min_share: float) -> bool:
    return score >= min_share * full or score >= MATCH * LONG_PASSAGE_WORDS


def len_of(items: Items, item: int) -> int:
    return int(items.bounds[item + 1] - items.bounds[item])


def _batches(order: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Cut an order of pairs, shortest first, into batches whose padded tables stay within ``PAIR_CELLS``."""
    start = 0
    while start < len(order):
        end, longest = start, 0
        while end < len(order):
            longest = max(longest, int(sizes[order[end], 1]))
            if end > start and (end - start + 1) * longest > PAIR_CELLS // 16:
                break
            end += 1
        yield order[start:end]
        start = end


def contaminated(docs: DataFrame, items: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per document and benchmark item of which it holds a copy, exact or edited.

    ``docs(doc_id, text, ...)``, ``items(item_id, text, ...)``; ``score`` is the alignment score as a share of that of
    a full copy. A pair counts from ``min_share`` on, or when the alignment is worth ``LONG_PASSAGE_WORDS`` matches.
    Documents without a match have no row. The items are the query set: they are taken in blocks of bounded size, each
    block against all documents in two passes (frequencies, passages), so nothing of the corpus is shuffled. A copy is
    found if one of its item's seeds is left in it; one that keeps no three words in a row has none. Null and empty
    texts match nothing, items of fewer words than a seed neither. Texts may have any length, a task holds one at a
    time; other columns are ignored, whatever their names. Items with a null id are left out as they
    can't be named; documents with a null id are reported with it. Rows that share an id give one row per item, the
    best. Empty tables give no rows.
    """
    found = None
    for block in _item_blocks(items):
        pairs = _block_pairs(docs, block, min_share)
        found = pairs if found is None else found.unionAll(pairs)
    if found is None:
        return docs.sparkSession.createDataFrame([], PAIRS)
    fields = ["score", "matched_words", "item_words", "first_word", "n_words"]
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct(*fields)).alias("best"))
    return best.select("doc_id", "item_id", *[f"best.{c}" for c in fields])


def _item_blocks(items: DataFrame) -> Iterator[Items]:
    """The items in blocks of at most ``BLOCK_ITEMS`` rows and, unless one alone is longer, ``BLOCK_CHARS`` characters."""
    items = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).dropna().distinct()
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    n_blocks = max(1, math.ceil(2 * size["n"] / BLOCK_ITEMS), math.ceil(2 * size["chars"] / BLOCK_CHARS))
    numbered = items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    for k in range(n_blocks if size["n"] else 0):
        rows = numbered.filter(F.col("_block") == k).orderBy("item_id", "text").toArrow()
        if rows.num_rows:
            yield Items.of(rows.column("item_id").to_pylist(), rows.column("text").combine_chunks())


def _block_pairs(docs: DataFrame, items: Items, min_share: float) -> DataFrame:
    frequency, n_docs = gram_frequencies(docs, items.grams)
    chosen = choose_seeds(items, frequency, max(RARE_DOCS, RARE_SHARE * n_docs))
    shared = docs.sparkSession.sparkContext.broadcast((items, Seeds.of(items, chosen)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, seeds = shared.value
        lookup = Lookup(seeds.grams)
        names = [part.split()[0] for part in PAIRS.split(", ")]
        types = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
        for batch in batches:
            rows = []
            for texts in folded_groups(batch.column(1)):
                words = bare_words(texts)
                for text, item, score, matched, first, n in aligned_pairs(words, items, seeds, lookup, min_share):
                    full = MATCH * len_of(items, item)
                    if _counts(score, full, min_share):
                        doc_id = batch.column(0)[texts.first + text].as_py()
                        n_item = len_of(items, item)
                        rows.append((doc_id, int(items.ids[item]), score / full, matched, n_item, first, n))
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(find, PAIRS)
