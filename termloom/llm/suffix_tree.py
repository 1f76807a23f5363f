"""Language-model scoring by a probabilistic suffix tree over words, with a one-word baseline.

A text is its lower-case words and one end token. The symbols of the tree are the words that make up at least
``HEAD_SHARE`` and ``MIN_SHARE`` of the training tokens, the end, and one symbol for all other words, which shares its
probability among them as the baseline does. Contexts are sequences of up to ``DEPTH`` symbols, the start of a text
counting as an end. A context is a candidate if it makes up ``MIN_SHARE`` as well. A candidate is retained if its
next-symbol counts diverge from the distribution of its longest retained suffix by more (in log-likelihood) than it has
entries. Entries are the next symbols that make up at least ``ENTRY_SHARE`` with the context; all others keep the
proportions of the suffix. Each token is scored in the state of the longest retained suffix of what stands before it.
With all shares at 0 every word that was learnt is a symbol, and everything that occurs is a candidate and an entry.

The tree grows with the corpus and is nowhere whole. Tokens are dealt by the newest symbols before them, so that all
that one part of the tree is learnt from, and all that is scored by it, meets in one bucket. Contexts that occur too
often for a bucket are dealt by one symbol more; their own entries are counted over all tasks and join the buckets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffles_freed, stage
from .token_blocks import RUN_TOKENS, Block, WordCounts, blocks_of, lists_of, number_tokens, packed, unpacked
from .words import mix

DEPTH = 4
MIN_SHARE = 0.0
ENTRY_SHARE = 0.0
HEAD_SHARE = 0.0
PRIOR = 50.0
FLUSH_KEYS = 1_000_000
# Tokens of a bucket, and buckets that are dealt together. A context that occurs twice as often is dealt apart.
BUCKET_TOKENS, GROUP_BUCKETS = 1 << 17, 8

SCORED = "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base_score double"
DEALT = "group bigint, block bigint, n bigint, tokens binary"
COUNTED = "context bigint, part bigint, size bigint, entries binary"
SUMMED = "context bigint, size bigint, entries binary, longer array<bigint>, longer_n array<bigint>"
GAINED = "block bigint, size bigint, texts binary, gains binary"
SYMBOL = (1 << 32) - 1


def count_keys(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum counts of equal keys."""
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def counted(blocks: DataFrame, keys_of: Callable[[Block], np.ndarray], parts: np.ndarray, many: int) -> DataFrame:
    """``SUMMED``: of each context how often its keys occur, over all tasks, in ``parts[context]`` rows.

    ``keys_of(block)`` gives them as ``context << 33 | longer << 32 | symbol``. Each task sums what it has seen and hands
    it on whenever it holds ``FLUSH_KEYS`` different keys. Entries are listed whole, longer contexts from ``many`` on.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def handed_on() -> pa.RecordBatch:
            keys, n = count_keys(held)
            context = keys >> 33
            part = (keys & SYMBOL) % parts[context]
            order = np.lexsort((part, context))
            keys, n, context, part = keys[order], n[order], context[order], part[order]
            starts = np.flatnonzero((np.diff(context, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
            ends = np.append(starts[1:], len(keys))
            columns = [(keys >> 32) & 1, keys & SYMBOL, n]
            packs = [packed(np.concatenate([c[i:j] for c in columns])) for i, j in zip(starts, ends)]
            rows = [context[starts], part[starts], ends - starts, packs]
            return pa.RecordBatch.from_arrays([pa.array(r) for r in rows], [f.split()[0] for f in COUNTED.split(", ")])

        for run in (run for batch in batches for block in blocks_of(batch) for run in block.runs()):
            held.append(np.unique(keys_of(run), return_counts=True))
            if sum(len(k) for k, _ in held) > FLUSH_KEYS:
                held[:] = [count_keys(held)]
                if len(held[0][0]) > FLUSH_KEYS // 2:
                    yield handed_on()
                    held.clear()
        if sum(len(k) for k, _ in held):
            yield handed_on()

    def add_up(rows: pa.Table) -> pa.Table:
        found = [unpacked(p, 3 * n).reshape(3, n).astype(np.int64) for n, p in zip(*(rows.column(c).to_pylist() for c in ("size", "entries")))]
        keys, n = count_keys([((longer << 32) | symbol, n) for longer, symbol, n in found])
        entry, longer = keys >> 32 == 0, (keys >> 32 == 1) & (keys & SYMBOL > 0) & (n >= many)
        columns = [
            rows.column("context").slice(0, 1).combine_chunks(),
            pa.array([int(entry.sum())]),
            pa.array([packed(np.concatenate([keys[entry], n[entry]]))]),
            lists_of([keys[longer] & SYMBOL]),
            lists_of([n[longer]]),
        ]
        return pa.Table.from_arrays(columns, [f.split()[0] for f in SUMMED.split(", ")])

    return blocks.mapInArrow(count, COUNTED).groupBy("context", "part").applyInArrow(add_up, SUMMED)


@dataclass
class Vocabulary:
    """Ascending numbers of words with their counts, and the symbol of each (``n_symbols`` - 1: all others).

    ``p_other`` is the probability of all others, where these words are not all symbols there are.
    """

    words: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    n_symbols: int
    end: int
    n_tokens: int
    n_words: int
    p_other: float | None = None

    @property
    def other(self) -> int:
        return self.n_symbols - 1

    def root(self) -> np.ndarray:
        """Probability of each symbol without context: the baseline, what it leaves for the other words at the end."""
        p = np.zeros(self.n_symbols)
        is_symbol = self.symbols < self.other
        p[self.symbols[is_symbol]] = (self.counts[is_symbol] + 1) / (self.n_tokens + self.n_words + 1)
        p[self.other] = 1 - p[:-1].sum() if self.p_other is None else self.p_other
        return p


@dataclass
class Level:
    """Retained contexts of one length: their codes, the weight of what isn't an entry, and entries by code and symbol."""

    contexts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rest: np.ndarray = field(default_factory=lambda: np.zeros(0))
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    logs: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _match(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return at, sorted_keys[at] == keys


@dataclass
class SuffixTree:
    """The tree: log10 probabilities of the symbols without context, and the retained contexts by length.

    A context of one symbol has that symbol for its code; ``parent`` has the code of each candidate context without its
    oldest symbol.
    """

    n_symbols: int
    root: np.ndarray
    levels: list[Level] = field(default_factory=list)
    parent: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.parent = np.zeros(self.n_symbols, np.int64)

    def lengthen(self, keys: np.ndarray) -> int:
        """Add candidates: the code of the context without its oldest symbol, and that symbol. Returns the first code."""
        first = len(self.parent)
        self.parent = np.concatenate([self.parent, keys // self.n_symbols])
        return first

    def logs(self, code: np.ndarray, depth: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol after the context with the given code and length."""
        runs = [slice(i, i + RUN_TOKENS) for i in range(0, len(symbol), RUN_TOKENS)]
        return np.concatenate([np.zeros(0), *(self._logs(code[r], depth[r], symbol[r]) for r in runs)])

    def _logs(self, code: np.ndarray, depth: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        out, code = np.zeros(len(symbol)), code.copy()
        open_ = np.arange(len(symbol))
        for length in range(len(self.levels), 0, -1):
            level = self.levels[length - 1]
            some = open_[depth[open_] >= length]
            at, known = _match(level.contexts, code[some])
            here, at = some[known], at[known]
            entry, is_entry = _match(level.keys, level.contexts[at] * self.n_symbols + symbol[here])
            out[here[is_entry]] += level.logs[entry[is_entry]]
            out[here[~is_entry]] += level.rest[at[~is_entry]]
            code[some] = self.parent[code[some]]
            done = np.zeros(len(symbol), bool)
            done[here[is_entry]] = True
            open_ = open_[~done[open_]]
        out[open_] += self.root[symbol[open_]]
        return out

    def add_level(self, context: np.ndarray, symbol: np.ndarray, n: np.ndarray, contexts: np.ndarray, totals: np.ndarray) -> None:
        """Retain contexts of the next length: entries ``context, symbol, n``, and all contexts with their totals.

        Entries are in order of context and symbol, contexts in order.
        """
        length = len(self.levels) + 1
        n, totals = n.astype(float), totals.astype(float)
        at, _ = _match(contexts, context)
        shorter = np.full(len(context), length - 1, np.int8)
        below = 10 ** self.logs(self.parent[context], shorter, symbol)
        size = len(contexts)
        left = np.maximum(totals - np.bincount(at, n, size), 0)
        pool = np.maximum(1 - np.bincount(at, below, size), 1e-12)
        gain = np.bincount(at, n * np.log(n / totals[at] / below), size)
        used = left > 0
        gain[used] += left[used] * np.log(left[used] / totals[used] / pool[used])
        kept = gain > np.bincount(at, minlength=size)
        rest = np.log10((left / pool + PRIOR) / (totals + PRIOR))
        logs = np.log10((n + PRIOR * below) / (totals[at] + PRIOR))
        entry = kept[at]
        keys = context[entry] * self.n_symbols + symbol[entry]
        self.levels.append(Level(contexts[kept], rest[kept], keys, logs[entry]))


@dataclass
class Shape:
    """What the shares come to for the words learnt; all that bounds the tree."""

    counts: WordCounts
    depth: int
    last_symbol: int
    p_other: float
    least_context: float
    least_entry: float

    @classmethod
    def of(cls, counts: WordCounts) -> Shape:
        n = counts.n_tokens
        last = counts.at_least(max(MIN_SHARE, HEAD_SHARE) * n)
        own = np.diff(np.minimum(counts.last, last), prepend=0)
        taken = int((own * (counts.counts + 1)).sum())
        # The end is a symbol however rare it is among long texts.
        if counts.end > last:
            taken += int(counts.of(np.array([counts.end]))[0]) + 1
        size = n + counts.n_words + 1
        return cls(counts, DEPTH, last, (size - taken) / size, MIN_SHARE * n, ENTRY_SHARE * n)

    def tokens(self, block: Block) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The symbols before each token of a block, newest first, its own, and its text.

        Symbols are numbers of words, 0 for other words. The start of a text is an end, nothing stands before that, and
        neither what is older than another word nor that word is in a context; all of this is 0 as well.
        """
        numbers = block.numbers
        symbol = np.where((numbers <= self.last_symbol) | (numbers == self.counts.end), numbers, 0)
        text = np.repeat(np.arange(len(block.n_tokens)), block.n_tokens)
        place = np.arange(len(numbers)) - np.repeat(np.cumsum(block.n_tokens) - block.n_tokens, block.n_tokens)
        before = []
        for k in range(1, self.depth + 1):
            older = np.zeros_like(symbol)
            older[k:] = symbol[:-k]
            older[place < k] = 0
            older[place == k - 1] = self.counts.end
            if before:
                older[before[-1] == 0] = 0
            before.append(older)
        return before, symbol, text


@dataclass
class Frequent:
    """Contexts that occur too often for a bucket, numbered from short to long: the number of each without its oldest
    symbol (-1: it has one symbol), that symbol, its length, its buckets and the first of these."""

    parent: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    oldest: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    length: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    buckets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    levels: list[tuple[np.ndarray, int]] = field(default_factory=list)
    plain: int = 1

    @property
    def first_bucket(self) -> np.ndarray:
        return self.plain + np.cumsum(self.buckets) - self.buckets

    def add(self, parent: np.ndarray, oldest: np.ndarray, buckets: np.ndarray) -> None:
        keys = (parent + 1 << 32) | oldest
        order = np.argsort(keys)
        self.levels.append((keys[order], len(self.parent)))
        self.length = np.concatenate([self.length, np.full(len(keys), len(self.levels))])
        self.parent, self.oldest, self.buckets = (
            np.concatenate([a, b[order]])
            for a, b in ((self.parent, parent), (self.oldest, oldest), (self.buckets, buckets))
        )

    def find(self, before: list[np.ndarray]) -> np.ndarray:
        """Number of the longest frequent context before each token; -1: none."""
        found = np.full(len(before[0]), -1)
        open_ = np.arange(len(found))
        for (keys, first), older in zip(self.levels, before):
            at, known = _match(keys, (found[open_] + 1 << 32) | older[open_].astype(np.int64))
            open_ = open_[known]
            found[open_] = first + at[known]
        return found

    def chain(self, number: int) -> list[int]:
        """A context and its suffixes, from short to long."""
        return [*self.chain(int(self.parent[number])), number] if number >= 0 else []

    def bucket(self, before: list[np.ndarray]) -> np.ndarray:
        """The bucket of each token: by its newest symbol, or by the symbol before its longest frequent context."""
        bucket = (mix(before[0].astype(np.uint64)) % np.uint64(self.plain)).astype(np.int64)
        if not len(self.parent):
            return bucket
        found = self.find(before)
        some = np.flatnonzero(found >= 0)
        number = found[some]
        # Behind the longest contexts, and where nothing stands before, nothing is left to learn; any bucket will do.
        older = some.astype(np.uint64)
        for k, symbols in enumerate(before[1:], 1):
            here = np.flatnonzero((self.length[number] == k) & (symbols[some] > 0))
            older[here] = symbols[some[here]]
        bucket[some] = self.first_bucket[number] + (mix(older) % self.buckets[number].astype(np.uint64)).astype(np.int64)
        return bucket

    def of_bucket(self, bucket: int) -> list[int]:
        """The frequent contexts that all tokens of a bucket follow, from short to long."""
        if bucket < self.plain:
            return []
        return self.chain(int(np.searchsorted(np.cumsum(self.buckets), bucket - self.plain, "right")))


def frequent_contexts(blocks: DataFrame, shape: Shape, tokens: int) -> tuple[Frequent, DataFrame | None]:
    """The contexts that occur ``2 * BUCKET_TOKENS`` times or more, and the entries of each: ``context, size, entries``.

    They are found from short to long, in a pass over ``blocks`` for each length that has any; there is at most one of
    a length for so many tokens. ``tokens``: of all texts, learnt from or not.
    """
    counts, entries, many = shape.counts, None, 2 * BUCKET_TOKENS
    share = tokens / max(counts.n_tokens, 1) / BUCKET_TOKENS
    frequent = Frequent(plain=max(1, -(-tokens // BUCKET_TOKENS)))
    words = np.arange(1, min(counts.at_least(many), shape.last_symbol) + 1)
    if counts.end > shape.last_symbol and counts.of(np.array([counts.end]))[0] >= many:
        words = np.append(words, counts.end)
    parent, oldest, n = np.full(len(words), -1), words, counts.of(words)
    while len(oldest):
        frequent.add(parent, oldest, np.maximum(np.ceil(n * share), 1).astype(np.int64))
        length = len(frequent.levels)

        def keys_of(block: Block, length: int = length) -> np.ndarray:
            """Entries and longer contexts of the contexts found last."""
            before, symbol, text = shape.tokens(block)
            found = frequent.find(before)
            some = np.flatnonzero(block.learnt[text] & (found >= 0))
            some = some[frequent.length[found[some]] == length]
            keys = [(found[some] << 33) | symbol[some]]
            if length < shape.depth:
                keys.append((found[some] << 33) | (1 << 32) | before[length][some])
            return np.concatenate(keys)

        found = stage(counted(blocks, keys_of, frequent.buckets, many), "frequent-contexts")
        new = found.select("context", "size", "entries")
        entries = entries.unionByName(new) if entries is not None else new
        longer = found.select("context", F.explode(F.arrays_zip("longer", "longer_n")).alias("l")).select("context", "l.*")
        parent, oldest, n = (c.to_numpy() for c in longer.toArrow().columns)
    return frequent, entries


def bucket_gain(
    before: list[np.ndarray], symbol: np.ndarray, learnt: np.ndarray, entries: list[tuple[np.ndarray, np.ndarray]], shape: Shape
) -> np.ndarray:
    """What the tree adds to the log10 probability of each token of a bucket, over the baseline.

    ``entries``, symbols and counts, are those of the contexts that all tokens of the bucket follow, from short to long.
    """
    counts = shape.counts
    own = np.unique(np.concatenate([np.unique(x) for x in (*before, symbol, *(s for s, _ in entries))]))
    own = own[own > 0].astype(np.int64)
    size = len(own) + 1
    words = Vocabulary(
        own, counts.of(own), np.arange(len(own)), size, -1, counts.n_tokens, counts.n_words, shape.p_other
    )

    def symbols_of(numbers: np.ndarray) -> np.ndarray:
        return np.where(numbers > 0, np.searchsorted(own, numbers), words.other).astype(np.int32)

    before, symbol = [symbols_of(b) for b in before], symbols_of(symbol)
    tree = SuffixTree(size, np.log10(words.root()))
    code, length = before[0].astype(np.int64), (before[0] != words.other).astype(np.int8)
    for k in range(1, shape.depth + 1):
        possible = learnt & (length == k)
        if k > len(entries):
            keys, n = np.unique(code[possible] * size + symbol[possible], return_counts=True)
        elif length[0] == k:
            keys, n = code[0] * size + symbols_of(entries[k - 1][0]), entries[k - 1][1]
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
        else:
            keys = n = np.zeros(0, np.int64)
        context, next_symbol = np.divmod(keys, size)
        first = np.flatnonzero(np.diff(context, prepend=-1))
        enough = n >= shape.least_entry
        totals = np.add.reduceat(n, first) if len(first) else n
        tree.add_level(context[enough], next_symbol[enough], n[enough], context[first], totals)
        if k == shape.depth:
            break
        # A context is a candidate by how often a token follows it.
        usable = (length == k) & (before[k] != words.other)
        if k < len(entries):
            many = length[0] == k and entries[k][1].sum() >= shape.least_context
            keys = code[:1] * size + before[k][:1] if many else np.zeros(0, np.int64)
        else:
            keys, n = np.unique((code * size + before[k])[possible & usable], return_counts=True)
            keys = keys[n >= shape.least_context]
        if not len(keys):
            break
        some = np.flatnonzero(usable)
        at, known = _match(keys, code[some] * size + before[k][some])
        code[some[known]] = tree.lengthen(keys) + at[known]
        length[some[known]] = k + 1
    return tree.logs(code, length, symbol) - tree.root[symbol]


def deal_tokens(blocks: DataFrame, shape: Shape, frequent: Frequent) -> DataFrame:
    """A row (``DEALT``) for each block and group of buckets: of each token that has a context the bucket, the symbols
    before it, its own, its text and whether it is learnt from."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in (block for batch in batches for block in blocks_of(batch)):
            parts: list[tuple[np.ndarray, list[np.ndarray]]] = []
            for run in block.runs():
                before, symbol, text = shape.tokens(run)
                bucket = frequent.bucket(before)
                some = np.flatnonzero(before[0] > 0)
                text = (run.first - block.first + text) * 2 + run.learnt[text]
                columns = [bucket % GROUP_BUCKETS, *before, symbol, text]
                parts.append(((bucket[some] << 32) | before[0][some], [c[some].astype(np.uint32) for c in columns]))
            keys = np.concatenate([k for k, _ in parts])
            columns = [np.concatenate(c) for c in zip(*(c for _, c in parts))]
            del parts
            if not len(keys):
                continue
            order = np.argsort(keys)
            group = (keys[order] >> 32) // GROUP_BUCKETS
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            ends = np.append(starts[1:], len(group))
            tokens = [packed(np.concatenate([c[order[i:j]] for c in columns])) for i, j in zip(starts, ends)]
            rows = [group[starts], np.full(len(starts), block.first), ends - starts, tokens]
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], [part.split()[0] for part in DEALT.split(", ")])

    return blocks.mapInArrow(deal, DEALT)


def score_buckets(dealt: DataFrame, entries: DataFrame | None, shape: Shape, frequent: Frequent) -> DataFrame:
    """``row, gain``: what the tree adds to the score of each text that has a context."""
    spark = dealt.sparkSession
    depth, fields = shape.depth, shape.depth + 3

    def score(tokens: pa.Table, entries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))]
        sizes = tokens.column("n").to_numpy()
        columns, at = np.empty((fields, sizes.sum()), np.uint32), 0
        for data, n in zip(tokens.column("tokens"), sizes.tolist()):
            columns[:, at : at + n] = unpacked(data.as_py(), fields * n).reshape(fields, n)
            at += n
        group = tokens.column("group")[0].as_py() if len(sizes) else 0
        first = np.repeat(tokens.column("block").to_numpy(), sizes)
        listed: dict[int, list[np.ndarray]] = {}
        for context, n, data in zip(*(entries.column(c).to_pylist() for c in ("context", "size", "entries"))):
            listed.setdefault(context, []).append(unpacked(data, 2 * n).reshape(2, n))
        for bucket in np.unique(columns[0]):
            here = np.flatnonzero(columns[0] == bucket)
            # In order of their contexts, so that what is looked up next is near.
            here = here[np.lexsort([columns[i][here] for i in (2, 1)])]
            known = []
            for context in frequent.of_bucket(group * GROUP_BUCKETS + int(bucket)):
                of_context = np.concatenate(listed[context], axis=1)
                known.append((of_context[0], of_context[1].astype(np.int64)))
            text = columns[depth + 2][here]
            gain = bucket_gain(
                [columns[1 + k][here] for k in range(depth)], columns[depth + 1][here], (text & 1).astype(bool), known, shape
            )
            rows, at = np.unique(first[here] + (text >> 1), return_inverse=True)
            found.append((rows, np.bincount(at, gain, len(rows))))
        rows, gains = total(found)
        blocks = np.unique(tokens.column("block").to_numpy())
        bounds = np.append(np.searchsorted(rows, blocks), len(rows))
        runs = list(zip(blocks, bounds, bounds[1:]))
        columns = [
            pa.array(blocks),
            pa.array(np.diff(bounds)),
            pa.array([packed(rows[i:j] - block) for block, i, j in runs], pa.binary()),
            pa.array([gains[i:j].tobytes() for _, i, j in runs], pa.binary()),
        ]
        return pa.Table.from_arrays(columns, [part.split()[0] for part in GAINED.split(", ")])

    def total(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        rows, at = np.unique(np.concatenate([r for r, _ in found]), return_inverse=True)
        return rows, np.bincount(at, np.concatenate([g for _, g in found]), len(rows)).astype(float)

    def add_up(gained: pa.Table) -> pa.Table:
        runs = zip(*(gained.column(c).to_pylist() for c in ("block", "size", "texts", "gains")))
        rows, gains = total([(block + unpacked(texts, n).astype(np.int64), np.frombuffer(g)) for block, n, texts, g in runs])
        return pa.table({"row": rows, "gain": gains})

    if entries is None:
        needed = spark.createDataFrame([], "group bigint, context bigint, size bigint, entries binary")
    else:
        firsts = frequent.first_bucket
        pairs = {
            (bucket // GROUP_BUCKETS, context)
            for number in range(len(firsts))
            for bucket in range(int(firsts[number]), int(firsts[number] + frequent.buckets[number]))
            for context in frequent.chain(number)
        }
        groups = spark.createDataFrame(sorted(pairs), "group bigint, context bigint")
        needed = entries.join(F.broadcast(groups), "context").select("group", "context", "size", "entries")
    both = dealt.groupBy("group").cogroup(needed.groupBy("group"))
    return both.applyInArrow(score, GAINED).groupBy("block").applyInArrow(add_up, "row bigint, gain double")


def score_baseline(blocks: DataFrame, counts: WordCounts) -> DataFrame:
    """Per row its id, tokens, those that were learnt, and the score without context."""
    per_token = math.log10(counts.n_tokens + counts.n_words + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in (run for block in blocks_of(batch) for run in block.runs()):
                n = len(block.n_tokens)
                text = np.repeat(np.arange(n), block.n_tokens)
                learnt = counts.of(block.numbers)
                logs = np.bincount(text, np.log10(learnt + 1.0), n) - block.n_tokens * per_token
                columns = [
                    pa.array(block.first + np.arange(n)),
                    block.doc_id,
                    pa.array(block.n_tokens),
                    pa.array(np.bincount(text, learnt > 0, n).astype(np.int64)),
                    pa.array(logs.astype(float)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in SCORED.split(", ")])

    return blocks.mapInArrow(score, SCORED)


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs(doc_id, text)``.

    Counts and tree come from all rows for which ``held_out``, a condition on ``doc_id``, is false. Null and empty
    texts are one end token, texts may have any length. Other columns are ignored, whatever their names. Null ids and repeated rows are scored row by row; an empty table gives no rows. Without
    training rows every token has the same probability. Each token is dealt once, with the symbols before it, to the
    bucket that learns and scores by its part of the tree.
    """
    with shuffles_freed(docs.sparkSession):
        blocks, counts = number_tokens(docs, ~held_out)
        shape = Shape.of(counts)
        scored = stage(score_baseline(blocks, counts), "scored")
        tokens = scored.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first()["n"]
        frequent, entries = frequent_contexts(blocks, shape, tokens)
        gains = stage(score_buckets(deal_tokens(blocks, shape, frequent), entries, shape, frequent), "gains")
    return scored.join(gains, "row", "left").select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(counts.n_tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        (F.col("base_score") + F.coalesce("gain", F.lit(0.0))).alias("score"),
    )
