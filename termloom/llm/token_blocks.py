"""Texts as blocks of numbered tokens: the words of a corpus are numbered by falling count, blocks hold the numbers.

A token is a lower-case word or the end of a text. A number tells the count of its word by a table that has a row for
each different count, thus about ``sqrt(2 * tokens)`` rows at most. Numbers start at 1; 0 is a word that was not learnt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage, staged
from .words import Texts, find_words, mix, text_groups

# A block holds whole texts of about so many tokens; so many words of blocks are numbered together.
BLOCK_TOKENS, PART_WORDS = 1 << 20, 1 << 19
RUN_TOKENS = 1 << 16
END_HASH = mix(np.array([0x0A], np.uint64))[0]

CUT = (
    "block bigint, doc_id array<bigint>, learnt array<boolean>, n_tokens array<bigint>, words array<bigint>, "
    "counts array<bigint>, tokens binary"
)
LISTED = "part bigint, block bigint, first bigint, words array<bigint>, counts array<bigint>"
HISTOGRAM = "part bigint, n bigint, words bigint, end_rank bigint"
RUNS = "of_block bigint, first bigint, size bigint, numbers binary"
NUMBERED = "block bigint, doc_id array<bigint>, learnt array<boolean>, n_tokens array<bigint>, tokens binary"


def tokens_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a run of texts, ends included, and the bounds of each text in them."""
    words = find_words(texts, lower=True)
    bounds = np.concatenate([[0], np.cumsum(words.per_text + 1)])
    hashes = np.full(bounds[-1], END_HASH, np.uint64)
    inside = np.ones(len(hashes), bool)
    inside[bounds[1:] - 1] = False
    hashes[inside] = words.hash
    return hashes, bounds


def packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as four planes of bytes, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<u4").ravel()


def lists_of(values: list[np.ndarray | pa.Array]) -> pa.ListArray:
    """A column with a list in each row."""
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays([pa.array(v) for v in values]))


@dataclass
class Block:
    """Whole texts: the number of the first, ids, which are learnt from, tokens of each, and the numbers of all tokens."""

    first: int
    doc_id: pa.Array
    learnt: np.ndarray
    n_tokens: np.ndarray
    numbers: np.ndarray

    def runs(self) -> Iterator[Block]:
        """The texts of the block in runs of about ``RUN_TOKENS`` tokens, so that little is held for each token."""
        ends = np.cumsum(self.n_tokens)
        begin = at = 0
        while begin < len(ends):
            end = max(begin + 1, int(np.searchsorted(ends, at + RUN_TOKENS, "right")))
            some, until = slice(begin, end), int(ends[end - 1])
            yield Block(
                self.first + begin, self.doc_id[some], self.learnt[some], self.n_tokens[some], self.numbers[at:until]
            )
            begin, at = end, until


def blocks_of(batch: pa.RecordBatch) -> Iterator[Block]:
    """The blocks in rows of ``NUMBERED``."""
    first, doc_ids, learnt, n_tokens, tokens = batch.columns
    for i in range(len(batch)):
        sizes = n_tokens[i].values.to_numpy()
        numbers = unpacked(tokens[i].as_py(), int(sizes.sum()))
        yield Block(first[i].as_py(), doc_ids[i].values, learnt[i].values.to_numpy(False), sizes, numbers)


@dataclass
class WordCounts:
    """Counts of the words by number: ``last[i]`` is the last number of the words that occur ``counts[i]`` times."""

    counts: np.ndarray
    last: np.ndarray
    end: int
    n_tokens: int
    n_words: int

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """How often each word was learnt."""
        if not len(self.last):
            return np.zeros(len(numbers), np.int64)
        return np.where(numbers > 0, self.counts[np.searchsorted(self.last, numbers)], 0)

    def at_least(self, n: float) -> int:
        """The last number of the words that occur at least ``n`` times."""
        return int(self.last[self.counts >= n][-1]) if (self.counts >= n).any() else 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 40
    held: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]] = []

    def block() -> pa.RecordBatch:
        doc_ids, learnt, sizes, hashes = zip(*held)
        learnt, sizes = np.concatenate(learnt), np.concatenate(sizes)
        words, codes = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.bincount(codes, np.repeat(learnt, sizes), len(words)).astype(np.int64)
        columns = [
            pa.array([first]), lists_of([pa.concat_arrays(doc_ids)]), lists_of([learnt]), lists_of([sizes]),
            lists_of([words.view(np.int64)]), lists_of([counts]), pa.array([packed(codes)]),
        ]
        return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in CUT.split(", ")])

    for batch in batches:
        done = 0
        for texts in text_groups(batch.column(1)):
            here = pa.array(np.arange(done, done + len(texts)))
            hashes, bounds = tokens_of(texts)
            learnt = batch.column(2).take(here).to_numpy(zero_copy_only=False)
            held.append((batch.column(0).take(here), learnt, np.diff(bounds), hashes))
            done += len(texts)
            if sum(len(h[-1]) for h in held) >= BLOCK_TOKENS:
                yield block()
                first += sum(len(h[0]) for h in held)
                held = []
    if held:
        yield block()


def _listed(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """The words of blocks, ascending in each, in runs of those that share the high bits."""
    for batch in batches:
        for block, words, counts in zip(*(batch.column(c) for c in ("block", "words", "counts"))):
            words, counts = words.values, counts.values
            high = words.to_numpy().view(np.uint64) >> np.uint64(32)
            part = ((high * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            bounds = list(zip(starts, np.append(starts[1:], len(part))))
            columns = [
                pa.array(part[starts]), pa.array([block.as_py()] * len(starts)), pa.array(starts),
                lists_of([words[i:j] for i, j in bounds]), lists_of([counts[i:j] for i, j in bounds]),
            ]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in LISTED.split(", ")])


def _merged(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a part with their counts, their order among those that occur as often, and the place of each row's
    words among them."""
    words, counts = (rows.column(c).combine_chunks().flatten().to_numpy() for c in ("words", "counts"))
    words, place = np.unique(words.view(np.uint64), return_inverse=True)
    n = np.bincount(place, counts, len(words)).astype(np.int64)
    order = np.argsort(n, kind="stable")
    rank = np.empty(len(n), np.int64)
    rank[order] = np.arange(len(n)) - np.searchsorted(n[order], n[order])
    return words, n, rank, place


def _histogram(rows: pa.Table) -> pa.Table:
    """How many words of a part occur how often; where the end is among those, its order."""
    words, n, rank, _ = _merged(rows)
    values, many = np.unique(n[n > 0], return_counts=True)
    end = {int(n[i]): int(rank[i]) for i in np.flatnonzero(words == END_HASH)}
    parts = pa.array(np.full(len(values), rows.column("part")[0].as_py()), pa.int64())
    ranks = pa.array([end.get(v) for v in values.tolist()], pa.int64())
    return pa.table({"part": parts, "n": values, "words": many, "end_rank": ranks})


def _number(blocks: pa.Table, numbered: pa.Table) -> pa.Table:
    """One block, its tokens by number instead of by place in its own list of words."""
    batch = blocks.combine_chunks().to_batches()[0]
    codes = unpacked(batch.column("tokens")[0].as_py(), int(batch.column("n_tokens")[0].values.to_numpy().sum()))
    numbers = np.zeros(int(codes.max()) + 1, np.uint32)
    for first, size, part in zip(*(numbered.column(c).to_pylist() for c in ("first", "size", "numbers"))):
        numbers[first : first + size] = unpacked(part, size)
    return pa.Table.from_batches([batch]).set_column(4, "tokens", pa.array([packed(numbers[codes])]))


def number_tokens(docs: DataFrame, learnt: Column) -> tuple[DataFrame, WordCounts]:
    """Staged blocks (``NUMBERED``) of all texts of ``docs(doc_id, text)``, and the counts of the words learnt.

    Words are learnt from the rows for which ``learnt`` is true. Null texts are empty ones. The words of each block are
    dealt by their hash, numbered there, and their numbers brought back to the block.
    """
    wanted = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.coalesce(learnt, F.lit(False)).alias("learnt")
    )
    with staged(wanted.mapInArrow(_cut, CUT), "blocks") as blocks:
        listed = blocks.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n")).first()["n"]
        parts = max(1, -(-listed // PART_WORDS))
        words = blocks.select("block", "words", "counts").mapInArrow(lambda b: _listed(b, parts), LISTED)
        histogram = stage(words.groupBy("part").applyInArrow(_histogram, HISTOGRAM), "word-counts")
        steps = histogram.groupBy("n").agg(F.sum("words").alias("words")).orderBy(F.col("n").desc()).toArrow()
        counts, last = steps.column("n").to_numpy(), np.cumsum(steps.column("words").to_numpy())
        # Words that occur as often are numbered part by part.
        earlier = W.partitionBy("n").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
        before = F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before")
        offsets = histogram.select(F.col("part").alias("of_part"), "n", before, "end_rank")
        above = np.concatenate([[0], last])[: len(last)]

        def number(rows: pa.Table, offsets: pa.Table) -> pa.Table:
            _, n, rank, place = _merged(rows)
            order = np.argsort(offsets.column("n").to_numpy())
            known, before = (offsets.column(c).to_numpy()[order] for c in ("n", "before"))
            numbers, some = np.zeros(len(n), np.int64), np.flatnonzero(n)
            step = len(counts) - 1 - np.searchsorted(counts[::-1], n[some])
            numbers[some] = above[step] + before[np.searchsorted(known, n[some])] + rank[some] + 1
            sizes = rows.column("words").combine_chunks().value_lengths().to_numpy()
            ends = np.cumsum(sizes)
            runs = [packed(numbers[place[i:j]]) for i, j in zip(ends - sizes, ends)]
            return pa.table(
                {"of_block": rows.column("block"), "first": rows.column("first"), "size": sizes, "numbers": runs},
                pa.schema([("of_block", pa.int64()), ("first", pa.int64()), ("size", pa.int64()), ("numbers", pa.binary())]),
            )

        numbers = words.groupBy("part").cogroup(offsets.groupBy("of_part")).applyInArrow(number, RUNS)
        by_block = blocks.drop("words", "counts").groupBy("block").cogroup(numbers.groupBy("of_block"))
        numbered = stage(by_block.applyInArrow(_number, NUMBERED), "numbered-blocks")
        end = offsets.filter("end_rank is not null").first()
        end = int(above[counts == end["n"]][0]) + end["before"] + end["end_rank"] + 1 if end else 0
        n_tokens = int((counts * np.diff(last, prepend=0)).sum())
        return numbered, WordCounts(counts, last, end, n_tokens, int(last[-1]) if len(last) else 0)
