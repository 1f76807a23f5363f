"""Packing of documents into training windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .tokens import encode_column

CAPACITY = 2048
END_ID = 1
GROUP_WINDOWS = 256
MAX_PIECE = 512

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)
# Windows of the pieces that tasks leave over are numbered from here.
LEFT_OVER = 1 << 62
Partial = list[tuple[int, list[int]]]


def _merge(a: Partial, b: Partial, windows: int) -> Partial:
    """Merge two partial partitions so that the fullest windows of one meet the emptiest of the other.

    A partial lists its windows that hold something, emptiest first; all others are empty.
    """
    if len(a) < len(b):
        a, b = b, a
    free = windows - len(a)
    if len(b) == 1 and free:
        bisect.insort(a, b[0])
        return a
    # The fullest windows of b go to the empty windows of a, the rest to a's own, emptiest first.
    alone, meeting = (b[len(b) - free :], b[: len(b) - free]) if free < len(b) else (b, [])
    meeting = [(s + t, x + y) for (s, x), (t, y) in zip(a, reversed(meeting))]
    return sorted(meeting + a[len(meeting) :] + alone)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Spread items over ``windows`` so that the sums are nearly equal; returns the item numbers of each window.

    Always the two partial partitions with the largest imbalance (fullest less emptiest window) are merged next.
    """
    heap = []
    for number, size in enumerate(sizes):
        # With one window there is no imbalance; the number keeps ties in order.
        heap.append((-size if windows > 1 else 0, number, [(size, [number])]))
    heapq.heapify(heap)
    ticket = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        merged = _merge(a, b, windows)
        imbalance = merged[-1][0] - (merged[0][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-imbalance, ticket, merged))
        ticket += 1
    return [items for _, items in heap[0][2]] if heap else []


def pack_items(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity`` for items of at most that size; their number rises until all of them fit."""
    if not sizes:
        return []
    windows = -(-sum(sizes) // capacity)
    while True:
        packed = differencing(sizes, windows)
        if max(sum(sizes[i] for i in items) for items in packed) <= capacity:
            return packed
        windows += 1


def pieces_of(length: int, capacity: int, max_piece: int) -> list[tuple[int, int]]:
    """``(start, length)``: whole windows first, what is left in nearly equal pieces of at most ``max_piece``."""
    whole = length // capacity
    cut = [(k * capacity, capacity) for k in range(whole)]
    rest = length - whole * capacity
    parts = -(-rest // max_piece)
    start = whole * capacity
    for k in range(parts):
        size = rest // parts + (k < rest % parts)
        cut.append((start, size))
        start += size
    return cut


def packed_rows(pieces: list[tuple], capacity: int, first_sequence: int) -> list[tuple]:
    """Pieces ``(doc_id, start, length, ...)`` in windows numbered from ``first_sequence``, with their offset there."""
    rows = []
    for sequence, items in enumerate(pack_items([p[2] for p in pieces], capacity), first_sequence):
        offset = 0
        for i in items:
            rows.append((*pieces[i], sequence, offset))
            offset += pieces[i][2]
    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


class _Packer:
    """Gathers pieces of documents and packs them in whole groups; what never fills one is left over."""

    def __init__(self, capacity: int, group_windows: int, max_piece: int, first_sequence: int):
        self.capacity, self.max_piece = capacity, max_piece
        self.group_tokens = capacity * group_windows
        self.next_sequence = first_sequence
        self.rows: list[tuple] = []
        self.waiting: list[tuple] = []
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        for start, length in pieces_of(len(ids), self.capacity, self.max_piece):
            crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
            piece = (doc_id, start, length, crc, len(ids))
            if length == self.capacity:
                self.rows.append((*piece, self.next_sequence, 0))
                self.next_sequence += 1
            else:
                self.waiting.append(piece)
                self.tokens += length
        if self.tokens >= self.group_tokens:
            packed = packed_rows(self.waiting, self.capacity, self.next_sequence)
            self.rows += packed
            self.next_sequence = packed[-1][-2] + 1
            self.waiting, self.tokens = [], 0

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return _batch(rows)

    def left_over(self) -> pa.RecordBatch:
        """The pieces of no window; a null offset marks them, their number stands for a window's."""
        return _batch([(*p, self.next_sequence + k, None) for k, p in enumerate(self.waiting)])


def pack_left_over(pieces: DataFrame, capacity: int, group_windows: int) -> DataFrame:
    """Windows for the pieces that tasks left over, dealt by their number into groups of about ``group_windows``."""
    tokens = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    groups = max(1, round(tokens / (capacity * group_windows)))

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        group = group.sort_by("sequence_id").select(names)
        rows = list(zip(*(c.to_pylist() for c in group.columns)))
        return pa.Table.from_batches([_batch(packed_rows(rows, capacity, LEFT_OVER + (key[0].as_py() << 36)))])

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(pack, SCHEMA)


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group_windows: int = GROUP_WINDOWS,
    max_piece: int = MAX_PIECE,
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece of ``docs(doc_id, text, ...)`` in its window (``sequence_id``, ``offset``).

    Each task encodes its texts, cuts whole windows off long documents, and packs what is left in groups of about
    ``group_windows`` windows, of which it holds one at a time. The pieces that are too few for a group at its end go
    through a second pass, in which those of all tasks are dealt into such groups: so padding depends on the number of
    tokens, not of tasks, and only these pieces are shuffled. The first pass is written to the shared folder.

    A document with less than ``max_piece`` tokens left is not cut again. Null and empty texts give one piece with the
    end id alone; texts may have any length, a task holds the ids of one. Repeated rows and null ids are packed row by
    row, an empty table gives no rows, other columns are ignored, whatever their names. ``sequence_id`` is the number
    of the task (or group of the second pass, from 2**62) times 2**36 plus a counter.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(capacity, group_windows, max_piece, TaskContext.get().partitionId() << 36)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, found in encode_column(tokenizer_file, batch.column(1), added_tokens):
                for k, ids in enumerate(found):
                    packer.add(doc_ids[first + k], np.append(ids, np.uint32(end_id)))
                yield packer.take()
        yield packer.left_over()

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    pieces = stage(texts.mapInArrow(pack, SCHEMA), "pieces")
    left_over = pack_left_over(pieces.filter(F.col("offset").isNull()), capacity, group_windows)
    return pieces.filter(F.col("offset").isNotNull()).unionAll(left_over)
