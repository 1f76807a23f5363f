"""Token ids in binary shards: blocks of ids split into byte or bit planes, each compressed, with a chunk index.

A shard is ``magic``, the compressed planes chunk after chunk, the footer and its length. The footer (compressed JSON
and arrays) holds for every chunk its place, number of ids and the sizes of its planes, and for every document its id
and number of ids, so that any document can be read without decoding other chunks.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .files import new_file, read_file, write_with_manifest
from .tokens import encode_column

MAGIC = b"IDPLANE1"
BLOCK_IDS = 1 << 16
END_ID = 0
MANIFEST = "shard int, file string, n_ids bigint, n_docs bigint, n_bytes bigint"
DOCUMENTS = "doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint, shard int"


def to_planes(ids: np.ndarray, bits: bool) -> list[np.ndarray]:
    """Transpose a block of 32-bit ids: plane k holds byte k, or bit k, of every id. Empty high planes are left out."""
    as_bytes = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    used = int(ids.max()).bit_length() if len(ids) else 0
    if not bits:
        return [np.ascontiguousarray(as_bytes[:, k]) for k in range(-(-used // 8))]
    each = np.unpackbits(as_bytes, axis=1, bitorder="little")
    return [np.packbits(each[:, k], bitorder="little") for k in range(used)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    """The block of ids again."""
    if not bits:
        as_bytes = np.zeros((n, 4), np.uint8)
        for k, plane in enumerate(planes):
            as_bytes[:, k] = np.frombuffer(plane, np.uint8)
        return as_bytes.view("<u4").ravel()
    each = np.zeros((n, 32), np.uint8)
    for k, plane in enumerate(planes):
        each[:, k] = np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little", count=n)
    return np.packbits(each, axis=1, bitorder="little").view("<u4").ravel()


class ShardWriter:
    """Takes documents one after the other and writes full blocks as they fill."""

    def __init__(self, out, bits: bool = False, block_ids: int = BLOCK_IDS, level: int = 3):
        self._out, self._bits, self._block = out, bits, block_ids
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._waiting: list[np.ndarray] = []
        self._n_waiting = 0
        self._at = len(MAGIC)
        self._chunks: list[list[int]] = []
        self._doc_ids: list[int | None] = []
        self._lengths: list[int] = []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._doc_ids.append(doc_id)
        self._lengths.append(len(ids))
        self._waiting.append(ids)
        self._n_waiting += len(ids)
        if self._n_waiting >= self._block:
            ids = np.concatenate(self._waiting)
            whole = len(ids) // self._block * self._block
            for start in range(0, whole, self._block):
                self._write(ids[start : start + self._block])
            self._waiting, self._n_waiting = [ids[whole:]], len(ids) - whole

    def _write(self, ids: np.ndarray) -> None:
        planes = [self._zstd.compress(p.tobytes()) for p in to_planes(ids, self._bits)]
        self._chunks.append([self._at, len(ids), *map(len, planes)])
        for plane in planes:
            self._out.write(plane)
            self._at += len(plane)

    def close(self) -> tuple[int, int, int]:
        """Write what is left and the footer; returns ids, documents and bytes."""
        if self._n_waiting:
            self._write(np.concatenate(self._waiting))
        ids = np.array([d or 0 for d in self._doc_ids], "<i8").tobytes()
        known = np.array([d is not None for d in self._doc_ids], np.uint8).tobytes()
        lengths = np.array(self._lengths, "<i8").tobytes()
        head = json.dumps({"bits": self._bits, "docs": len(self._doc_ids), "chunks": self._chunks}).encode()
        footer = self._zstd.compress(struct.pack("<I", len(head)) + head + ids + known + lengths)
        self._out.write(footer + struct.pack("<I", len(footer)))
        self._out.close()
        return sum(self._lengths), len(self._lengths), self._at + len(footer) + 4


class ShardReader:
    """Opens a shard by its footer and decodes chunks on demand."""

    def __init__(self, file):
        self._file = file
        size = file.size()
        file.seek(0)
        if file.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a shard of token ids")
        file.seek(size - 4)
        (length,) = struct.unpack("<I", file.read(4))
        file.seek(size - 4 - length)
        self._zstd = zstandard.ZstdDecompressor()
        footer = self._zstd.decompress(file.read(length))
        (head,) = struct.unpack_from("<I", footer)
        index = json.loads(footer[4 : 4 + head])
        n, at = index["docs"], 4 + head
        self.bits, self.chunks = index["bits"], index["chunks"]
        ids = np.frombuffer(footer, "<i8", n, at)
        known = np.frombuffer(footer, np.uint8, n, at + 8 * n)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known)]
        self.bounds = np.concatenate([[0], np.cumsum(np.frombuffer(footer, "<i8", n, at + 9 * n))]).astype(np.int64)
        self.chunk_bounds = np.concatenate([[0], np.cumsum([c[1] for c in self.chunks])]).astype(np.int64)
        self._last: tuple[int, np.ndarray] | None = None

    def chunk(self, k: int) -> np.ndarray:
        if self._last is None or self._last[0] != k:
            at, n, *sizes = self.chunks[k]
            self._file.seek(at)
            planes = [self._zstd.decompress(self._file.read(size)) for size in sizes]
            self._last = (k, from_planes(planes, n, self.bits))
        return self._last[1]

    def parts(self, doc: int) -> Iterator[np.ndarray]:
        """The ids of a document, chunk by chunk."""
        start, end = self.bounds[doc], self.bounds[doc + 1]
        k = int(np.searchsorted(self.chunk_bounds, start, "right")) - 1
        while start < end:
            base, stop = self.chunk_bounds[k], min(end, self.chunk_bounds[k + 1])
            yield self.chunk(k)[start - base : stop - base]
            start, k = stop, k + 1


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    end_id: int = END_ID,
    bits: bool = False,
    shards: int | None = None,
    added_tokens: bool = False,
) -> DataFrame:
    """Encode ``docs(doc_id, text, ...)`` and write one shard per task in ascending order of ``doc_id``.

    Returns the manifest: shard, file, ids, documents and bytes. Null ids come first, rows with one id are ordered by
    their text, null texts are empty and give the end id alone. An empty table writes shards without documents or
    none. A task holds one block of ids and the lengths of its documents.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out = new_file(folder, ".ids")
        shard = ShardWriter(out, bits)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, found in encode_column(tokenizer_file, batch.column(1), added_tokens):
                for k, ids in enumerate(found):
                    shard.add(doc_ids[first + k], np.append(ids, np.uint32(end_id)))
        counts = shard.close()
        row = [TaskContext.get().partitionId(), name, *counts]
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        names = [part.split()[0] for part in MANIFEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    return write_with_manifest(docs, folder, write, MANIFEST)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, shard`` of every document in the shards, decoded from the files.

    ``start`` counts the ids of all documents before it, through all shards.
    """
    shards = manifest.select("shard", "file", "n_ids")
    n = max(1, shards.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with read_file(folder, name) as file:
                    reader = ShardReader(file)
                    crcs = []
                    for k in range(len(reader.doc_ids)):
                        crc = 0
                        for part in reader.parts(k):
                            crc = zlib.crc32(np.ascontiguousarray(part).tobytes(), crc)
                        crcs.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reader.doc_ids, pa.int64()),
                            pa.array(reader.bounds[:-1]),
                            pa.array(np.diff(reader.bounds)),
                            pa.array(crcs, pa.int64()),
                            pa.array([shard] * len(crcs), pa.int32()),
                        ],
                        [part.split()[0] for part in DOCUMENTS.split(", ")],
                    )

    found = shards.repartition(n, "shard").select("shard", "file").mapInArrow(read, DOCUMENTS)
    # One row per shard, so that a window over all of them is small; so is the join with it.
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    return found.join(F.broadcast(bases), "shard").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "shard"
    )
