"""Fill-in-the-middle texts from seekable compressed frames."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import new_file, read_file, write_with_manifest

FRAME_BYTES = 1 << 15
LEVEL = 3
# Bytes read from a frame file at a time, bytes of frames for one task, and bytes of text in one batch of results.
WINDOW_BYTES, TASK_BYTES, RESULT_BYTES = 1 << 22, 1 << 26, 1 << 20

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# The parts of a text in the order of each form, every part behind its mark.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
_CONTINUES = bytes(range(0x80, 0xC0))

INDEX = (
    "doc_id bigint, file string, start bigint, n_bytes bigint, sizes array<int>, lines array<bigint>, "
    "chars array<bigint>, marked boolean"
)


def _code_points(data: bytes) -> int:
    """Code points that start in a piece of UTF-8."""
    return len(data.translate(None, _CONTINUES))


def write_frames(docs: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, level: int = LEVEL) -> DataFrame:
    """Store each text of ``docs(doc_id, text)`` as independent zstandard frames of ``frame_bytes`` bytes of text.

    Returns the index, a row per document: ``file``, ``start`` and ``sizes`` say where its frames are, ``lines`` and
    ``chars`` how many line ends and code points precede each frame and, last, the end of the text. ``marked``: the
    text holds one of the marks. Every task writes one file; texts follow each other in it as in the index.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=level).compress
        name, out, at = None, None, 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1).cast(pa.large_binary())):
                if out is None:
                    name, out = new_file(folder, ".zst")
                data = text.as_py() or b""
                sizes, lines, chars, start = [], [0], [0], at
                for begin in range(0, len(data), frame_bytes):
                    piece = data[begin : begin + frame_bytes]
                    frame = compress(piece)
                    out.write(frame)
                    at += len(frame)
                    sizes.append(len(frame))
                    lines.append(lines[-1] + piece.count(b"\n"))
                    chars.append(chars[-1] + _code_points(piece))
                marked = any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE))
                rows.append((doc_id.as_py(), name, start, len(data), sizes, lines, chars, marked))
            if rows:
                yield _batch(rows, INDEX)
        if out is not None:
            out.close()

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return write_with_manifest(texts, folder, write, INDEX)


_ARROW = {
    "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [part.split(" ") for part in schema.split(", ")]
    columns = [pa.array(values, _ARROW[kind]) for values, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


class FrameFile:
    """Byte ranges of one frame file, read a window at a time."""

    def __init__(self, folder: str, name: str):
        self.name, self._file = name, read_file(folder, name)
        self._from, self._window = 0, b""

    def read(self, start: int, size: int) -> bytes:
        if not self._from <= start <= start + size <= self._from + len(self._window):
            self._file.seek(start)
            self._from, self._window = start, self._file.read(max(size, WINDOW_BYTES))
        begin = start - self._from
        return self._window[begin : begin + size]


@dataclass
class Text:
    """One stored text: any range of it, or the place behind any of its lines, from the frames concerned alone."""

    file: FrameFile
    n_bytes: int
    starts: list[int]
    lines: list[int]
    chars: list[int]
    frame_bytes: int
    decompress: Callable[[bytes], bytes]
    _held: tuple[int, bytes] = (-1, b"")

    @property
    def n_lines(self) -> int:
        """Lines by ``[^\\n]*\\n|[^\\n]+``: a last one may lack its end."""
        if not self.n_bytes:
            return 0
        last = self.frame(len(self.starts) - 2)
        return self.lines[-1] + (not last.endswith(b"\n"))

    def frame(self, number: int) -> bytes:
        if self._held[0] != number:
            start, end = self.starts[number], self.starts[number + 1]
            self._held = number, self.decompress(self.file.read(start, end - start))
        return self._held[1]

    def read(self, begin: int, end: int) -> Iterator[bytes]:
        """The bytes of a range, a frame at a time."""
        for number in range(begin // self.frame_bytes, -(-end // self.frame_bytes)):
            at = number * self.frame_bytes
            yield self.frame(number)[max(0, begin - at) : end - at]

    def after(self, n: int) -> tuple[int, int]:
        """Bytes and code points of the first n lines; at most one frame is decompressed."""
        if n == 0:
            return 0, 0
        if n > self.lines[-1]:
            return self.n_bytes, self.chars[-1]
        number = bisect_left(self.lines, n) - 1
        frame = self.frame(number)
        ends = np.flatnonzero(np.frombuffer(frame, np.uint8) == 0x0A)
        size = int(ends[n - self.lines[number] - 1]) + 1
        return number * self.frame_bytes + size, self.chars[number] + _code_points(frame[:size])


@dataclass
class Arrangement:
    """Marks and ranges of a text one after the other: a text of its own, of which any range can be read."""

    text: Text
    parts: list[bytes | tuple[int, int]]

    @property
    def n_bytes(self) -> int:
        return sum(_length(p) for p in self.parts)

    def read(self, begin: int, end: int) -> Iterator[bytes]:
        at = 0
        for part in self.parts:
            size = _length(part)
            low, high = max(begin - at, 0), min(end - at, size)
            if low < high:
                yield from [part[low:high]] if isinstance(part, bytes) else self.text.read(part[0] + low, part[0] + high)
            at += size


def _length(part: bytes | tuple[int, int]) -> int:
    return len(part) if isinstance(part, bytes) else part[1] - part[0]


def arrange(text: Text, form: str, cuts: tuple[int, int]) -> Arrangement:
    """The text in a form, cut at two byte places."""
    if form == "plain":
        return Arrangement(text, [(0, text.n_bytes)])
    ranges = {PREFIX: (0, cuts[0]), MIDDLE: cuts, SUFFIX: (cuts[1], text.n_bytes)}
    return Arrangement(text, [part for mark in ORDERS[form] for part in (mark, ranges[mark])])


def restore(output: Arrangement, form: str) -> Iterator[bytes]:
    """The original text from an output and its form alone, by looking for the marks in the output."""
    if form == "plain":
        yield from output.read(0, output.n_bytes)
        return
    order = ORDERS[form]
    places = _places(output.read(0, output.n_bytes), order)
    ends = [*places[1:], output.n_bytes]
    ranges = {mark: (at + len(mark), end) for mark, at, end in zip(order, places, ends)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from output.read(*ranges[mark])


def _places(pieces: Iterable[bytes], marks: tuple[bytes, ...]) -> list[int]:
    """Where marks, in this order, stand in a stream of bytes; marks may lie across pieces."""
    places, held, at = [], b"", 0
    for piece in pieces:
        held += piece
        while len(places) < len(marks) and (found := held.find(marks[len(places)])) >= 0:
            places.append(at + found)
            cut = found + len(marks[len(places) - 1])
            held, at = held[cut:], at + cut
        keep = min(len(held), max(map(len, marks)) - 1)
        at, held = at + len(held) - keep, held[len(held) - keep :]
    if len(places) < len(marks):
        raise ValueError("the output lacks a mark")
    return places


@dataclass(frozen=True)
class Choice:
    """How forms and cuts are drawn: by the hash of ``seed:doc_id``, so runs agree.

    ``percent`` of the documents are transformed, ``spm_percent`` of those with the suffix first.
    """

    seed: int = 7
    percent: int = 100
    spm_percent: int = 50

    def draw(self, doc_id: int | None) -> tuple[int, int, int, int]:
        """Four 32-bit numbers of a document; a null id is written as nothing."""
        written = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return tuple(int(written[8 * i : 8 * i + 8], 16) for i in range(4))

    def form(self, drawn: tuple[int, int, int, int], text: Text, marked: bool) -> str:
        if not text.n_bytes or marked or drawn[2] % 100 >= self.percent:
            return "plain"
        return "spm" if drawn[3] % 100 < self.spm_percent else "psm"


_DIGESTS = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
_TEXTS = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def _sha256(pieces: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


def fill_in_middle(
    index: DataFrame, folder: str, choice: Choice = Choice(), frame_bytes: int = FRAME_BYTES, texts: bool = True
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars`` and the ``output`` of every text stored by :func:`write_frames`.

    Two places between the ``n`` lines of a text cut it into prefix, middle and suffix. Lines are found by the counts of
    the frames; only the two frames with the cuts are decompressed for it. ``texts=False`` gives ``output_sha256`` and
    ``restored_sha256`` instead, the latter of the text rebuilt from output and form; both are taken frame by frame, so
    a worker holds one frame and a window of the file however long a text is.

    A null text is empty. Empty texts, and texts that hold a mark, stay as they are (``plain``), with null counts.
    Rows with a null id are drawn alike, rows that repeat an id each by that id. An empty index gives no rows.
    """
    total = index.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda s, x: s + x))).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    spread = index.repartitionByRange(int(tasks), "file", "start").sortWithinPartitions("file", "start")
    schema = _TEXTS if texts else _DIGESTS

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor().decompress
        file, rows, held = None, [], 0
        for batch in batches:
            for doc_id, name, start, n_bytes, sizes, lines, chars, marked in zip(*(c.to_pylist() for c in batch.columns)):
                if file is None or file.name != name:
                    file = FrameFile(folder, name)
                starts = np.cumsum([start, *sizes]).tolist()
                text = Text(file, n_bytes, starts, lines, chars, frame_bytes, decompress)
                drawn, n = choice.draw(doc_id), text.n_lines
                form = choice.form(drawn, text, marked)
                first, last = sorted((drawn[0] % (n + 1), drawn[1] % (n + 1)))
                (cut, prefix), (end, both) = text.after(first), text.after(last)
                output = arrange(text, form, (cut, end))
                counts = (None, None) if form == "plain" else (prefix, both - prefix)
                if texts:
                    result = (b"".join(output.read(0, output.n_bytes)).decode(),)
                    held += output.n_bytes
                else:
                    result = _sha256(output.read(0, output.n_bytes)), _sha256(restore(output, form))
                rows.append((doc_id, n, form, *counts, *result))
                if held >= RESULT_BYTES:
                    yield _batch(rows, schema)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, schema)
                rows, held = [], 0

    return spread.mapInArrow(transform, schema)
