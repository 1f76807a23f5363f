"""WARC archives: a writer with revisit records, and a splittable reader of gzip members."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .files import new_file, read_file, write_with_manifest

SPLIT_BYTES = 32 << 20
READ_BYTES = 1 << 20
OUT_BYTES = 8 << 20
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION_LINE = re.compile(rb"WARC/\d+\.\d+\r\n")
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, n_records bigint, n_bytes bigint"
RECORDS = (
    "file string, offset bigint, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_bytes bigint, payload_digest string, payload binary"
)


def _text(html: str) -> F.Column:
    return F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8")


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``: of pages with equal payloads the largest id is kept, the rest refer to it.

    Payloads are equal when SHA-1 and length agree. Those under ``min_bytes`` never refer to another. Rows with the
    largest id are all kept when that id is repeated; a null id is smaller than any other, and payloads that only null
    ids have are all kept. Only digests that occur more than once are joined back, from a table that is staged first:
    Spark broadcasts it when it is small and splits digests with very many pages when it is not.
    """
    pages = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), _text("html").alias("payload")
    ).withColumns({"digest": F.unhex(F.sha1("payload")), "n_bytes": F.octet_length("payload")})
    copies = pages.filter(F.col("n_bytes") >= min_bytes).groupBy("digest", "n_bytes").agg(
        F.max("page_id").alias("kept_id"), F.count("*").alias("n")
    )
    copies = stage(copies.filter("n > 1 and kept_id is not null").select("digest", "n_bytes", "kept_id"), "copies")
    own = F.col("page_id").eqNullSafe(F.col("kept_id"))
    return pages.join(copies, ["digest", "n_bytes"], "left").select(
        "page_id", "url", "payload", F.when(~own, F.col("kept_id")).alias("refers_to")
    )


def page_record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def page_of_record_id(record_id: F.Column) -> F.Column:
    """The page id that a record id names; null for none."""
    return F.regexp_extract(record_id, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("bigint")


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record: an HTTP response, or a revisit with the same headers and no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", page_record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", page_record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def write_warc(marked: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Write the rows of :func:`mark_revisits`, one gzip member per record and one archive per task.

    Returns the manifest: file, records and bytes.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out = new_file(folder, ".warc.gz")
        records = size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                zipper = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = zipper.compress(build_record(*row)) + zipper.flush()
                out.write(member)
                records, size = records + 1, size + len(member)
        out.close()
        columns = [pa.array([name]), pa.array([records]), pa.array([size])]
        yield pa.RecordBatch.from_arrays(columns, ["file", "n_records", "n_bytes"])

    return write_with_manifest(marked.select("page_id", "url", "payload", "refers_to"), folder, write, MANIFEST)


def parse_head(data: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields (names in lower case) at the start of a record and their length; None if it isn't a record."""
    end = data.find(b"\r\n\r\n")
    if end < 0 or not VERSION_LINE.match(data):
        return None
    lines = data[:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    return fields, end + 4


class _Window:
    """A file read through one window, for mostly ascending offsets."""

    def __init__(self, file):
        self._file, self.base, self.data = file, 0, b""

    def read(self, offset: int, n: int) -> bytes:
        """Up to ``n`` bytes; fewer at the end of the file only."""
        if not (self.base <= offset and offset + n <= self.base + len(self.data)):
            self._file.seek(offset)
            self.data, self.base = self._file.read(max(n, READ_BYTES)), offset
        return self.data[offset - self.base : offset - self.base + n]

    def find(self, what: bytes, offset: int, end: int) -> int:
        """First place of ``what`` that starts in ``offset:end``; -1 if there is none."""
        while offset < end:
            n = min(READ_BYTES, end - offset + len(what) - 1)
            data = self.read(offset, n)
            found = data.find(what)
            if found >= 0:
                return offset + found
            if len(data) < n:
                return -1
            offset += max(1, n - len(what) + 1)
        return -1


def _member(window: _Window, offset: int) -> tuple[bytes, int] | None:
    """Data of the gzip member at an offset and where it ends, if it holds a record; else None.

    Decoding stops as soon as the data can't be a record. Behind a version line header fields may be of any length.
    """
    unzip = zlib.decompressobj(31)
    parts, at, feed, valid = [], offset, 4096, False
    head = bytearray()
    try:
        while not unzip.eof:
            read = window.read(at, feed)
            if not read:
                return None
            at, feed = at + len(read), min(2 * feed, READ_BYTES)
            parts.append(unzip.decompress(read))
            if not valid:
                searched = max(0, len(head) - 3)
                head += parts[-1]
                if head.find(b"\r\n\r\n", searched) >= 0:
                    if parse_head(bytes(head)) is None:
                        return None
                    valid = True
                elif not b"WARC/".startswith(head[:5]) or (len(head) > 64 and not VERSION_LINE.match(head)):
                    return None
    except zlib.error:
        return None
    return (b"".join(parts), at - len(unzip.unused_data)) if valid else None


def records_of_range(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and data of every record whose gzip member starts in ``start:end``, wherever it ends.

    The range is searched for the gzip magic; a candidate counts when decoding it yields WARC header fields. Behind a
    record the next candidate is tried at once, so that the search costs nothing inside members.
    """
    window = _Window(file)
    at = window.find(GZIP_MAGIC, start, end)
    while at >= 0:
        member = _member(window, at)
        if member is not None:
            yield at, member[0]
        at = window.find(GZIP_MAGIC, at + 1 if member is None else member[1], end)


def parse_record(data: bytes, with_payload: bool) -> tuple:
    """Type, id, target, reference, payload length, payload digest and payload of a record.

    Both payload figures are of the whole payload: counted for a response, as declared for a revisit.
    """
    fields, at = parse_head(data)
    block = data[at : at + int(fields["content-length"])]
    kind = fields["warc-type"]
    payload: bytes | None = block
    declared = fields.get("warc-payload-digest", "").partition(":")[2] or None
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
    if kind == "revisit":
        length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head + b"\r\n") if b"HTTP/" in block[:5] else None
        size, digest, payload = int(length[1]) if length else None, declared, None
    else:
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    ids = fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-refers-to")
    return kind, *ids, size, digest, payload if with_payload else None


def read_warc(manifest: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """All records of the archives in a manifest (``file``, ``n_bytes``), each read by the range it starts in."""
    starts = F.sequence(F.lit(0), F.greatest(F.col("n_bytes") - 1, F.lit(0)), F.lit(split_bytes))
    ranges = manifest.select("file", F.explode(starts).alias("start"))
    n = max(1, ranges.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORDS.split(", ")]
        types = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held = [], 0
                with read_file(folder, name) as file:
                    for offset, data in records_of_range(file, start, start + split_bytes):
                        kind, record_id, uri, refers, size, digest, payload = parse_record(data, with_payload)
                        rows.append((name, offset, kind, record_id, uri, refers, size, digest, payload))
                        held += len(data) if with_payload else 200
                        if held >= OUT_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    return ranges.repartition(n, "file", "start").mapInArrow(read, RECORDS)
