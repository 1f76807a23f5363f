"""WARC archives, token files, packing and the encoder behind them."""

import base64
import hashlib
import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termloom.llm.packing import differencing, pack_documents, pack_items, pieces_of
from termloom.llm.token_files import ShardReader, ShardWriter, from_planes, read_token_files, to_planes, write_token_files
from termloom.llm.tokens import Encoder, encode_column
from termloom.llm.warc import build_record, mark_revisits, page_of_record_id, read_warc, records_of_range, write_warc
from termloom.session import new_path

tokenizer_file = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(texts, encode):
    more = ["a  b", "a\n b", "\n\n a", "b \xa0c", " " * 9, "don't 12 345 !!", "tail end", "ab " * 30000, "word\n"]
    column = pa.array(texts + more)
    found = [ids.tolist() for _, some in encode_column(tokenizer_file, column) for ids in some]
    assert found == [encode(t) for t in texts + more]


def test_added_tokens_equal_the_plain_call(spark, texts, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    from termloom.llm.registered import op4_packing, op7_token_files

    tokenizer = Tokenizer.from_file(tokenizer_file)
    plain = lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids
    assert 50256 in plain("a b <|endoftext|> c")
    more = [*texts, "a b <|endoftext|> c", "<|endoftext|>", "<|endof text|>", "x <|endoftext|><|endoftext|>\n y", "<|endof", "text|>"]
    found = [ids.tolist() for _, some in encode_column(tokenizer_file, pa.array(more), added_tokens=True) for ids in some]
    assert found == [plain(t) for t in more]
    docs = spark.createDataFrame(list(enumerate(more)), "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    tokens = {r["doc_id"]: r["n_tokens"] for r in op7_token_files(spark, str(tmp_path)).collect()}
    assert tokens == {k: len(plain(t)) + 1 for k, t in enumerate(more)}
    for packed in (op4_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        assert {r["doc_id"]: r["doc_tokens"] for r in packed.collect()} == tokens


def test_encoder_with_a_full_cache(encode):
    from termloom.llm.words import text_groups

    encoder = Encoder(tokenizer_file, cache_pieces=20)
    texts = [" ".join(f"word{i * k % 31}" for i in range(60)) for k in range(1, 9)]
    for group in text_groups(pa.array(texts), group_bytes=300):
        ids, bounds = encoder.encode(group)
        for k in range(len(group)):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == encode(texts[group.first + k])


@pytest.mark.parametrize("bits", [False, True])
def test_planes(bits):
    for ids in ([], [0], [1, 2, 3], [50256, 0, 7] * 5, [2**32 - 1, 5]):
        block = np.array(ids, np.uint32)
        planes = [p.tobytes() for p in to_planes(block, bits)]
        assert from_planes(planes, len(ids), bits).tolist() == ids


@pytest.mark.parametrize("bits", [False, True])
def test_shard_round_trip_and_single_documents(bits):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50257, n).astype(np.uint32) for n in (1, 0, 7, 300, 16, 16, 5)]
    out = io.BytesIO()
    close, out.close = out.close, lambda: None
    shard = ShardWriter(out, bits, block_ids=16)
    for k, ids in enumerate(docs):
        shard.add(None if k == 2 else k, ids)
    assert shard.close() == (sum(map(len, docs)), len(docs), len(out.getvalue()))

    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    reader = ShardReader(File(out.getvalue()))
    assert reader.doc_ids == [0, 1, None, 3, 4, 5, 6]
    for k in (6, 0, 3, 1, 2):
        assert np.concatenate([*reader.parts(k), np.zeros(0, np.uint32)]).tolist() == docs[k].tolist()
    close()
    with pytest.raises(ValueError):
        ShardReader(File(b"something else entirely"))


@pytest.mark.parametrize("bits", [False, True])
def test_token_files(spark, docs, no_docs, texts, encode, bits):
    folder = new_path(spark, "ids")
    manifest = write_token_files(docs, folder, tokenizer_file, bits=bits, shards=3)
    found = read_token_files(manifest, folder).orderBy("start").collect()
    assert len(found) == docs.count() and found[0]["doc_id"] is None
    assert [r["doc_id"] for r in found[1:]] == sorted([*range(len(texts)), 3])
    start = 0
    for row in found:
        ids = encode(texts[5 if row["doc_id"] is None else row["doc_id"]]) + [0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)
    folder = new_path(spark, "ids")
    assert read_token_files(write_token_files(no_docs, folder, tokenizer_file), folder).count() == 0


def test_differencing_balances():
    for sizes, windows in (([5, 5, 4, 3, 3], 2), ([8, 7, 6, 5, 4], 2), ([1], 1), ([3, 3, 3], 3), ([9, 8, 7, 3, 2, 1], 3)):
        packed = differencing(list(sizes), windows)
        assert sorted(i for items in packed for i in items) == list(range(len(sizes))) and len(packed) <= windows
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in differencing([8, 7, 6, 5, 4], 2)) == [14, 16]
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 500, 400).tolist()
    sums = [sum(sizes[i] for i in w) for w in differencing(sizes, 40)]
    assert max(sums) - min(sums) < 40 and len(sums) == 40


def test_window_count_rises():
    packed = pack_items([6, 6, 6], 10)
    assert len(packed) == 3 and pack_items([], 10) == []
    assert pieces_of(25, 10, 4) == [(0, 10), (10, 10), (20, 3), (23, 2)] and pieces_of(20, 10, 4) == [(0, 10), (10, 10)]


def test_packing(docs, no_docs, texts, encode):
    rows = pack_documents(docs, tokenizer_file, capacity=64, max_piece=16, group_windows=4).collect()
    by_doc, by_window = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_window.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == {None, *range(len(texts))}
    for doc_id, pieces in by_doc.items():
        ids = np.array(encode(texts[5 if doc_id is None else doc_id]) + [1], "<u4")
        times = 2 if doc_id == 3 else 1
        assert sum(p["length"] for p in pieces) == times * len(ids)
        for p in pieces:
            part = ids[p["start"] : p["start"] + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(part.tobytes()) and p["doc_tokens"] == len(ids)
    for pieces in by_window.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 64
    assert pack_documents(no_docs, tokenizer_file).count() == 0


def test_padding_does_not_depend_on_tasks(spark):
    rows = [(k, " ".join(f"w{(k * 31 + i * i) % 997}" for i in range(20 + k * 7 % 300))) for k in range(1000)]
    rows += [(2000, "one word")] * 50
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = None
    for tasks in (1, 4, 200):
        packed = pack_documents(docs.repartition(tasks), tokenizer_file).collect()
        ends = {}
        for r in packed:
            ends[r["sequence_id"]] = max(ends.get(r["sequence_id"], 0), r["offset"] + r["length"])
        tokens = sum(r["length"] for r in packed)
        assert max(ends.values()) <= 2048 and sum(ends.values()) == tokens
        assert len(ends) * 2048 <= 1.02 * tokens + 2048
        pieces = sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in packed)
        assert whole in (None, pieces)
        whole = pieces


PAGES = [
    (1, "http://a/1", "<p>same"), (2, "http://a/2", "<p>same"), (9, "http://a/9", "<p>same"), (3, None, None), (4, "u", ""),
    (5, "http://a/\n5", "<p>größer &amp; 日本"), (6, "x", "z" * 200000), (None, "n", "<p>same"), (None, None, "lone"),
    (7, "a", "twice"), (7, "a", "twice"),
]


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.mark.parametrize("split", [64, 1000, 1 << 25])
def test_archives_round_trip(spark, split):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash"))
    folder = new_path(spark, "warc")
    manifest = write_warc(mark_revisits(pages.repartition(2)), folder)
    assert manifest.agg(F.sum("n_records")).first()[0] == len(PAGES)
    records = read_warc(manifest, folder, split_bytes=split).withColumn("page_id", page_of_record_id(F.col("record_id")))
    found = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or "", r["payload_bytes"], r["payload_digest"]) for r in records.collect())
    kept = {"<p>same": 9, "twice": 7, "": 4}
    expected = []
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        to = kept.get(html or "")
        own = to is None or to == page_id
        expected.append((page_id or 0, "response" if own else "revisit", "" if own else f"<urn:x-page:{to}>", len(payload), digest(payload)))
    assert found == sorted(expected)
    html = {r["page_id"]: r["payload"] for r in records.filter("record_type = 'response'").collect()}
    assert bytes(html[6]) == b"z" * 200000 and bytes(html[5]).decode() == "<p>größer &amp; 日本"


def test_small_payloads_and_empty_tables(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    assert mark_revisits(pages, min_bytes=6).filter("refers_to is not null").count() == 3
    folder = new_path(spark, "warc")
    assert read_warc(write_warc(mark_revisits(pages.filter("false")), folder), folder).count() == 0


def test_headers_of_any_length(spark):
    url = "data:," + "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(4000))
    pages = spark.createDataFrame([(1, url, "<p>long"), (2, "u", "<p>short")], "page_id bigint, url string, html string")
    folder = new_path(spark, "warc")
    records = read_warc(write_warc(mark_revisits(pages), folder), folder).collect()
    assert {r["target_uri"] for r in records} == {url, "u"}


def test_ranges_own_what_starts_in_them():
    def member(data):
        zipper = zlib.compressobj(0, zlib.DEFLATED, 31)
        return zipper.compress(data) + zipper.flush()

    # A payload that holds gzip magic, a whole gzip member that is no record, and stray bytes between members.
    tricky = b"\x1f\x8b\x08 no member " + member(b"not a record") + b" WARC/1.0"
    parts = [member(build_record(k, f"http://a/{k}", tricky * (k % 3), None)) for k in range(20)]
    parts.insert(7, b"\x1f\x8b\x08stray" + member(b"GET / HTTP/1.1\r\n\r\n"))
    data = b"".join(parts)
    whole = [at for at, _ in records_of_range(io.BytesIO(data), 0, len(data))]
    assert len(whole) == 20
    for size in (1, 50, 777, 10**6):
        found = [at for start in range(0, len(data), size) for at, _ in records_of_range(io.BytesIO(data), start, start + size)]
        if size > 1:
            assert [at for at in found if at in set(whole)] == whole
