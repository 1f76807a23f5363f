"""Fill-in-the-middle texts against a plain computation, whatever the size of the frames."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from termloom.llm.fill_middle import Choice, FrameFile, Text, _places, fill_in_middle, write_frames

TEXTS = [
    None, "", "\n", "\n\n\n", "no end", "one\n", "one\ntwo", "one\ntwo\n", "a<P>b\nc", "x\n<S>", "<M>", "<P <S <M\n<\n>", "<\n<P\n<",
    "Ñandú\ngrößer\nΟΔΟΣ\n日本語\n", "\r\nline\r\n\x0bv w\n", "x" * 5000, "ab\n" * 3000, "é" * 999 + "\n" + "日" * 999,
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text, seed=7, percent=100, spm_percent=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    written = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(written[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows_of(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    return frame.withColumns({"n": F.lit("x"), "start": F.lit(1.5), "file": F.lit(None)})


@pytest.mark.parametrize("frame_bytes", [1, 7, 64, 1 << 15])
def test_equals_plain_computation(spark, tmp_path, frame_bytes):
    draw = random.Random(frame_bytes)
    texts = TEXTS[:15] if frame_bytes == 1 else TEXTS
    rows = list(enumerate(texts)) + [(None, "one\ntwo\nthree"), (3, TEXTS[7]), (3, TEXTS[7]), (-12, "a\nb\nc\nd")]
    rows += [(100 + i, "\n".join("wörd " * draw.randint(0, 9) for _ in range(draw.randint(1, 20)))) for i in range(60)]
    folder = str(tmp_path / "frames")
    index = write_frames(rows_of(spark, rows), folder, frame_bytes)
    plain = [expected(*row) for row in rows]
    found = fill_in_middle(index, folder, frame_bytes=frame_bytes)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, plain))
    digests = fill_in_middle(index, folder, frame_bytes=frame_bytes, texts=False)
    texts_of = [(*p[:5], sha(p[5]), sha(t or "")) for p, (_, t) in zip(plain, rows)]
    assert sorted(map(repr, map(tuple, digests.collect()))) == sorted(map(repr, texts_of))


def test_shares_of_the_forms(spark, tmp_path):
    rows = [(i, f"a {i}\nb\nc") for i in range(400)]
    index = write_frames(rows_of(spark, rows), str(tmp_path / "f"))
    found = fill_in_middle(index, str(tmp_path / "f"), Choice(seed=3, percent=60, spm_percent=10))
    assert sorted(map(tuple, found.collect())) == sorted((expected(*r, 3, 60, 10) for r in rows), key=lambda r: r[0])


def test_long_text_in_many_frames(spark, tmp_path):
    text = "".join(f"línea {i}\n" for i in range(400_000))
    index = write_frames(rows_of(spark, [(1, text), (2, text.replace("\n", " "))]), str(tmp_path / "f"))
    assert index.filter(F.size("sizes") > 100).count() == 2
    found = {r["doc_id"]: r for r in fill_in_middle(index, str(tmp_path / "f"), texts=False).collect()}
    for doc_id, whole in ((1, text), (2, text.replace("\n", " "))):
        wanted = expected(doc_id, whole)
        assert tuple(found[doc_id])[:6] == (*wanted[:5], sha(wanted[5])) and found[doc_id]["restored_sha256"] == sha(whole)


def test_only_frames_with_cuts_are_decompressed(spark, tmp_path):
    import zstandard

    text = "".join(f"line {i}\n" for i in range(1000))
    row = write_frames(rows_of(spark, [(1, text)]), str(tmp_path / "f"), 100).first()
    starts = [row["start"] + sum(row["sizes"][:i]) for i in range(len(row["sizes"]) + 1)]
    seen = []

    def decompress(frame):
        seen.append(1)
        return zstandard.ZstdDecompressor().decompress(frame)

    stored = Text(FrameFile(str(tmp_path / "f"), row["file"]), row["n_bytes"], starts, row["lines"], row["chars"], 100, decompress)
    assert stored.after(500) == (len("".join(f"line {i}\n" for i in range(500))),) * 2 and len(seen) == 1


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    index = write_frames(none, str(tmp_path / "f"))
    assert fill_in_middle(index, str(tmp_path / "f")).count() == 0


def test_marks_across_pieces():
    whole = b"<<P>a<S<S>b<<M>c"
    for size in range(1, 9):
        pieces = [whole[i : i + size] for i in range(0, len(whole), size)]
        assert _places(pieces, (b"<P>", b"<S>", b"<M>")) == [1, 7, 12]
    with pytest.raises(ValueError):
        _places([b"<P>a<M>"], (b"<P>", b"<S>", b"<M>"))
