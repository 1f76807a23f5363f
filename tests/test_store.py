import os

import pytest
from pyspark.sql import functions as F

from termloom import (
    add_documents,
    boolean_search,
    index_folder,
    keep_current,
    lay_out,
    open_index,
    read_text_folder,
    result_lines,
    stream_text_folder,
    vector_search,
    write_results,
)
from termloom.sources.documents import _passed_over, html_pages, page_documents, write_text_folder
from termloom.sources import documents, index_store
from termloom.sources.index_store import compact_loads, is_index, known_among, load_names


def contents(index):
    postings = sorted(map(tuple, index.postings.select("term", "doc_id", "tf", F.round("l_d", 9)).collect()))
    return postings, sorted(map(tuple, index.doc_stats.select("doc_id", F.round("l_d", 9)).collect()))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


ROWS = [(1, "storm wind storm"), (2, "rain and wind"), (3, ""), (4, "calm sea")]


def test_two_loads_equal_one(spark, tmp_path):
    add_documents(frame(spark, ROWS), str(tmp_path / "one"), "a")
    add_documents(frame(spark, ROWS[:2]), str(tmp_path / "two"), "a")
    add_documents(frame(spark, ROWS), str(tmp_path / "two"), "b", order_by="text")
    assert contents(open_index(spark, str(tmp_path / "one"))) == contents(open_index(spark, str(tmp_path / "two")))


def test_load_again_replaces(spark, tmp_path):
    path = str(tmp_path / "ix")
    assert not is_index(spark, path)
    add_documents(frame(spark, ROWS[:2]), path, "a")
    add_documents(frame(spark, ROWS), path, "b")
    before = contents(open_index(spark, path))
    add_documents(frame(spark, ROWS), path, "b")
    assert contents(open_index(spark, path)) == before
    add_documents(frame(spark, ROWS), path, "c")
    assert contents(open_index(spark, path)) == before


def test_broken_loads_are_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ix")
    add_documents(frame(spark, ROWS[:2]), path, "a")
    add_documents(frame(spark, ROWS[2:3]), path, "b")
    opened = open_index(spark, path)
    before = contents(opened)

    def broken(frames):
        index = index_frames(frames)
        failing = index.doc_stats.select("doc_id", F.raise_error(F.lit("lost")).cast("double").alias("l_d"))
        return index_store.Index(index.postings, failing)

    index_frames = index_store.index_frames
    monkeypatch.setattr(index_store, "index_frames", broken)
    for load in ("b", "c"):
        with pytest.raises(Exception, match="lost"):
            add_documents(frame(spark, ROWS), path, load)
        assert contents(open_index(spark, path)) == before and load_names(spark, path) == ["a", "b"]
    monkeypatch.setattr(index_store, "index_frames", index_frames)
    add_documents(frame(spark, ROWS), path, "b")
    # Who had opened the index before the load was run again still reads what was there then.
    assert contents(opened) == before
    assert len(contents(open_index(spark, path))[1]) == 4 and load_names(spark, path) == ["a", "b"]


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "ix")
    for number, row in enumerate(ROWS):
        add_documents(frame(spark, [row]), path, f"load-{number}")
    before, opened = contents(open_index(spark, path)), open_index(spark, path)
    compact_loads(spark, path, "all")
    assert load_names(spark, path) == ["all"] and contents(open_index(spark, path)) == before == contents(opened)
    add_documents(frame(spark, [(9, "new storm"), *ROWS]), path, "more")
    assert load_names(spark, path) == ["all", "more"] and open_index(spark, path).doc_stats.count() == len(ROWS) + 1


def test_known_documents_are_not_shuffled_for_a_small_batch(spark, tmp_path):
    path = str(tmp_path / "ix")
    add_documents(frame(spark, ROWS), path, "a")
    known = known_among(frame(spark, ROWS[:1]).select("doc_id"), open_index(spark, path).doc_stats)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_staged_counts_are_freed(spark, tmp_path):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    from termloom.session import shared_folder, staged

    with staged(frame(spark, ROWS), "kept-for-a-while") as held:
        assert held.count() == 4
    assert not [n for n in os.listdir(shared_folder(spark).removeprefix("file:")) if n.startswith("kept-for-a-while")]
    assert folder == spark.conf.get("spark.checkpoint.dir", None)


def test_repeated_ids_keep_the_first(spark, tmp_path):
    path = str(tmp_path / "ix")
    add_documents(frame(spark, [(1, "b later"), (1, "a first"), (1, "c last")] * 3), path, "a", order_by="text")
    assert {r["term"] for r in open_index(spark, path).postings.collect()} == {"first"}


def test_folder(spark, tmp_path):
    for folder, name, text in [("a", "x", "storm wind"), ("b", "x", "other"), ("b", "y", "wind"), (".", "z.html", "\n")]:
        os.makedirs(tmp_path / "in" / folder, exist_ok=True)
        (tmp_path / "in" / folder / name).write_text(text, encoding="utf-8")
    index = index_folder(spark, str(tmp_path / "in"), str(tmp_path / "ix"), "a")
    assert sorted(r["doc_id"] for r in index.doc_stats.collect()) == ["x", "y", "z.html"]
    assert "other" not in {r["term"] for r in index.postings.collect()}
    by_path = read_text_folder(spark, str(tmp_path / "in"), doc_id="path")
    assert by_path.select("doc_id").distinct().count() == 4
    (tmp_path / "in" / "bad").write_bytes(b"\xff\xfe\xfa")
    with pytest.raises(Exception, match="UTF8"):
        read_text_folder(spark, str(tmp_path / "in")).collect()


NAMES = ["a b.txt", "50%.txt", "a+b", "x#y?z", "κομήτης", "_x", ".x", "empty", "_empty", "100%25"]


@pytest.mark.parametrize("doc_id", ["basename", "path"])
def test_every_file_counts_under_its_own_name(spark, tmp_path, doc_id):
    folder = tmp_path / "in" / "sub folder" / "_hidden"
    folder.mkdir(parents=True)
    for place in (folder, tmp_path / "in"):
        for name in NAMES:
            (place / name).write_text("" if "empty" in name else f"storm {name}", encoding="utf-8")
    found = read_text_folder(spark, str(tmp_path / "in"), doc_id).collect()
    texts = sorted((r["doc_id"].rsplit("/", 1)[1] if doc_id == "path" else r["doc_id"], r["text"]) for r in found)
    assert texts == sorted(2 * [(n, "" if "empty" in n else f"storm {n}") for n in NAMES])
    assert len({r["path"] for r in found}) == len(found)
    assert index_folder(spark, str(tmp_path / "in"), str(tmp_path / "ix"), "a").doc_stats.count() == len(NAMES)


def test_folders_are_listed_many_at_a_time(spark, tmp_path, monkeypatch):
    for n in range(300):
        (tmp_path / "in" / f"{n % 3}" / f"d{n}").mkdir(parents=True)
        (tmp_path / "in" / f"{n % 3}" / f"d{n}" / ("_x" if n % 100 == 0 else "x")).write_text("" if n % 50 == 1 else "storm")
    client, sent = spark.sparkContext._gateway._gateway_client, []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda command, *a, **k: (sent.append(command), send(command, *a, **k))[1])
    found = sorted((path.split("/in/")[1], n) for path, n in _passed_over(spark, str(tmp_path / "in")))
    assert found == sorted([(f"{n % 3}/d{n}/_x", 5) for n in (0, 100, 200)] + [(f"{n % 3}/d{n}/x", 0) for n in range(1, 300, 50)])
    assert len(sent) < 300
    monkeypatch.setattr(documents, "LISTED", 7)
    assert sorted((path.split("/in/")[1], n) for path, n in _passed_over(spark, str(tmp_path / "in"))) == found


def test_text_folder_is_written_into_place(spark, tmp_path):
    rows = [(2, "b"), (1, "a"), (2, None), (None, "κ")]
    texts = spark.createDataFrame(rows, "page_id bigint, text string").coalesce(1)
    write_text_folder(texts, "page_id", str(tmp_path / "out"))
    files = {str(p.relative_to(tmp_path / "out")): p.read_text("utf-8") for p in (tmp_path / "out").rglob("*.*")}
    part = "part-00000.txt"
    assert files.pop(f"page_id=2/{part}") in ("b\n\n", "\nb\n")
    assert files == {f"page_id=1/{part}": "a\n", f"page_id=__HIVE_DEFAULT_PARTITION__/{part}": "κ\n"}
    write_text_folder(texts.limit(0), "page_id", str(tmp_path / "none"))
    assert read_text_folder(spark, str(tmp_path / "none")).count() == 0


def test_stemmed_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x").write_text("Hurricanes hurricane knives")
    index = index_folder(spark, str(tmp_path / "in"), str(tmp_path / "ix"), "a", stem=True)
    assert {r["term"]: r["tf"] for r in index.postings.collect()} == {"hurrican": 2, "knive": 1}
    assert boolean_search(index, "Hurricanes and knive", stem=True).count() == 1
    assert vector_search(index, "hurricanes", stem=True).count() == 1


def test_pages(spark):
    rows = [("http://a/1", None, "text/html; charset=utf-8", "<p>x"), ("http://a/2", "http://b/2", "TEXT/HTML", "<p>y"),
            ("http://a/3", None, "application/pdf", "z"), ("http://a/4", None, None, "w")]
    pages = spark.createDataFrame(rows, "url string, final_url string, content_type string, html string")
    assert html_pages(pages).count() == 2
    assert sorted((r["doc_id"], r["text"].strip()) for r in page_documents(pages).collect()) == [
        ("http://a/1", "x"), ("http://b/2", "y"),
    ]


def test_output(spark, tmp_path, english):
    found = vector_search(english, "katrina hurricane")
    assert [r["line"] for r in result_lines(found).collect()] == ["d3.txt,0.48", "d1.txt,0.33"]
    write_results(found, str(tmp_path / "out"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["d1.txt,0.33", "d3.txt,0.48"]
    assert result_lines(boolean_search(english, "typhoon"), boolean=True).first()["line"] == "d2.txt,1"
    exact = spark.createDataFrame([("a", 0.125), ("b", 2.675), ("c", 12345.5)], "doc_id string, score double")
    assert [r["line"] for r in result_lines(exact).collect()] == ["a,0.12", "b,2.67", "c,12345.50"]


def test_bucketed_layout(spark, tmp_path, english):
    laid = lay_out(english, "fixture", str(tmp_path / "tables"), buckets=4)
    assert contents(laid) == contents(english)
    counted = laid.postings.groupBy("doc_id").agg(F.sum("tf"))
    counted.collect()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "ix")
    source.mkdir()
    # An empty file is a document of a folder, but no stream sees it.
    for number, (doc, text) in enumerate([r for r in ROWS if r[1]] + [(1, "storm again")]):
        (source / f"{doc}-{number}").write_text(text)
    add_documents(read_text_folder(spark, str(source)), str(tmp_path / "batch"), "a", order_by="path")
    arriving = stream_text_folder(spark, str(source), files_per_batch=1)
    keep_current(arriving, path, str(tmp_path / "c1"), order_by="path").awaitTermination()
    before = contents(open_index(spark, path))
    assert before == contents(open_index(spark, str(tmp_path / "batch")))
    assert len(load_names(spark, path)) >= 3
    keep_current(arriving, path, str(tmp_path / "c2"), name="again", order_by="path").awaitTermination()
    assert contents(open_index(spark, path)) == before
    (source / "new").write_text("rain")
    keep_current(arriving, path, str(tmp_path / "c1"), order_by="path").awaitTermination()
    assert len(contents(open_index(spark, path))[1]) == len(before[1]) + 1
