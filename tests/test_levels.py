"""Levels of loads, snapshots of the manifest, and the deletion of what nobody lists."""

import os

import pytest

from termloom import add_documents, merge_loads, open_index, tidy_index
from termloom.sources import index_store
from termloom.sources.index_store import load_names, loads_to_merge
from termloom.streaming.upkeep import keep_current


def contents(index):
    return sorted(map(tuple, index.postings.collect())), sorted(map(tuple, index.doc_stats.collect()))


def add(spark, path, number, ids=None):
    rows = [(i, f"storm w{i} rain") for i in (ids if ids is not None else [number])]
    add_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), path, f"load-{number}")


@pytest.mark.parametrize("fan,n", [(2, 200), (4, 200), (8, 5000)])
def test_loads_grow_with_the_logarithm(fan, n):
    loads, rewritten, most = [], 0, 0
    for number in range(n):
        loads.append((f"b{number}", 100 + number % 7))
        while names := set(loads_to_merge(loads, fan)):
            size = sum(s for name, s in loads if name in names)
            loads = [x for x in loads if x[0] not in names] + [(f"m{number}-{size}", size)]
            rewritten += size
        most = max(most, len(loads))
    classes = 2
    while fan**classes < 110 * n:
        classes += 1
    assert sum(s for _, s in loads) == sum(100 + k % 7 for k in range(n))
    assert most <= (fan - 1) * classes and rewritten <= 110 * n * classes


def test_classes():
    assert loads_to_merge([("a", 0), ("b", 1), ("c", 9)], 2) == ["a", "b"]
    assert loads_to_merge([("a", 8), ("b", 9), ("c", 1)], 2) == ["a", "b"]
    assert loads_to_merge([("a", 8), ("b", 90), ("c", 1)], 2) == [] and loads_to_merge([]) == []


def test_merging_changes_nothing_and_open_readers_stay(spark, tmp_path):
    path = str(tmp_path / "ix")
    readers = []
    for number in range(7):
        add(spark, path, number)
        readers.append((number + 1, open_index(spark, path)))
        merge_loads(spark, path, fan=3)
        tidy_index(spark, path, entries=3)
    assert len(load_names(spark, path)) <= 3
    for n, index in readers:
        assert sorted(r["doc_id"] for r in index.doc_stats.collect()) == list(range(n))
    whole = str(tmp_path / "whole")
    add(spark, whole, 0, ids=range(7))
    assert contents(open_index(spark, path)) == contents(open_index(spark, whole))
    # A load that is run again after it was merged finds all of its documents known.
    add(spark, path, 2)
    assert contents(open_index(spark, path)) == contents(open_index(spark, whole))
    with pytest.raises(ValueError):
        merge_loads(spark, path, fan=1)


def test_tidying(spark, tmp_path):
    path = str(tmp_path / "ix")
    for number in range(5):
        add(spark, path, number)
        merge_loads(spark, path, fan=2)
    before, names = contents(open_index(spark, path)), load_names(spark, path)
    folders = lambda: set(os.listdir(f"{path}/loads"))
    files = lambda: [f for f in os.listdir(f"{path}/manifest") if f.endswith(".parquet")]
    n_files, all_folders = len(files()), folders()
    os.mkdir(f"{path}/loads/broken-off")
    tidy_index(spark, path, grace_seconds=3600, entries=100)
    assert len(files()) == n_files and folders() == all_folders | {"broken-off"}
    # A snapshot is written, nothing is old enough to go.
    tidy_index(spark, path, grace_seconds=3600, entries=2)
    assert len(files()) == n_files + 1 and folders() == all_folders | {"broken-off"}
    assert load_names(spark, path) == names and contents(open_index(spark, path)) == before
    # Everything is old enough: replaced folders go, then what the snapshots summed up.
    tidy_index(spark, path, grace_seconds=0, entries=2)
    assert len(folders()) == len(names) and load_names(spark, path) == names
    tidy_index(spark, path, grace_seconds=0, entries=2)
    assert len(files()) <= 2 and load_names(spark, path) == names and contents(open_index(spark, path)) == before
    add(spark, path, 9)
    assert len(load_names(spark, path)) == len(names) + 1


def test_entries_that_a_snapshot_did_not_see_count(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ix")
    add(spark, path, 0)
    add(spark, path, 1)
    append, late = index_store._append, []

    def slow_append(spark, path, rows):
        # Another writer's load comes in while a snapshot is being written.
        if not late:
            late.append(1)
            add(spark, path, 2)
        append(spark, path, rows)

    monkeypatch.setattr(index_store, "_append", slow_append)
    late.clear()
    tidy_index(spark, path, entries=2)
    monkeypatch.setattr(index_store, "_append", append)
    assert sorted(load_names(spark, path)) == ["load-0", "load-1", "load-2"]
    tidy_index(spark, path, grace_seconds=0, entries=1)
    tidy_index(spark, path, grace_seconds=0, entries=1)
    assert sorted(load_names(spark, path)) == ["load-0", "load-1", "load-2"]


def test_stream_keeps_few_loads(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "ix")
    for number in range(9):
        rows = [(number, f"storm w{number}"), (0, "again")] if number else [(0, "first")]
        spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema("doc_id bigint, text string").option("maxFilesPerTrigger", 1).parquet(source)
    keep_current(stream(), path, str(tmp_path / "c"), fan=2, grace_seconds=3600).awaitTermination()
    before = contents(open_index(spark, path))
    assert sorted(r[0] for r in before[1]) == list(range(9)) and len(load_names(spark, path)) <= 4
    keep_current(stream(), path, str(tmp_path / "again"), name="again", fan=2).awaitTermination()
    assert contents(open_index(spark, path)) == before
