"""The stored index: Parquet, one folder per load, plus layouts for lookup and a text sink for results."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..index import Index
from ..operators.counts import index_frames, term_counts, with_norms
from ..operators.joins import fits_broadcast, tasks_for
from ..session import delete_folder, staged
from .documents import decoded, first_per_document, new_documents

# Rows of postings that one bucket of a layout should hold.
BUCKET_ROWS = 2_000_000
# Parquet writes a Bloom filter of the terms of each row group, of a size that fits them: a lookup passes over row groups
# that lie around a term without holding it, which are most of them when an index has many loads.
TERM_FILTER = {
    "parquet.bloom.filter.enabled#term": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.candidates.number#term": "8",
}


MANIFEST = (
    "load string, folder string, version bigint, replaces array<string>, n_docs bigint, retired bigint, snapshot bigint"
)
# So many loads of one size class are merged into one, which is then of the next class.
FAN = 8
# So many entries of the manifest are summed up in a snapshot; what nobody lists any more is deleted after so long.
SNAPSHOT_ENTRIES = 16
GRACE_SECONDS = 3600.0


@dataclass
class _Listing:
    """What a manifest says: the loads that count, oldest first, folders that no longer do and since when, its files."""

    live: list[Row]
    retired: dict[str, int]
    entries: list[Row]
    latest_snapshot: int


def _listing(spark: SparkSession, path: str) -> _Listing:
    """Read the manifest.

    An entry makes a load count; of entries of one load the latest does, unless a later one replaces the load. A
    snapshot states all of that in one file, and names the entries that went into it, which are then passed over.
    """
    found = spark.read.schema(MANIFEST).parquet(f"{path}/manifest") if _exists(spark, f"{path}/manifest") else None
    rows = found.select("*", decoded("_metadata.file_path").alias("file_path"), "_metadata.file_modification_time").collect() if found is not None else []
    snapshot = max((r["snapshot"] for r in rows if r["snapshot"] is not None), default=-1)
    base = [r for r in rows if r["snapshot"] == snapshot]
    summed_up = {folder for r in base if r["folder"] is None for folder in r["replaces"]}
    retired = {r["folder"]: r["retired"] for r in base if r["retired"] is not None}
    news = [r for r in rows if r["snapshot"] is None and r["folder"] not in summed_up]
    known = [r for r in base if r["folder"] is not None and r["retired"] is None] + news
    latest: dict[str, Row] = {}
    for row in sorted(known, key=lambda r: (r["version"], r["folder"])):
        if row["load"] in latest:
            retired[latest[row["load"]]["folder"]] = row["version"]
        latest[row["load"]] = row
    gone = {load: row["version"] for row in sorted(latest.values(), key=lambda r: r["version"]) for load in row["replaces"]}
    live = []
    for row in sorted(latest.values(), key=lambda r: r["version"]):
        if row["version"] > gone.get(row["load"], -1):
            live.append(row)
        else:
            retired[row["folder"]] = gone[row["load"]]
    return _Listing(live, retired, rows, snapshot)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def _append(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def write_load(spark: SparkSession, index: Index, path: str, load: str, replaces: list[str] | None = None) -> None:
    """Write one load into a folder of its own. It counts, as a whole, from the moment its manifest entry is there.

    Running it again under the same name writes another folder, which takes the place of the first one then: readers
    see the old load or the new one, never parts. Postings are laid out by term and document, so that row groups of
    other terms are skipped and a frequent term is spread over many files.
    """
    folder = f"{path}/loads/{uuid.uuid4().hex}"
    postings = index.postings.repartitionByRange(tasks_for(index.postings), "term", "doc_id")
    postings = postings.sortWithinPartitions("term", "doc_id")
    postings.write.options(**TERM_FILTER).parquet(f"{folder}/postings")
    index.doc_stats.write.parquet(f"{folder}/doc_stats")
    n_docs = spark.read.schema(index.doc_stats.schema).parquet(f"{folder}/doc_stats").count()
    _append(spark, path, [(load, folder, time.time_ns(), replaces or [], n_docs, None, None)])


def is_index(spark: SparkSession, path: str) -> bool:
    """True once a first load is there."""
    return bool(_listing(spark, path).live)


def load_names(spark: SparkSession, path: str) -> list[str]:
    """The loads that count, oldest first."""
    return [row["load"] for row in _listing(spark, path).live]


def _open(spark: SparkSession, folders: list[str]) -> Index:
    return Index(
        postings=spark.read.parquet(*[f"{f}/postings" for f in folders]).select("term", "doc_id", "tf", "l_d"),
        doc_stats=spark.read.parquet(*[f"{f}/doc_stats" for f in folders]).select("doc_id", "l_d"),
    )


def open_index(spark: SparkSession, path: str, without_load: str | None = None) -> Index:
    """Open a stored index as its manifest lists it now."""
    folders = [row["folder"] for row in _listing(spark, path).live if row["load"] != without_load]
    if not folders:
        raise FileNotFoundError(f"no index at {path}")
    return _open(spark, folders)


def compact_loads(spark: SparkSession, path: str, load: str) -> None:
    """Merge all loads into one named ``load``: few large files again after many small ones.

    The old folders stay for readers that opened them before; :func:`tidy_index` deletes them after a while.
    """
    names = load_names(spark, path)
    if len(names) > 1:
        write_load(spark, open_index(spark, path), path, load, replaces=[n for n in names if n != load])


def loads_to_merge(sizes: list[tuple[str | int, int]], fan: int = FAN) -> list[str | int]:
    """Of loads ``(name, documents)`` those to merge next: all of the smallest size class that has ``fan`` of them.

    Classes are powers of ``fan``, so a document is rewritten once per class at most, and of n loads of like size
    fewer than ``fan`` per class stay, a number that grows with the logarithm of n.
    """
    classes: dict[int, list[str | int]] = {}
    for name, n_docs in sizes:
        size, number = 1, 0
        while size * fan <= n_docs:
            size, number = size * fan, number + 1
        classes.setdefault(number, []).append(name)
    return next((classes[c] for c in sorted(classes) if len(classes[c]) >= fan), [])


def merge_loads(spark: SparkSession, path: str, fan: int = FAN) -> None:
    """Merge loads of like size until every size class holds fewer than ``fan``; readers notice nothing.

    Where a merged load is at once merged with others, all of them are written once, not load by load.
    """
    if fan < 2:
        raise ValueError("fan must be at least 2")
    live = _listing(spark, path).live
    # A load that is not written yet goes by a number here; it holds the documents of those it is made of.
    sizes: dict[str | int, int] = {r["load"]: r["n_docs"] or 0 for r in live}
    made_of: dict[str | int, set[str]] = {r["load"]: {r["load"]} for r in live}
    while some := loads_to_merge(list(sizes.items()), fan):
        number = len(made_of)
        made_of[number] = set().union(*[made_of[name] for name in some])
        sizes[number] = sum(sizes.pop(name) for name in some)
    for names in [made_of[name] for name in sizes if len(made_of[name]) > 1]:
        merged = _open(spark, [r["folder"] for r in live if r["load"] in names])
        write_load(spark, merged, path, f"merged-{uuid.uuid4().hex}", replaces=sorted(names))


def tidy_index(spark: SparkSession, path: str, grace_seconds: float = GRACE_SECONDS, entries: int = SNAPSHOT_ENTRIES) -> None:
    """Keep the manifest short and delete what nobody lists any more.

    Once ``entries`` entries have come together they are summed up in a snapshot. Manifest files that a snapshot has
    summed up, folders of loads that were replaced, and folders that no entry ever named (of a load that broke off) go
    when they are older than ``grace_seconds``, which must exceed the time that a reader stays open and a load takes.
    """
    found, now = _listing(spark, path), time.time_ns()
    horizon = now - int(grace_seconds * 1e9)
    expired = {folder for folder, since in found.retired.items() if since <= horizon}
    base = [r for r in found.entries if r["snapshot"] == found.latest_snapshot]
    summed_up = {folder for r in base if r["folder"] is None for folder in r["replaces"]}
    files: dict[str, list[Row]] = {}
    for row in found.entries:
        files.setdefault(row["file_path"], []).append(row)
    for file, rows in files.items():
        passed = all(r["folder"] in summed_up if r["snapshot"] is None else r["snapshot"] < found.latest_snapshot for r in rows)
        if passed and rows[0]["file_modification_time"].timestamp() * 1e9 <= horizon:
            delete_folder(spark, file)
            found.entries = [r for r in found.entries if r["file_path"] != file]
    plain = [r["folder"] for r in found.entries if r["snapshot"] is None]
    if len(set(plain) - summed_up) >= entries or expired:
        rows = [(r["load"], r["folder"], r["version"], [], r["n_docs"], None, now) for r in found.live]
        rows += [(None, f, None, [], None, since, now) for f, since in found.retired.items() if f not in expired]
        _append(spark, path, [*rows, (None, None, None, plain, None, None, now)])
    listed = {r["folder"] for r in found.live} | (set(found.retired) - expired)
    for folder, changed in _load_folders(spark, path):
        if not any(folder == f.rsplit("/", 1)[1] for f in listed) and changed * 1_000_000 <= horizon:
            delete_folder(spark, f"{path}/loads/{folder}")


def _load_folders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names of the folders of loads, and when each last changed, in milliseconds."""
    if not _exists(spark, f"{path}/loads"):
        return []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/loads")
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in system.listStatus(hadoop):
        inside = [s.getModificationTime() for s in system.listStatus(status.getPath())] if status.isDirectory() else []
        found.append((status.getPath().getName(), max([status.getModificationTime(), *inside])))
    return found


def known_among(ids: DataFrame, doc_stats: DataFrame) -> DataFrame:
    """``doc_id`` of the rows of ``doc_stats`` that are among ``ids(doc_id)``; a small batch is brought to the table."""
    ids = F.broadcast(ids) if fits_broadcast(ids) else ids
    return doc_stats.select("doc_id").join(ids, "doc_id", "left_semi")


def add_documents(docs: DataFrame, path: str, load: str, order_by: str | None = None, **options) -> None:
    """Index documents end to end: skip known ids, count, weigh, append as one load.

    ``order_by`` picks among rows that share an id (leave it out when ids are unique in the source). The counted
    texts are staged while postings, the sampling of their ranges and the norms are read from there. Documents of the
    same load do not count as known, so a load that broke off can be repeated. The table of known documents is
    reduced to the ids of this load first, so a small load costs no shuffle of it.
    """
    spark = docs.sparkSession
    columns = ["doc_id", "text"] + ([order_by] if order_by not in (None, "doc_id", "text") else [])
    docs = docs.select(*columns)
    if order_by is not None:
        docs = first_per_document(docs, order_by)
    if any(name != load for name in load_names(spark, path)):
        known = open_index(spark, path, without_load=load).doc_stats
        with staged(docs.select("doc_id").distinct(), "batch-ids") as ids:
            # Staged, so that texts are not shuffled to be compared with a few known ids, or with none.
            with staged(known_among(ids, known), "known-ids") as found:
                found = F.broadcast(found) if fits_broadcast(found) else found
                _count_and_write(spark, new_documents(docs, found), path, load, options)
    else:
        _count_and_write(spark, docs, path, load, options)


def _count_and_write(spark: SparkSession, docs: DataFrame, path: str, load: str, options: dict) -> None:
    with staged(with_norms(term_counts(docs, keep_empty=True, **options)), "counted") as counted:
        write_load(spark, index_frames(counted), path, load)


def lay_out(index: Index, name: str, path: str, buckets: int | None = None) -> Index:
    """Rewrite an index as two bucketed tables, ``<name>_postings`` and ``<name>_doc_stats``.

    Without ``buckets`` their number follows the postings: one for every ``BUCKET_ROWS`` of them, 8 at least.

    Both are bucketed by document, so scoring, flags per document and joins with ``doc_stats`` aggregate without an
    exchange and no bucket grows with the frequency of a term. Inside its bucket each file is sorted by term, so that
    the row groups of other terms are skipped.
    """
    if buckets is None:
        buckets = max(8, -(-index.postings.count() // BUCKET_ROWS))
    postings = index.postings.repartition(buckets, "doc_id")
    for frame, table, order in (
        (postings, "postings", ["term", "doc_id"]),
        (index.doc_stats.repartition(buckets, "doc_id"), "doc_stats", ["doc_id"]),
    ):
        (
            frame.write.mode("overwrite")
            .options(**(TERM_FILTER if table == "postings" else {}))
            .bucketBy(buckets, "doc_id")
            .sortBy(*order)
            .option("path", f"{path}/{table}")
            .saveAsTable(f"{name}_{table}")
        )
    return open_tables(index.spark, name)


def open_tables(spark: SparkSession, name: str) -> Index:
    """Open an index laid out by :func:`lay_out`."""
    return Index(spark.table(f"{name}_postings"), spark.table(f"{name}_doc_stats"))


def result_lines(results: DataFrame, boolean: bool = False) -> DataFrame:
    """Results as printed: ``doc,score`` with two decimals (half to even), or the integer score of a boolean query."""
    if boolean:
        score = F.col("score").cast("bigint").cast("string")
    else:
        score = F.call_function("format_number", F.col("score"), F.lit("0.00"))
    return results.select(F.concat_ws(",", F.col("doc_id").cast("string"), score).alias("line"))


def write_results(results: DataFrame, path: str, boolean: bool = False) -> None:
    """Write results as text lines, best first as far as the frame is ordered."""
    result_lines(results, boolean).write.text(path)
