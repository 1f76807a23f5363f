"""Exact top-k search over vectors: refine histograms of all scores until every query's k-th score is known."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import new_path
from .files import open_folder

SCALE = 64
BIN_BITS = 7
# Candidates that a task holds at a time, queries read at a time, and scores computed at a time.
CHUNK_VECTORS, BLOCK_QUERIES, TILE_SCORES = 1 << 15, 1 << 11, 1 << 21
LONG = 1 << 63

STATE = "query_id bigint, vector array<bigint>, low bigint, above bigint"


def whole_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector`` of ``table(vec_id, embedding)``: each component x as floor(scale * x).

    Rows without an id, and vectors that are null or hold a null, infinite or undefined component, are left out.
    """
    x = F.col("embedding").cast("array<double>")
    real = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & real)
    return kept.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform(x, lambda v: F.floor(v * scale).cast("bigint")).alias("vector"),
    )


def _norm(vector: str) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))


@dataclass(frozen=True)
class Exact:
    """The number type in which the scores of two sets of vectors are exact, by a bound on their size."""

    bound: int

    @property
    def kind(self) -> type:
        # Whole numbers below these sizes are exact in floating point, sums of products on their way too.
        return np.float32 if self.bound < 1 << 24 else np.float64 if self.bound < 1 << 53 else np.int64

    @property
    def range_bits(self) -> int:
        """Width of the range of all scores, from -bound to bound, as a power of two."""
        return (2 * self.bound + 1).bit_length()


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a column of lists without nulls."""
    offsets = column.offsets.to_numpy()
    return np.diff(offsets), column.values.to_numpy()[offsets[0] : offsets[-1]]


def _by_length(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and matrix of the vectors of each length; only vectors of equal length have a score."""
    lengths, values = _lists(lists)
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, values[starts[at][:, None] + np.arange(n)]


@dataclass
class _Block:
    """Queries of one length, the low end of the range that holds their k-th score, and how many are above the range."""

    ids: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    above: np.ndarray


def _blocks(folder: str) -> Iterator[_Block]:
    """The stored queries, a block at a time."""
    fs, path = open_folder(folder)
    files = [f.path for f in fs.get_file_info(pa.fs.FileSelector(path)) if f.path.endswith(".parquet")]
    stored = pyarrow.dataset.dataset(sorted(files), filesystem=fs, format="parquet")
    for batch in stored.to_batches(batch_size=BLOCK_QUERIES, batch_readahead=1, fragment_readahead=1, use_threads=False):
        ids, low, above = (batch.column(c).to_numpy() for c in ("query_id", "low", "above"))
        for at, matrix in _by_length(batch.column("vector")):
            yield _Block(ids[at], matrix, low[at], above[at])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Candidates of a task, up to ``CHUNK_VECTORS`` at a time, by length, each with ids in ascending order."""

    def cut(held: list[pa.RecordBatch]) -> list[tuple[np.ndarray, np.ndarray]]:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, vectors = table.column(0).to_numpy(), table.column(1).combine_chunks()
        parts = []
        for at, matrix in _by_length(vectors):
            order = np.argsort(ids[at], kind="stable")
            parts.append((ids[at][order], matrix[order]))
        return parts

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= CHUNK_VECTORS:
            yield cut(held)
            held, n = [], 0
    if n:
        yield cut(held)


def _scores(folder: str, parts: list[tuple[np.ndarray, np.ndarray]], exact: Exact):
    """Scores of all stored queries with the candidates of a chunk, some queries at a time: block, ids, scores.

    A score is a whole number in the type of ``exact``; a candidate that is the query itself has the least one.
    """
    ready = {m.shape[1]: (ids, np.ascontiguousarray(m.T.astype(exact.kind))) for ids, m in parts}
    whole = np.int32 if exact.bound < 1 << 30 else np.int64
    for block in _blocks(folder):
        if block.vectors.shape[1] not in ready:
            continue
        ids, matrix = ready[block.vectors.shape[1]]
        step = max(1, TILE_SCORES // len(ids))
        for start in range(0, len(block.ids), step):
            part = slice(start, start + step)
            tile = _Block(*(a[part] for a in (block.ids, block.vectors, block.low, block.above)))
            scores = (tile.vectors.astype(exact.kind) @ matrix).astype(whole)
            first, last = np.searchsorted(ids, tile.ids), np.searchsorted(ids, tile.ids, "right")
            for row in np.flatnonzero(last > first):
                scores[row, first[row] : last[row]] = np.iinfo(whole).min
            yield tile, ids, scores


def _histogram(tile: _Block, scores: np.ndarray, bits: int, first: bool, k: int) -> tuple[np.ndarray, ...]:
    """Row, bin and count of the scores in each query's range of 2**bits values from its low end on.

    Bins that have k better scores in this chunk are left out: the k-th score of all chunks is not in them.
    """
    bins, shift = 1 << min(bits, BIN_BITS), max(0, bits - BIN_BITS)
    if first:
        # Every score but the query's own lies in the range.
        slots = ((scores.astype(np.int64) - tile.low[:, None]) >> shift).clip(-1, bins - 1) + 1
        slots += np.arange(len(slots))[:, None] * (bins + 1)
        counts = np.bincount(slots.ravel(), minlength=len(slots) * (bins + 1)).reshape(len(slots), bins + 1)[:, 1:]
    else:
        rows, columns = np.nonzero(scores >= tile.low.astype(scores.dtype)[:, None])
        slots = (scores[rows, columns].astype(np.int64) - tile.low[rows]) >> shift
        rows, slots = rows[slots < bins], slots[slots < bins]
        counts = np.bincount(rows * bins + slots, minlength=len(scores) * bins).reshape(len(scores), bins)
    better = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
    rows, slots = np.nonzero((counts > 0) & (better < (k - tile.above)[:, None]))
    return rows, slots, counts[rows, slots]


def _count(vectors: DataFrame, folder: str, exact: Exact, bits: int, k: int) -> DataFrame:
    """``query_id, bin, n``: the scores of all pairs, counted in the bins of each query."""
    first = bits == exact.range_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _chunks(batches):
            for tile, _, scores in _scores(folder, parts, exact):
                rows, bins, counts = _histogram(tile, scores, bits, first, k)
                columns = [pa.array(tile.ids[rows]), pa.array(bins.astype(np.int32)), pa.array(counts.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "bin", "n"])

    return vectors.mapInArrow(count, "query_id bigint, bin int, n bigint").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))


def _refined(state: DataFrame, counted: DataFrame, bits: int, k: int) -> DataFrame:
    """The state after a pass: for every query the bin that holds its k-th score takes the place of its range.

    A query with fewer than k candidates keeps its low end, and all its scores lie above it.
    """
    shift = max(0, bits - BIN_BITS)
    down = W.partitionBy("query_id").orderBy(F.desc("bin"))
    found = counted.withColumn("so_far", F.sum("n").over(down)).join(state.select("query_id", "above"), "query_id")
    need = F.lit(k) - F.col("above")
    holds = found.filter((F.col("so_far") >= need) & (F.col("so_far") - F.col("n") < need))
    holds = holds.select("query_id", "bin", (F.col("above") + F.col("so_far") - F.col("n")).alias("now_above"))
    low = F.col("low") + F.shiftleft(F.coalesce("bin", F.lit(0)).cast("bigint"), shift)
    above = F.coalesce("now_above", "above").alias("above")
    return state.join(holds, "query_id", "left").select("query_id", "vector", low.alias("low"), above)


def _select(vectors: DataFrame, folder: str, exact: Exact, k: int) -> DataFrame:
    """``query_id, vec_id, score`` of every score above the k-th of its query, and of equal ones the first by id."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _chunks(batches):
            for tile, ids, scores in _scores(folder, parts, exact):
                rows, columns = np.nonzero(scores >= tile.low.astype(scores.dtype)[:, None])
                found = scores[rows, columns].astype(np.int64)
                tied = found == tile.low[rows]
                # Candidates come by id, so the first of the ties in a chunk are those with the smallest ids.
                ties = np.bincount(rows[tied], minlength=len(scores))
                place = np.cumsum(tied) - (np.cumsum(ties) - ties)[rows]
                keep = ~tied | (place <= k - tile.above[rows])
                columns = [pa.array(tile.ids[rows[keep]]), pa.array(ids[columns[keep]]), pa.array(found[keep])]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return vectors.mapInArrow(select, "query_id bigint, vec_id bigint, score bigint")


def _write(state: DataFrame, spark: SparkSession) -> str:
    path = new_path(spark, "top-k-queries")
    state.write.parquet(path)
    return path


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k candidates of the highest inner product, ties by id.

    ``vectors(vec_id, vector)`` and ``queries(query_id, vector)`` hold whole numbers, as from :func:`whole_vectors`.
    A candidate with the id of a query is the query's own and left out; only vectors of the same length have a score.

    All queries are scored with all candidates in each pass: tasks hold a chunk of candidates and read the queries
    block by block from the shared folder, so memory depends on neither number. A pass counts the scores of every
    query in 128 bins between the ends of its range, Spark adds the counts of all tasks up, and the bin with the k-th
    score is the next range, until bins are one wide. The last pass takes the scores above the k-th, and as many of the
    equal ones as are missing, by id. What is shuffled follows the queries and tasks, not the pairs.

    Queries that share an id count as one, by the least of their vectors. Repeated candidates are a result each. Scores
    must fit 64 bits, else this is an error. Without queries or candidates there are no rows.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = vectors.sparkSession
    queries = queries.groupBy("query_id").agg(F.min("vector").alias("vector"))
    longest = vectors.agg(F.max(_norm("vector"))).first()[0]
    widest = queries.agg(F.max(_norm("vector"))).first()[0]
    if longest is None or widest is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    exact = Exact(int(longest * widest * (1 + 1e-9)) + 1)
    if exact.bound >= LONG // 4:
        raise OverflowError("scores of these vectors go beyond 64 bits")
    low, above = F.lit(-exact.bound).cast("bigint"), F.lit(0).cast("bigint")
    folder = _write(queries.select("query_id", "vector", low.alias("low"), above.alias("above")), spark)
    bits = exact.range_bits
    while bits:
        state = spark.read.schema(STATE).parquet(folder)
        folder = _write(_refined(state, _count(vectors, folder, exact, bits, k), bits, k), spark)
        bits = max(0, bits - BIN_BITS)
    found = _select(vectors, folder, exact, k)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_vectors(table: DataFrame, query: Column, k: int = 20, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of ``table(vec_id, embedding)`` for its rows where ``query``.

    Components count as floor(scale * x). Rows with a null id, and vectors that are null or hold null or non-finite
    components, take no part; vectors of other lengths than a query's are not its candidates, and an empty vector
    scores 0 with empty ones. Ties go to the smaller id. Rows that repeat an id: see :func:`top_k`. An empty table
    gives no rows; other columns are left alone whatever their names.
    """
    vectors = whole_vectors(table.select("vec_id", "embedding"), scale)
    asked = whole_vectors(table.filter(query).select("vec_id", "embedding"), scale)
    return top_k(vectors, asked.withColumnRenamed("vec_id", "query_id"), k)
