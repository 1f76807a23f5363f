"""Joins that stay balanced: a broadcast only below a checked size, hot keys cut into cells beyond it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
BROADCAST_CHARS = 64 * 1024 * 1024
# At most this many keys can each hold more than 1/HOT_SHARE of all rows, which bounds the broadcast list of hot keys.
HOT_SHARE = 10_000
MIN_CELL_ROWS = 100_000
# Pairs that one cell of a table may make when each of its rows is to meet all rows of a second one.
PAIRS_PER_CELL = 4_000_000
# Bytes of text, and rows of counts or postings, that one task is to hold while it counts or sorts them.
TASK_TEXT = 8 * 1024 * 1024
TASK_ROWS = 1_000_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, chars: int = BROADCAST_CHARS) -> bool:
    """Run one aggregate to see whether a frame is small enough to broadcast (rows, and length of its strings)."""
    strings = [c for c, t in df.dtypes if t == "string"]
    length = sum((F.coalesce(F.length(c), F.lit(0)) for c in strings), F.lit(0)).cast("bigint")
    size = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(length), F.lit(0)).alias("chars")).first()
    return size["n"] <= rows and size["chars"] <= chars


def tasks_for(df: DataFrame, text: str | None = None) -> int:
    """Into how many partitions to deal a frame so that a task's memory does not follow the input.

    Counted by one aggregate: bytes of the column ``text``, or rows. At least as many as there are cores.
    """
    size, each = (F.count("*"), TASK_ROWS) if text is None else (F.sum(F.octet_length(text)), TASK_TEXT)
    total = df.agg(F.coalesce(size, F.lit(0)).alias("size")).first()["size"]
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-int(total) // each))


def hot_keys(
    df: DataFrame, key: str, cells: str, min_cell_rows: int | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Keys with too many rows for one task, and into how many cells each is to be cut.

    ``counts(key, _rows)`` saves counting the rows when that is known already.
    """
    if counts is None:
        counts = df.groupBy(key).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("_total")).scalar()
    limit = F.greatest(F.lit(min_cell_rows or MIN_CELL_ROWS), F.ceil(total / F.lit(HOT_SHARE)))
    return counts.filter(F.col("_rows") > limit).select(key, F.ceil(F.col("_rows") / limit).cast("int").alias(cells))


def _cell_of(row_id: list[Column], cells: Column) -> Column:
    return F.when(cells.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*row_id), cells).cast("int"))


def _every_cell(cells: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(cells, F.lit(1)) - 1))


def join_hot(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_id: list[str],
    right_id: list[str] | None = None,
    min_cell_rows: int | None = None,
    left_counts: DataFrame | None = None,
) -> DataFrame:
    """Inner equi-join in which hot keys are cut into cells on both sides.

    A hot key of the left side is spread over cells by a hash of ``left_id`` and the matching right rows are repeated
    once per cell, and the other way round, so that each pair of rows still meets exactly once. Leave ``right_id``
    out when the key is unique on the right.
    """
    left_hot = F.broadcast(hot_keys(left, key, "_left_cells", min_cell_rows, left_counts))
    left = left.join(left_hot, key, "left")
    right = right.join(left_hot, key, "left")
    left = left.withColumn("_left_cell", _cell_of([F.col(c) for c in left_id], F.col("_left_cells")))
    right = right.withColumn("_left_cell", _every_cell(F.col("_left_cells")))
    on = [key, "_left_cell"]
    if right_id is not None:
        right_hot = F.broadcast(hot_keys(right.drop("_left_cell", "_left_cells"), key, "_right_cells", min_cell_rows))
        left = left.join(right_hot, key, "left").withColumn("_right_cell", _every_cell(F.col("_right_cells")))
        right = right.join(right_hot, key, "left").withColumn(
            "_right_cell", _cell_of([F.col(c) for c in right_id], F.col("_right_cells"))
        )
        on.append("_right_cell")
    return left.drop("_left_cells", "_right_cells").join(right.drop("_left_cells", "_right_cells"), on).drop(*on[1:])


def join_small_or_hot(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_id: list[str],
    right_id: list[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Broadcast ``right`` when it is small (``small``, else measured); cut hot keys into cells when it is not."""
    if small is None:
        small = fits_broadcast(right)
    return left.join(F.broadcast(right), key) if small else join_hot(left, right, key, left_id, right_id)


def pair_all(rows: DataFrame, queries: DataFrame, row_id: str) -> DataFrame:
    """Each row with each of a set of queries, for results that hold nearly all of them anyway.

    The rows are dealt into cells by a hash of ``row_id``, the queries are repeated once per cell, and both meet on the
    cell: no task makes many more than ``PAIRS_PER_CELL`` pairs, and the queries are broadcast only if small.
    """
    cells = max(1, -(-rows.count() * queries.count() // PAIRS_PER_CELL))
    dealt = rows.withColumn("_cell", F.pmod(F.xxhash64(row_id), F.lit(cells)).cast("int"))
    repeated = queries.withColumn("_cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    small = fits_broadcast(queries, rows=BROADCAST_ROWS // cells, chars=BROADCAST_CHARS // cells)
    return dealt.join(F.broadcast(repeated) if small else repeated, "_cell").drop("_cell")
