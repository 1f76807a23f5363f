"""Number the rows of a frame of any size, within keys and in an order, without a single task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .joins import fits_broadcast


def number_rows(rows: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Add the place of each row among those with the same keys, from 1.

    The rows are sorted over all tasks by keys and order and staged with their place in the partition. The number is
    that place plus what earlier partitions hold of the same keys, which takes one small row per partition and key.
    """
    by = [*[F.col(k) for k in keys], *order]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stage(ordered.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumn("_part", part).withColumn("_place", place)
    runs = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_from"))
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = runs.select(*keys, "_part", "_from", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    if fits_broadcast(offsets):
        offsets = F.broadcast(offsets)
    number = (F.col("_place") - F.col("_from") + F.col("_before") + 1).alias(name)
    return placed.join(offsets, [*keys, "_part"]).select(*rows.columns, number)
