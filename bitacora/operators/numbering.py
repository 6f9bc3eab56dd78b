"""Consecutive numbers in a global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitacora.storage import Workspace

# Low bits of a monotonically increasing id: the position inside the partition.
_IN_PARTITION = (1 << 33) - 1


def number_rows(df: DataFrame, order: str, number: str, ws: Workspace) -> DataFrame:
    """Adds ``number``, 1 for the row with the smallest ``order`` and so on.

    ``order`` is unique.  Rows are sorted by range partitioning and numbered
    inside each partition; the offset of a partition is the row count of those
    before it.  The ranges come from a sample, so the placed rows are written
    once: counts and numbers then refer to the same ranges.
    """
    placed, _ = ws.stage(
        df.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)))
    )
    # One row per partition, so this window and this broadcast stay small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(number, F.col("_before") + F.col("_at") + 1)
        .drop("_part", "_at", "_before")
    )
