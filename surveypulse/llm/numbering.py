"""Dense numbers in order, without a task that sees a whole group.

Rows are dealt by ranges of (group, order) and sorted inside each range, so a range holds a stretch of
each of its groups. One row per group and range counts them; their running sum turns places in a range
into places in the group. A group of any size spreads over ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveypulse.llm.common import written
from surveypulse.operators.joins import join_sized


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``index`` (long, from 0 in its group, ascending in ``order``, nulls first) and ``n``
    (rows of the group). ``rows`` is scanned twice, once for the ranges; give a written table. Rows equal
    in ``order`` get consecutive numbers in some order. ``group`` holds no nulls."""
    placed = written(
        rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
        .withColumn("_row", F.monotonically_increasing_id()))  # ascending in the range, which is in its upper bits
    placed = placed.withColumn("_range", F.shiftright("_row", 33))
    stretches = placed.groupBy(group, "_range").agg(F.count("*").alias("_size"), F.min("_row").alias("_first"))
    along = Window.partitionBy(group).orderBy("_range")
    earlier = F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, -1))
    offsets = stretches.select(
        group, "_range", (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_size").over(Window.partitionBy(group)).alias("n"))
    joined = join_sized(placed, offsets, [group, "_range"], "inner", spread=["_row"])
    return joined.withColumn("index", F.col("_row") + F.col("_shift")).drop("_row", "_range", "_shift")
