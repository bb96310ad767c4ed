"""Gridding: nodes of a regular grid from scattered readings by inverse-distance weights."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cell(coordinate: Column, size: float) -> Column:
    return F.floor(coordinate / size).cast("bigint")


def gridded(df: DataFrame, keys: Iterable[str], x: str, y: str, value: str, size: float, reach: int = 1, power: float = 2.0,
            least_distance: float | None = None) -> DataFrame:
    """``keys, col, row, x, y, value, n``: the grid nodes at cell centres with any reading near.

    Each reading counts at the nodes of its own and the ``reach`` cells around it, with the weight
    ``distance ** -power``; distances below ``least_distance`` (a thousandth of a cell if not given) count as
    that, so a reading on a node doesn't divide by zero. Readings without position or value don't count.

    A reading gives (2 reach + 1) ** 2 partial sums, which are merged in its task before the shuffle by
    node: a cell that holds a third of all readings reaches its node as one row per task.
    """
    keys = list(keys)
    least = size / 1000 if least_distance is None else least_distance
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1)])
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(value).isNotNull())
    points = known.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), F.col(value).cast("double").alias("_v"))
    spread = points.select("*", F.inline(near)).withColumns({"col": cell(F.col("_x"), size) + F.col("i"), "row": cell(F.col("_y"), size) + F.col("j")})
    centre = lambda number: (F.col(number) + 0.5) * size
    distance = F.sqrt(F.pow(F.col("_x") - centre("col"), 2) + F.pow(F.col("_y") - centre("row"), 2))
    weighed = spread.withColumn("_w", F.pow(F.greatest(distance, F.lit(float(least))), -power))
    sums = weighed.groupBy(*keys, "col", "row").agg(
        F.sum(F.col("_w") * F.col("_v")).alias("_wv"), F.sum("_w").alias("_w"), F.count("*").alias("n"))
    return sums.select(*keys, "col", "row", centre("col").alias("x"), centre("row").alias("y"), (F.col("_wv") / F.col("_w")).alias("value"), "n")
