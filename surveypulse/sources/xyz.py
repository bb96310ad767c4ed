"""Line-oriented XYZ text: a header per line, then its rows; ``*`` for missing.

Written by ranges of (line, order): every task writes one stretch of the whole in order, and the files'
names follow that order, so the export needs no single writer and reads back as one sorted table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveypulse.functions.text import decoded, numeric
from surveypulse.operators import series

MISSING, HEADER = "*", "Line "


def _shown(name: str, decimals: int) -> Column:
    text = F.round(F.col(name), decimals).cast(f"decimal(38,{decimals})").cast("string")
    return F.coalesce(text, F.lit(MISSING))


def write_xyz(df: DataFrame, path: str, line: str, order: str, decimals: dict[str, int]) -> None:
    """Write the columns of ``decimals``, each with its number of decimals, in ``order`` within each ``line``.

    A header ``Line <line>`` stands before the first row of a line, wherever ranges are cut. Rows without a
    line are not written. Rows equal in order stand in some order.
    """
    rows = df.where(F.col(line).isNotNull()).select(
        F.col(line).alias("_line"), F.lit(1).alias("_row"), F.col(order).alias("_order"),
        F.concat_ws(" ", *[_shown(c, d) for c, d in decimals.items()]).alias("value"))
    headers = rows.groupBy("_line").agg(F.min("_order").alias("_order")).select(
        "_line", F.lit(0).alias("_row"), "_order", F.concat(F.lit(HEADER), F.col("_line").cast("string")).alias("value"))
    place = ["_line", "_row", "_order"]
    sorted_rows = rows.unionByName(headers).repartitionByRange(*place).sortWithinPartitions(*place)
    sorted_rows.select("value").write.mode("overwrite").text(path)


def read_xyz(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """``line, place`` and the columns; ``place`` sorts rows as they were written.

    The line of a row is the last header above it, in its own piece of a file or in one before.
    """
    name = decoded(F.col("_metadata.file_path"))
    lines = spark.read.text(path).select(
        F.lit(path).alias("_export"), F.struct(name.alias("file"), F.col("_metadata.file_block_start").alias("block")).alias("_piece"),
        F.monotonically_increasing_id().alias("_mid"), "value")
    header = F.when(F.startswith("value", F.lit(HEADER)), F.substring(F.col("value"), F.lit(len(HEADER) + 1), F.length("value")))
    filled = series.filled_forward(lines.withColumn("_header", header), ["_export"], "_piece", "_mid", "_header", "line")
    fields = F.split("value", " ")
    cells = [numeric(F.nullif(F.get(fields, F.lit(i)), F.lit(MISSING))).alias(c) for i, c in enumerate(columns)]
    return filled.where("_header IS NULL").select("line", F.struct("_piece", "_mid").alias("place"), *cells)
