"""Flight lines, turns and sessions as flown.

A row is on a line or in a turn. A heading that changes fast starts a turn, one that hardly changes ends
it, and anything between leaves the state as it is. So each row maps the state before it to the state
after it in one of three ways - to turn, to line, keep - and the map of a chunk of rows is that of its
last row that doesn't keep: chunks are worked on apart and handed one state each.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveypulse.operators import series
from surveypulse.operators.joins import join_sized

DAY = 86400.0


def turned(heading: Column, before: Column) -> Column:
    """Degrees from one heading to the next, the short way round: from -180 up to, without, 180."""
    return F.pmod(heading - before + 180.0, F.lit(360.0)) - 180.0


def course(x: Column, y: Column, x_before: Column, y_before: Column) -> Column:
    """Heading of a step in degrees clockwise from north; NULL for a step on the spot."""
    moved = (x != x_before) | (y != y_before)
    return F.when(moved, F.pmod(F.degrees(F.atan2(x - x_before, y - y_before)), F.lit(360.0)))


def with_segments(df: DataFrame, keys: Iterable[str], chunk: str, order: str, heading: str,
                  turn_from: float, line_below: float) -> DataFrame:
    """Rows with ``in_turn`` and ``segment``, numbered from 1 along the series.

    A change of heading by at least ``turn_from`` degrees from one row to the next starts a turn, one of at
    most ``line_below`` ends it. A missing heading keeps the state and is not compared with. A series
    starts on a line.
    """
    if not 0 <= line_below < turn_from <= 180:
        raise ValueError("0 <= line_below < turn_from <= 180")
    keys, columns = list(keys), df.columns
    # Compared with the last heading known before the row: missing ones are passed over.
    known = series.filled_forward(df, keys, chunk, order, heading, "_known", before=True)
    change = F.abs(turned(F.col(heading), F.col("_known")))
    step = F.when(change >= turn_from, F.lit(True)).when(change <= line_below, F.lit(False))
    stated = series.with_state(known.withColumn("_step", step), keys, chunk, order, "_step", F.lit(False), "in_turn", "segment")
    return stated.select(*columns, "in_turn", "segment")


def flight_lines(segments: DataFrame, keys: Iterable[str], order: str, time: str, heading: str, least_rows: int = 1) -> DataFrame:
    """A row per segment: ``segment, in_turn, t_start, t_end, n_rows, mean_heading``, the mean on the circle,
    and ``line``, the number of the segment among the lines of at least ``least_rows`` rows, else NULL."""
    keys = list(keys)
    angle = F.radians(heading)
    found = segments.groupBy(*keys, "segment").agg(
        F.first("in_turn").alias("in_turn"), F.min_by(time, order).alias("t_start"), F.max_by(time, order).alias("t_end"),
        F.count("*").alias("n_rows"), F.sum(F.sin(angle)).alias("_east"), F.sum(F.cos(angle)).alias("_north"))
    counts = ~F.col("in_turn") & (F.col("n_rows") >= least_rows)
    # Segments of a series are few next to its rows; chunks of them are numbered like rows.
    chunked = found.withColumn("_piece", series.chunk_of("segment"))
    numbered = series.running_count(chunked, keys, "_piece", "segment", counts, "line").drop("_piece")
    mean = F.pmod(F.degrees(F.atan2("_east", "_north")), F.lit(360.0))
    return numbered.withColumns({"line": F.when(counts, F.col("line")), "mean_heading": mean}).drop("_east", "_north")


def unwrapped(df: DataFrame, keys: Iterable[str], chunk: str, order: str, seconds: str, name: str = "abs_sec") -> DataFrame:
    """Seconds since the midnight before the first row: a step back by more than half a day is a new day."""
    keys = list(keys)
    known = series.filled_forward(df, keys, chunk, order, seconds, "_known", before=True)
    midnight = F.col(seconds) - F.col("_known") < -DAY / 2
    days = series.running_count(known, keys, chunk, order, midnight, "_days")
    return days.withColumn(name, F.col(seconds) + DAY * F.col("_days")).drop("_known", "_days")


def split_sessions(df: DataFrame, keys: Iterable[str], chunk: str, order: str, time: str, max_gap: float) -> DataFrame:
    """Rows with ``part``, from 1: a new part starts where time moves by more than ``max_gap`` seconds, either
    way, from the last known time. Rows without time stay in the part they stand in."""
    keys = list(keys)
    known = series.filled_forward(df, keys, chunk, order, time, "_known", before=True)
    apart = F.abs(F.col(time) - F.col("_known")) > max_gap
    parts = series.running_count(known, keys, chunk, order, apart, "part")
    return parts.withColumn("part", F.col("part") + 1).drop("_known")


def merge_sessions(intervals: DataFrame, keys: Iterable[str], start: str, end: str, max_gap: float = 0.0) -> DataFrame:
    """Intervals with ``merged``, from 1 in time order: those that overlap, or leave at most ``max_gap`` seconds
    between them, share a number. One row per session: a key's rows are sorted in one task. Intervals
    without start or end get NULL."""
    keys = list(keys)
    whole = F.col(start).isNotNull() & F.col(end).isNotNull()
    along = Window.partitionBy(*keys, whole).orderBy(start, end)
    reached = F.max(end).over(along.rowsBetween(Window.unboundedPreceding, -1))
    opened = intervals.withColumn("_new", F.coalesce(F.col(start) > reached + max_gap, F.lit(True)).cast("int"))
    number = F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0))
    return opened.withColumn("merged", F.when(whole, number)).drop("_new")


def first_source(rows: DataFrame, intervals: DataFrame, keys: Iterable[str], source: str, time: str, start: str, end: str,
                 bucket_seconds: float = 3600.0, spread: Iterable[str] = ()) -> DataFrame:
    """Rows whose time no interval of a smaller source covers, both ends included. Rows without time stay.

    Intervals are listed under each time bucket that they touch and met there, so a row sees only the
    intervals near it. The sources that overlap in one bucket are the sessions logged side by side, a few.
    """
    keys = list(keys)
    bucket = lambda c: F.floor(c / bucket_seconds).cast("bigint")
    listed = intervals.where(F.col(start) <= F.col(end)).select(*keys, F.col(source).alias("_source"), F.col(start).alias("_start"), F.col(end).alias("_end"))
    listed = listed.withColumn("_bucket", F.explode(F.sequence(bucket(F.col("_start")), bucket(F.col("_end")))))
    held = listed.groupBy(*keys, "_bucket").agg(F.array_sort(F.collect_set(F.struct("_source", "_start", "_end"))).alias("_covers"))
    met = join_sized(rows.withColumn("_bucket", bucket(F.col(time))), held, [*keys, "_bucket"], "left", spread=list(spread))
    covered = F.exists("_covers", lambda i: (i["_source"] < F.col(source)) & (i["_start"] <= F.col(time)) & (F.col(time) <= i["_end"]))
    return met.where(~F.coalesce(covered, F.lit(False))).drop("_bucket", "_covers")
