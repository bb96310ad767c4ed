"""Readings of one series at the times of another: as-of match with linear interpolation.

A base station's samples stand around each reading in time, not at it. Time is cut into buckets and both
series are put in order inside a bucket; the nearest samples outside it come from a table with the first
and last sample of each bucket. So a key of any length spreads over its buckets.

What follows a row is looked up backwards, as the last value of a descending order: a frame up to the end of
its group is worked out anew for each row, which is quadratic in the rows of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveypulse.operators.joins import join_sized

BUCKET_SECONDS = 600.0


def _bucket(time: Column, seconds: float) -> Column:
    return F.floor(time / seconds).cast("bigint")


def interpolated(
    readings: DataFrame,
    base: DataFrame,
    keys: Iterable[str],
    time: str,
    value: str,
    name: str,
    bucket_seconds: float = BUCKET_SECONDS,
    max_gap: float | None = None,
    outside: str = "missing",
) -> DataFrame:
    """``readings`` with ``name``, the value of ``base`` at each row's time.

    * Between two samples the value lies on the line between them, at a sample it is the sample's. Samples
      at one time count as their mean; samples without time or value don't count.
    * Before the first and after the last sample it is NULL, or with ``outside="nearest"`` that sample's.
    * If the two samples are more than ``max_gap`` seconds apart it is NULL; if ``outside`` is nearest, so
      it is further than that from the nearest.
    * A reading without time gets NULL. Rows keep their other columns; ``keys`` are not NULL.
    """
    if outside not in ("missing", "nearest"):
        raise ValueError(f"outside is missing or nearest, not {outside}")
    keys = list(keys)
    samples = base.where(F.col(time).isNotNull() & F.col(value).isNotNull()).groupBy(*keys, F.col(time).cast("double").alias("_at")).agg(
        F.avg(value).alias("_v"))
    samples = samples.withColumn("_bucket", _bucket(F.col("_at"), bucket_seconds))
    sample = F.struct("_at", "_v")

    # The nearest samples outside each bucket that has anything in it.
    ends = samples.groupBy(*keys, "_bucket").agg(F.min(sample).alias("_first"), F.max(sample).alias("_last"))
    asked = readings.where(F.col(time).isNotNull()).select(*keys, _bucket(F.col(time), bucket_seconds).alias("_bucket")).distinct()
    along, back = Window.partitionBy(*keys).orderBy("_bucket"), Window.partitionBy(*keys).orderBy(F.desc("_bucket"))
    edges = asked.join(ends, [*keys, "_bucket"], "full").select(
        *keys, "_bucket",
        F.last("_last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"),
        F.last("_first", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)).alias("_later"))

    # Samples and readings of a bucket in one order and its reverse; a sample stands before readings of its time.
    row = F.struct(*readings.columns)
    both = readings.select(*keys, row.alias("_row"), F.col(time).cast("double").alias("_at"), F.lit(None).cast("double").alias("_v")).withColumn(
        "_bucket", _bucket(F.col("_at"), bucket_seconds)).unionByName(
        samples.select(*keys, F.lit(None).cast(readings.select(row).schema[0].dataType).alias("_row"), "_at", "_v", "_bucket"))
    bucket, is_reading = Window.partitionBy(*keys, "_bucket"), F.col("_row").isNotNull()
    here, reverse = bucket.orderBy("_at", is_reading), bucket.orderBy(F.desc("_at"), is_reading.desc())
    known = F.when(F.col("_v").isNotNull(), sample)
    placed = both.withColumns({
        "_before": F.last(known, ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, 0)),
        "_after": F.last(known, ignorenulls=True).over(reverse.rowsBetween(Window.unboundedPreceding, 0)),
    }).where(is_reading)
    met = join_sized(placed, edges, [*keys, "_bucket"], "left")
    before, after, at = F.coalesce("_before", "_earlier"), F.coalesce("_after", "_later"), F.col("_at")
    met = met.withColumns({"_before": before, "_after": after})
    t0, v0, t1, v1 = F.col("_before._at"), F.col("_before._v"), F.col("_after._at"), F.col("_after._v")
    line = v0 + (v1 - v0) * (at - t0) / (t1 - t0)
    near = F.lit(True) if max_gap is None else t1 - t0 <= max_gap
    found = F.when(t0 == at, v0).when(t0.isNotNull() & t1.isNotNull(), F.when(near, line))
    if outside == "nearest":
        reach = lambda gap: F.lit(True) if max_gap is None else gap <= max_gap
        found = found.when(t0.isNotNull() & t1.isNull(), F.when(reach(at - t0), v0)).when(t1.isNotNull() & t0.isNull(), F.when(reach(t1 - at), v1))
    return met.select("_row.*", F.when(at.isNotNull(), found).alias(name))


def diurnal_corrected(readings: DataFrame, base: DataFrame, keys: Iterable[str], time: str, channel: str, base_value: str,
                      datum: float | None = None, **options) -> DataFrame:
    """``readings`` with ``diurnal``, the base station's departure from ``datum`` (its mean per key if not
    given) at each row's time, and ``<channel>_corrected``, the channel less that. Both are NULL where the
    base station says nothing. ``options`` as in :func:`interpolated`."""
    keys = list(keys)
    at_base = interpolated(readings, base, keys, time, base_value, "_base", **options)
    if datum is not None:
        level = at_base.withColumn("_datum", F.lit(float(datum)))
    else:
        level = join_sized(at_base, base.groupBy(*keys).agg(F.avg(base_value).alias("_datum")), keys, "left", spread=[time])
    moved = level.withColumn("diurnal", F.col("_base") - F.col("_datum"))
    return moved.withColumn(f"{channel}_corrected", F.col(channel) - F.col("diurnal")).drop("_base", "_datum")
