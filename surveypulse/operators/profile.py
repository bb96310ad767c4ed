"""Completeness and spread of channels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveypulse import SESSION_KEYS
from surveypulse.reference import CONSTANT_STD, EXCELLENT_HDOP

STAT_COLUMNS = ("n", "n_null", "mean", "std", "min", "max", "all_integral")


def _statistics(value: Column, whole: Column) -> list[Column]:
    return [
        F.count("*").alias("n"),
        (F.count("*") - F.count(value)).alias("n_null"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.bool_and(F.coalesce(whole & value.isNotNull(), F.lit(False))).alias("all_integral"),
    ]


def channel_stats(df: DataFrame, keys: Iterable[str], channels: Iterable[str]) -> DataFrame:
    """Row count, missing count, mean, sample deviation, range and wholeness per channel.

    One pass for all channels; a missing value is NULL. A channel is ``all_integral`` when
    its type is a whole-number type and nothing is missing. The aggregate runs on one row per
    value, merged map-side: the code of a row does not grow with the number of channels.
    """
    keys, channels = list(keys), list(channels)
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    whole = {c: F.lit(types[c] in ("byte", "short", "integer", "long")) for c in channels}
    values = [F.struct(F.lit(c).alias("channel"), F.col(c).cast("double").alias("value"), whole[c].alias("whole"))
              for c in channels]
    # The outer form: the plain one adds a filter that computes the array a second time.
    long = df.select(*keys, F.inline_outer(F.array(*values)))
    stats = long.groupBy(*keys, "channel").agg(*_statistics(F.col("value"), F.col("whole")))
    if keys:
        return stats
    # Without keys there is one group even over no rows.
    named = df.sparkSession.createDataFrame([(c,) for c in channels], "channel STRING")
    return named.join(stats, "channel", "left").select(
        "channel", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n_null", F.lit(0)).alias("n_null"), *STAT_COLUMNS[2:]
    )


def count_cells(cells: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """The same from number cells of fixed-width files, by cell number.

    Merged map-side, so a session of any size sends one row per task and channel.
    """
    return cells.groupBy(*keys, "cell").agg(*_statistics(F.col("value"), F.col("whole")))


def name_cells(counted: DataFrame, named: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Counted cells with their channel names, one row per number channel of every header.

    A file without rows has no missing value and counts as whole numbers: an empty column
    has no floating-point type, so it falls into no class.
    """
    full = named.join(counted, [*keys, "cell"], "left")
    return full.select(
        *keys, "channel", "ordinal",
        F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n_null", F.lit(0)).alias("n_null"),
        "mean", "std", "min", "max", F.coalesce("all_integral", F.lit(True)).alias("all_integral"),
    )


def percent_missing(n_null: Column | None = None, n: Column | None = None) -> Column:
    """Percent of rows without a value; NULL for no rows."""
    return 100 * F.try_divide(F.col("n_null") if n_null is None else n_null, F.col("n") if n is None else n)


def missing_class() -> Column:
    """``fully``, ``partial`` or ``clean``; NULL for a whole-number channel.

    A channel of whole numbers without a gap is of integer type and belongs to no class; with
    a gap it becomes floating-point and is partial.
    """
    return (
        F.when(F.col("all_integral"), None)
        .when(F.col("n_null") == F.col("n"), "fully")
        .when(F.col("n_null") > 0, "partial")
        .otherwise("clean")
    )


def classify(stats: DataFrame, skip: DataFrame | None = None) -> DataFrame:
    """Class and percent missing of every analysed channel; skipped and unclassed ones leave."""
    kept = stats
    if skip is not None:
        on = [c for c in ("kind", "channel") if c in skip.columns]
        kept = stats.join(skip, on, "left_anti")
    return kept.withColumns({"pct_null": percent_missing(), "class": missing_class()}).where("class IS NOT NULL")


def has_data() -> Column:
    """Whether a channel is there and holds any value."""
    return F.coalesce(F.col("n_null") < F.col("n"), F.lit(False))


def stability_status(present: Column | None = None) -> Column:
    """Verdict on the deviation; an undefined deviation is never within its limit."""
    absent = F.lit(False) if present is None else ~F.coalesce(present, F.lit(False))
    return (
        F.when(absent | ~has_data(), "NO_DATA")
        .when(F.col("max_std").isNull(), None)
        .when(F.coalesce(F.col("std") <= F.col("max_std"), F.lit(False)), "OK")
        .otherwise("HIGH_STD")
    )


def stability(stats: DataFrame, thresholds: DataFrame, descriptions: DataFrame | None = None) -> DataFrame:
    """Statistics with unit, limit and verdict of each channel."""
    judged = stats.join(thresholds, "channel", "left").withColumn("status", stability_status())
    return judged if descriptions is None else judged.join(descriptions, "channel", "left")


def quality_grade(mean: Column) -> Column:
    """Grade of the mean dilution of precision; there are only two."""
    return F.when(mean < EXCELLENT_HDOP, "EXCELLENT").otherwise("GOOD")


def is_constant(std: Column, limit: float = CONSTANT_STD) -> Column:
    """Whether a channel hardly varies; unknown for a single value means no."""
    return F.coalesce(std < limit, F.lit(False))


def gated(stats: DataFrame, channels: Iterable[str], gate: str, keys: Iterable[str]) -> DataFrame:
    """Channels with data, of the keys whose ``gate`` channel has data."""
    open_keys = stats.where((F.col("channel") == gate) & has_data()).select(*keys)
    return stats.where(F.col("channel").isin(list(channels)) & has_data()).join(open_keys, list(keys), "left_semi")
