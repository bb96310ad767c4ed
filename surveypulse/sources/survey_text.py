"""Readers of sectioned survey text: navigation plans and compensation models.

In both, what a line means depends on a line above it. Lines keep file and order from the scan, cut in
blocks of a split; the values or heading in force are filled forward, across blocks too.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveypulse.functions.text import decoded, numeric, strip
from surveypulse.operators import series

FILE_KEYS = ["file"]

# The settings of a navigation plan and the names they get here.
PLAN_SETTINGS = {
    "UTMZone": "utm_zone", "RadarHeight": "radar_height", "RadarMin": "radar_min", "RadarMax": "radar_max", "CrossTrack": "cross_track",
    "CrossAngle": "cross_angle", "GroundSpeedMin": "ground_speed_min", "GroundSpeedMax": "ground_speed_max",
}
PLAN_ENTITY = "Coord"
ENTITY_STATES = ("unflown", "flown", "flying")


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file, block, mid, value``: lines of files with their order."""
    return spark.read.text(paths).select(
        decoded(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mid"), "value")


def _fields(line: Column) -> Column:
    return F.transform(F.split(line, ","), strip)


def nav_plan(lines: DataFrame, keys: Iterable[str] = FILE_KEYS) -> DataFrame:
    """``keys, entity, label, state, point, n_points, x, y, z`` and the plan's settings in force.

    A row per coordinate of each point, line or polyline, in order from 1; ``entity`` is the place of the
    entity in its file. A line of no known type is ignored. Settings hold from their line on. Coordinates
    that are no numbers are NULL; if fewer triples follow than the line says, those there are given.
    """
    keys = list(keys)
    parts = lines.withColumn("_f", _fields(F.col("value"))).withColumn("_type", F.get("_f", F.lit(0)))
    parts = parts.where(F.col("_type").isin(PLAN_ENTITY, *PLAN_SETTINGS))
    said = [F.when(F.col("_type") == t, F.get("_f", F.lit(1))).alias(f"_said_{n}") for t, n in PLAN_SETTINGS.items()]
    told = parts.select(*keys, "block", "mid", "_f", "_type", *said)
    names = list(PLAN_SETTINGS.values())
    filled = series.filled_forward(told, keys, "block", "mid", [f"_said_{n}" for n in names], names)
    numbered = series.running_count(filled, keys, "block", "mid", F.col("_type") == PLAN_ENTITY, "entity")
    count = F.coalesce(F.get("_f", F.lit(3)).try_cast("int"), F.lit(0))
    there = F.greatest(F.least(count, F.floor((F.size("_f") - 4) / 3).cast("int")), F.lit(0))
    places = F.when(there > 0, F.sequence(F.lit(1), there)).otherwise(F.array().cast("array<int>"))
    state = F.get(F.array(*map(F.lit, ENTITY_STATES)), F.get("_f", F.lit(1)).try_cast("int"))
    entities = numbered.where(F.col("_type") == PLAN_ENTITY).select(
        *keys, "entity", F.get("_f", F.lit(2)).alias("label"), state.alias("state"), F.explode(places).alias("point"), count.alias("n_points"),
        "_f", names[0], *[numeric(F.col(n)).alias(n) for n in names[1:]])
    axis = [numeric(F.get("_f", 1 + F.col("point") * 3 + i)).alias(c) for i, c in enumerate(("x", "y", "z"))]
    return entities.select(*keys, "entity", "label", "state", "point", "n_points", *axis, *names)


def compensation_terms(lines: DataFrame, keys: Iterable[str] = FILE_KEYS) -> DataFrame:
    """``keys, channel, ordinal, codes, coefficient``: the terms of a compensation model in file order.

    A line of letters and digits that begins with a letter heads a channel's block; each line of six numbers
    below it is a term, five codes and its coefficient. The codes' meaning is not documented: they are given
    as they stand. Terms above any heading have a NULL channel.
    """
    keys = list(keys)
    value = strip(F.col("value"))
    heading = F.when(value.rlike("^[A-Za-z][A-Za-z0-9_]*$"), value)
    told = lines.select(*keys, "block", "mid", heading.alias("_heading"), _fields(value).alias("_f"))
    told = told.where(F.col("_heading").isNotNull() | (F.size("_f") == 6))
    named = series.filled_forward(told, keys, "block", "mid", "_heading", "channel")
    counted = series.running_count(named, keys, "block", "mid", F.col("_heading").isNull(), "_terms")
    # Terms counted up to a heading are not of its block.
    opened = counted.withColumn("_before", F.when(F.col("_heading").isNotNull(), F.col("_terms")))
    placed = series.filled_forward(opened, keys, "block", "mid", "_before", "_above").where("_heading IS NULL")
    return placed.select(
        *keys, "channel", (F.col("_terms") - F.coalesce("_above", F.lit(0))).alias("ordinal"),
        F.transform(F.slice("_f", 1, 5), lambda c: c.try_cast("int")).alias("codes"), numeric(F.get("_f", F.lit(5))).alias("coefficient"))


def compensation_vectors(terms: DataFrame, keys: Iterable[str] = FILE_KEYS) -> DataFrame:
    """``keys, channel, n_terms, coefficients``: a vector per channel, as long as its block (some hundred)."""
    vector = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "coefficient"))), lambda t: t["coefficient"])
    return terms.groupBy(*keys, "channel").agg(F.count("*").alias("n_terms"), vector.alias("coefficients"))
