"""Fixed-width tables: layout from the header line, cells from the data lines.

The right edge of each header word is the right edge of its column. Cells are cut by one
regular expression per line, made from the header, and read either

* long - one row per number cell, for statistics over all channels, or
* wide - one column per channel asked for, for series.

The long form keeps generated code small: with some forty channels side by side a row's code
grows past the size the JVM compiles, and runs about three times slower.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveypulse import SESSION_KEYS
from surveypulse.functions.text import numeric, text_value, whole_number
from surveypulse.operators.joins import join_sized
from surveypulse.reference import TEXT_CHANNELS

_CELL = "\u001f"
_LAYOUT = ("channels", "pattern", "number_cells")


def layouts(headers: DataFrame, text_channels: Iterable[str] = TEXT_CHANNELS) -> DataFrame:
    """Add the layout of each header: channel names, right edges and the cutting pattern."""
    text = F.array(*[F.lit(c) for c in text_channels])
    plain = F.regexp_replace("header", r"\s", " ")
    size = F.length("_h")
    ends = F.filter(
        F.sequence(F.lit(1), size),
        lambda i: (F.substr("_h", i, F.lit(1)) != " ") & ((i == size) | (F.substr("_h", i + 1, F.lit(1)) == " ")),
    )
    widths = F.transform("edges", lambda e, i: e - F.when(i == 0, 0).otherwise(F.get("edges", i - 1)))
    groups = F.transform(
        "_w",
        lambda w, i: F.when(i + 1 == F.size("_w"), "(.*)").otherwise(F.concat(F.lit("(.{0,"), w, F.lit("})"))),
    )
    ordinals = F.sequence(F.lit(1), F.size("channels"))
    number_ordinals = F.filter(ordinals, lambda i: ~F.array_contains(text, F.get("channels", i - 1)))
    return (
        headers.where(F.trim(plain) != "")
        .withColumn("_h", plain)
        .withColumns({"channels": F.split(F.trim("_h"), " +"), "edges": ends})
        .withColumn("_w", widths)
        .withColumns(
            {
                "pattern": F.concat(F.lit("(?s)^"), F.array_join(groups, ""), F.lit("$")),
                "number_cells": F.array_join(F.transform(number_ordinals, lambda i: F.concat(F.lit("$"), i)), _CELL),
            }
        )
        .drop("_h", "_w")
    )


def channels_present(laid_out: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """One row per channel a header names, in header order from 0."""
    return laid_out.select(*keys, F.posexplode("channels").alias("ordinal", "channel"))


def attach_layout(
    lines: DataFrame, laid_out: DataFrame, keys: Iterable[str] = SESSION_KEYS, spread: Iterable[str] = ("value",)
) -> DataFrame:
    """Give each line the layout of its file; lines of files without a layout leave.

    Files of one kind normally share a single header: it becomes a constant of the plan, and only
    the keys are joined. Otherwise layouts are joined by file. Either table is broadcast only while
    it is measured to be small.
    """
    keys = list(keys)
    different = laid_out.select("header", *_LAYOUT).distinct().limit(2).collect()
    if len(different) == 1:
        only = different[0]
        constants = {c: F.lit(only[c]) for c in ("pattern", "number_cells")}
        constants["channels"] = F.array(*[F.lit(c) for c in only["channels"]])
        return join_sized(lines, laid_out.select(*keys), keys, "inner", spread).withColumns(constants)
    return join_sized(lines, laid_out.select(*keys, *_LAYOUT), keys, "inner", spread)


def not_blank() -> Column:
    return F.btrim(F.col("value"), F.lit(" \t\r\n")) != ""


def _cut(cells: Column) -> Column:
    spaced = F.replace(F.replace("value", F.lit("\t"), F.lit(" ")), F.lit(_CELL), F.lit("�"))
    return F.split(F.regexp_replace(spaced, F.col("pattern"), cells), _CELL)


def number_cells(lines: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Number cells one per row: ``keys, cell, value, whole``.

    ``cell`` counts the number channels of the header from 0 (text channels are left out of
    the cut). ``whole`` tells a value written as a whole number.
    """
    keys = list(keys)
    filled = lines.where(not_blank())
    # A cut is never empty. The outer form keeps Spark from adding a filter on its size, which
    # would cut every line twice.
    cut = filled.select(*keys, F.posexplode_outer(_cut(F.col("number_cells"))).alias("cell", "_raw"))
    trimmed = cut.select(*keys, "cell", F.trim("_raw").alias("_text"))
    text = F.col("_text")
    return trimmed.select(*keys, "cell", numeric(text).alias("value"), whole_number(text).alias("whole"))


def number_channels(laid_out: DataFrame, keys: Iterable[str] = SESSION_KEYS,
                    text_channels: Iterable[str] = TEXT_CHANNELS) -> DataFrame:
    """Names of the ``cell`` numbers of :func:`number_cells`, with the header position."""
    text = F.array(*[F.lit(c) for c in text_channels])
    named = F.transform("channels", lambda c, i: F.struct(c.alias("channel"), i.alias("ordinal")))
    numbers = F.filter(named, lambda s: ~F.array_contains(text, s["channel"]))
    return laid_out.select(*keys, F.posexplode(numbers).alias("cell", "_c")).select(*keys, "cell", "_c.*")


def wide_table(
    lines: DataFrame,
    channels: Iterable[str],
    keep: Iterable[str] = (*SESSION_KEYS, "block", "mid"),
    text_channels: Iterable[str] = TEXT_CHANNELS,
) -> DataFrame:
    """Typed columns for the channels asked for; a channel the file lacks is NULL throughout."""
    names, text_channels = list(channels), set(text_channels)
    wanted = [
        F.when(F.array_contains("channels", F.lit(c)),
               F.concat(F.lit("$"), F.array_position("channels", F.lit(c)).cast("string"))).otherwise("")
        for c in names
    ]
    # Cells stay in an array while they are worked on, see above: the code for a row does not
    # grow with the number of channels. Only the cells asked for are cut out.
    cut = lines.where(not_blank()).select(*keep, _cut(F.concat_ws(_CELL, *wanted)).alias("_raw"))
    texts = cut.select(*keep, F.transform("_raw", lambda c: F.trim(c)).alias("_texts"))
    both = texts.select(*keep, "_texts", F.transform("_texts", numeric).alias("_numbers"))
    typed = [text_value(F.get("_texts", i)) if c in text_channels else F.get("_numbers", i) for i, c in enumerate(names)]
    return both.select(*keep, *[v.alias(c) for v, c in zip(typed, names)])


def all_channels(laid_out: DataFrame) -> list[str]:
    """Every channel name in use, known names in header order. The names form a schema, so
    they are collected; their number does not grow with the rows."""
    named = laid_out.select(F.posexplode("channels").alias("ordinal", "channel"))
    order = named.groupBy("channel").agg(F.min("ordinal").alias("ordinal"))
    return [r.channel for r in order.orderBy("ordinal", "channel").collect()]
