"""Gamma-ray window counts to stripped rates: live time, background, stripping."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveypulse.operators.joins import join_sized


def solved(rates: Column, ratios: Column) -> Column:
    """x of the lower triangular system x[i] = rates[i] - sum over j < i of ratios[i][j] * x[j]."""
    def add(done: Column, i: Column) -> Column:
        parts = F.zip_with(done, F.slice(F.get(ratios, i), F.lit(1), F.size(done)), lambda x, r: x * r)
        return F.array_append(done, F.get(rates, i) - F.aggregate(parts, F.lit(0.0), lambda a, b: a + b))

    places = F.sequence(F.lit(0), F.size(rates) - 1)
    return F.aggregate(places, F.array().cast("array<double>"), add)


def stripped(df: DataFrame, coefficients: DataFrame, keys: Iterable[str], channels: list[str], live: str) -> DataFrame:
    """``df`` with ``<channel>_rate``, counts per second of live time less background, and
    ``<channel>_stripped``, that less what the channels before it scatter into it.

    ``channels`` stand in the order of stripping: each gets a share of those before it (thorium, uranium,
    potassium). ``coefficients`` has a row per ``keys`` with ``background ARRAY<DOUBLE>``, a rate per channel,
    and ``ratios ARRAY<ARRAY<DOUBLE>>``, for each channel its shares of those before it. No live time, or
    none above zero, a missing count or no coefficients give NULL, also in the channels stripped after it.
    """
    keys = list(keys)
    seconds = F.when(F.col(live) > 0, F.col(live))
    met = join_sized(df, coefficients.select(*keys, F.col("background").alias("_b"), F.col("ratios").alias("_r")), keys, "left", spread=channels)
    rates = [F.col(c) / seconds - F.get("_b", F.lit(i)) for i, c in enumerate(channels)]
    with_rates = met.withColumn("_rates", F.array(*rates)).withColumn("_solved", solved(F.col("_rates"), F.col("_r")))
    shown = [F.get(a, F.lit(i)).alias(f"{c}_{n}") for a, n in (("_rates", "rate"), ("_solved", "stripped")) for i, c in enumerate(channels)]
    return with_rates.select(*df.columns, *shown)
