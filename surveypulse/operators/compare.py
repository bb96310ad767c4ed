"""Sessions side by side."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveypulse.operators.profile import has_data
from surveypulse.reference import per_row


def expand(sessions: DataFrame, channels: dict[str, list[str]]) -> DataFrame:
    """One row per session and channel of a constant list, in declared order."""
    pairs = [(kind, c) for kind, names in channels.items() for c in names]
    return per_row(sessions, [{"kind": k, "channel": c, "channel_ordinal": i} for i, (k, c) in enumerate(pairs)])


def compare_means(
    expected: DataFrame, stats: DataFrame, keys: Iterable[str], within: Iterable[str] = ()
) -> DataFrame:
    """Mean and deviation of each channel in each session.

    ``expected`` has one row per session and channel. A channel that has no data in any
    session of the same ``within`` group is left out.
    """
    keys, within = list(keys), list(within)
    on = [c for c in ("kind", "channel") if c in expected.columns and c in stats.columns]
    joined = expected.join(stats.select(*keys, *on, "n", "n_null", "mean", "std"), [*keys, *on], "left")
    known = joined.where(has_data()).select(*within, *on).distinct()
    state = F.when(has_data(), "DATA").otherwise("NO DATA")
    return joined.join(known, [*within, *on], "left_semi").withColumn("state", state).drop("n", "n_null")


def side_by_side(
    compared: DataFrame, rows: Iterable[str], session: str, sessions: list, values: dict[str, Column | str]
) -> DataFrame:
    """One column per session and value, for a given list of sessions."""
    cells = [F.first(v, ignorenulls=True).alias(name) for name, v in values.items()]
    return compared.groupBy(*rows).pivot(session, sessions).agg(*cells)


def with_company(sessions: DataFrame, keys: Iterable[str], within: Iterable[str]) -> DataFrame:
    """Sessions that have another one to be compared with."""
    several = sessions.groupBy(*within).agg(F.count("*").alias("_n")).where("_n >= 2").drop("_n")
    return sessions.select(*keys).join(several, list(within), "left_semi")
