"""Operators that follow the order of rows.

Order is given as two columns: ``chunk``, a coarse piece of the series, and ``order`` inside
it. For files these are split offset and row counter; for a table with a rising row number,
:func:`chunk_of`. Windows run inside a chunk, so a series of any length - one that holds a
third of all rows, say - is spread over many tasks; what reaches across chunks is carried by
one or two rows per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from surveypulse.operators.joins import join_sized
from surveypulse.operators.profile import has_data

CHUNK_ROWS = 1 << 20

# Flags per word: channels are numbered through words of whole numbers.
WORD = 62


def chunk_of(order: str, rows: int = CHUNK_ROWS) -> Column:
    """Chunk number of a rising whole-number column: at most ``rows`` rows share one."""
    return F.floor(F.col(order) / rows).cast("bigint")


def first_valid(df: DataFrame, keys: Iterable[str], chunk: str, order: str, value: str) -> DataFrame:
    """First value per key that is not missing, in row order - not the smallest.

    Two steps, each on plain numbers: aggregated in place, map-side first, nothing sorted.
    """
    keys = list(keys)
    known = df.where(F.col(value).isNotNull())
    pieces = known.groupBy(*keys, F.col(chunk).alias("_chunk")).agg(F.min_by(value, order).alias("_first"))
    return pieces.groupBy(*keys).agg(F.min_by("_first", "_chunk").alias("first_value"))


def with_elapsed(df: DataFrame, keys: Iterable[str], chunk: str, order: str, seconds: str,
                 name: str = "time_sec", start: DataFrame | None = None) -> DataFrame:
    """Seconds since the first valid sample of the key. Negative past midnight: days do not wrap.

    ``start`` may be passed when it is known, as :func:`first_valid` returns it.
    """
    keys = list(keys)
    start = first_valid(df, keys, chunk, order, seconds) if start is None else start
    joined = join_sized(df, start, keys, spread=[order])
    return joined.withColumn(name, F.col(seconds) - F.col("first_value")).drop("first_value")


def ordered_rank(df: DataFrame, keys: Iterable[str], chunk: str, order: str, name: str = "rank") -> DataFrame:
    """Position of each row in its series, from 1.

    Rows are numbered inside their chunk; the rows of earlier chunks are added from a table
    with one row per chunk. Numbering and join use the same partitioning.
    """
    keys = list(keys)
    cut = df.withColumn("_chunk", F.col(chunk))
    inside = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(order))
    sizes = cut.groupBy(*keys, "_chunk").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_chunk", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    ranked = cut.withColumn("_inside", inside).join(offsets, [*keys, "_chunk"])
    return ranked.withColumn(name, F.col("_before") + F.col("_inside")).drop("_chunk", "_inside", "_before")


def _carry(df: DataFrame, keys: list[str], chunk: str, summary: Column, before: Callable[[str, WindowSpec], Column]) -> DataFrame:
    """``df`` with ``_carried``, what the chunks before a row's chunk hand on: one summary per chunk,
    combined along the chunks of a key. The join deals rows as the windows over chunks do that follow it."""
    pieces = df.groupBy(*keys, F.col(chunk).alias("_chunk")).agg(summary.alias("_summary"))
    handed = pieces.select(*keys, "_chunk", before("_summary", Window.partitionBy(*keys).orderBy("_chunk")).alias("_carried"))
    cut = df.withColumn("_chunk", F.col(chunk))
    return cut.join(handed, [*keys, "_chunk"]).drop("_chunk")


def _inside(keys: list[str], chunk: str, order: str) -> WindowSpec:
    return Window.partitionBy(*keys, chunk).orderBy(order)


_EARLIER = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, 0)


def with_previous(df: DataFrame, keys: Iterable[str], chunk: str, order: str, columns: list[str], prefix: str = "previous_") -> DataFrame:
    """The given columns of the row before, NULL at the first row of a series."""
    keys, row = list(keys), F.struct(*columns)
    carried = _carry(df, keys, chunk, F.max_by(row, order), lambda name, along: F.lag(name).over(along))
    # A struct tells "no row" from "a row of missing values".
    before = F.coalesce(F.lag(row).over(_inside(keys, chunk, order)), F.col("_carried"))
    held = carried.withColumn("_before", before)
    return held.select(*df.columns, *[F.col("_before")[c].alias(prefix + c) for c in columns])


def filled_forward(df: DataFrame, keys: Iterable[str], chunk: str, order: str, columns: str | list[str], names: str | list[str],
                   before: bool = False) -> DataFrame:
    """The last value of each column up to and with each row, or only before it; NULL if there is none."""
    keys = list(keys)
    columns, names = ([columns], [names]) if isinstance(columns, str) else (columns, names)
    latest = F.struct(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])

    def handed(summary: str, along: WindowSpec) -> Column:
        earlier = along.rowsBetween(*_EARLIER)
        return F.struct(*[F.last(F.col(summary)[c], ignorenulls=True).over(earlier).alias(c) for c in columns])

    here = _inside(keys, chunk, order).rowsBetween(*(_EARLIER if before else _SO_FAR))
    filled = {n: F.coalesce(F.last(c, ignorenulls=True).over(here), F.col("_carried")[c]) for c, n in zip(columns, names, strict=True)}
    return _carry(df, keys, chunk, latest, handed).withColumns(filled).drop("_carried")


def with_state(df: DataFrame, keys: Iterable[str], chunk: str, order: str, step: str, start: Column, state: str, stretch: str) -> DataFrame:
    """The ``state`` that the last ``step`` up to each row set, ``start`` before any, and the number of the
    ``stretch`` of equal states that the row is in, from 1.

    A chunk of rows acts on the state before it like a single row: it keeps it if no row has a step, else it
    sets its last one. It adds as many stretches as its steps change, and one if its first step isn't the
    state before. So a chunk hands on four values, whatever its rows.
    """
    keys, known = list(keys), F.col(step).isNotNull()
    here = _inside(keys, chunk, order)
    local = df.withColumn("_local", F.last(step, ignorenulls=True).over(here.rowsBetween(*_SO_FAR)))
    changes = (F.col("_local") != F.lag("_local").over(here)).cast("bigint")
    local = local.withColumn("_changes", F.coalesce(F.sum(changes).over(here.rowsBetween(*_SO_FAR)), F.lit(0)))
    placed = F.when(known, F.col(order))
    pieces = local.groupBy(*keys, F.col(chunk).alias("_chunk")).agg(
        F.min_by(F.col(step), placed).alias("_first"), F.max_by(F.col(step), placed).alias("_last"), F.max("_changes").alias("_changed"))
    along = Window.partitionBy(*keys).orderBy("_chunk")
    stated = pieces.withColumn("_state", F.coalesce(F.last("_last", ignorenulls=True).over(along.rowsBetween(*_EARLIER)), start))
    added = F.col("_changed") + F.coalesce(F.col("_first") != F.col("_state"), F.lit(False)).cast("bigint")
    handed = stated.select(
        *keys, "_chunk", "_state", F.coalesce(F.col("_first") != F.col("_state"), F.lit(False)).cast("bigint").alias("_differs"),
        F.coalesce(F.sum(added).over(along.rowsBetween(*_EARLIER)), F.lit(0)).alias("_before"))
    # A series whose first row has a step that isn't ``start`` begins with that step's stretch.
    opening = df.groupBy(*keys).agg(F.min_by(F.coalesce(F.col(step) != start, F.lit(False)), F.struct(chunk, order)).cast("bigint").alias("_opening"))
    met = local.withColumn("_chunk", F.col(chunk)).join(handed.join(opening, keys), [*keys, "_chunk"])
    number = 1 + F.col("_before") + F.col("_changes") + F.when(F.col("_local").isNotNull(), F.col("_differs")).otherwise(0) - F.col("_opening")
    return met.select(*df.columns, F.coalesce("_local", "_state").alias(state), number.alias(stretch))


def running_count(df: DataFrame, keys: Iterable[str], chunk: str, order: str, flag: Column, name: str) -> DataFrame:
    """How often ``flag`` was true up to and with each row."""
    keys = list(keys)
    marked = df.withColumn("_flag", F.coalesce(flag, F.lit(False)).cast("bigint"))
    carried = _carry(marked, keys, chunk, F.sum("_flag"), lambda s, along: F.sum(s).over(along.rowsBetween(*_EARLIER)))
    here = F.sum("_flag").over(_inside(keys, chunk, order).rowsBetween(*_SO_FAR))
    return carried.withColumn(name, here + F.coalesce("_carried", F.lit(0))).drop("_flag", "_carried")


def neighbourhood(df: DataFrame, keys: Iterable[str], chunk: str, order: str, reach: int, block_rows: int = 1 << 16) -> tuple[DataFrame, WindowSpec]:
    """Rows dealt to blocks of consecutive ranks, each with ``reach`` rows of its neighbours around it, and
    the window over a block. ``own`` marks the rows of the block itself; keep those after looking around."""
    keys = list(keys)
    width = max(block_rows, reach)
    ranked = ordered_rank(df, keys, chunk, order, "_rank")
    place = F.col("_rank") - 1
    block, inside = F.floor(place / width), place % width
    # The block itself, and its neighbour where the row stands near that edge.
    blocks = F.array_compact(F.array(block, F.when((inside < reach) & (block > 0), block - 1), F.when(inside >= width - reach, block + 1)))
    dealt = ranked.withColumn("_block", F.explode(blocks)).withColumn("own", F.col("_block") == block)
    return dealt, Window.partitionBy(*keys, "_block").orderBy("_rank")


def shifted(df: DataFrame, keys: Iterable[str], chunk: str, order: str, columns: list[str], by: int) -> DataFrame:
    """The given columns take the values of ``by`` rows later (earlier if negative), NULL beyond the ends."""
    around, here = neighbourhood(df, keys, chunk, order, abs(by))
    moved = around.withColumns({c: F.lead(F.struct(c), by).over(here)[c] for c in columns})
    return moved.where("own").select(*df.columns)


def lag_correlations(df: DataFrame, keys: Iterable[str], chunk: str, order: str, moved: str, still: str, most: int) -> DataFrame:
    """``keys, lag, n, correlation`` for each lag from ``-most`` to ``most``: the correlation of ``still`` with
    ``moved`` of ``lag`` rows later, over the rows where neither is missing. Sums of a block are merged
    before the shuffle by key and lag."""
    keys = list(keys)
    around, here = neighbourhood(df.select(*keys, chunk, order, moved, still), keys, chunk, order, most)
    lags = F.array(*[F.struct(F.lit(k).alias("lag"), F.lead(F.col(moved), k).over(here).alias("y")) for k in range(-most, most + 1)])
    pairs = around.select(*keys, "own", F.col(still).alias("x"), lags.alias("_lags")).where("own").select(*keys, "x", F.inline("_lags"))
    pairs = pairs.where("x IS NOT NULL AND y IS NOT NULL")
    # A channel that doesn't vary has no correlation.
    correlation = F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))
    return pairs.groupBy(*keys, "lag").agg(F.count("*").alias("n"), correlation.alias("correlation"))


def best_lag(correlations: DataFrame, keys: Iterable[str], least_rows: int = 3, digits: int = 9) -> DataFrame:
    """``keys, lag, correlation``: the lag of the strongest correlation either way, the smallest such lag, and
    of two equally far ones the positive one; lags with fewer than ``least_rows`` pairs don't count."""
    strength = F.round(F.abs("correlation"), digits)
    known = correlations.where(F.col("correlation").isNotNull() & ~F.isnan("correlation") & (F.col("n") >= least_rows))
    best = F.max_by(F.struct("lag", "correlation"), F.struct(strength, -F.abs("lag"), "lag"))
    return known.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.lag", "_best.correlation")


def live_channels(df: DataFrame, keys: Iterable[str], channels: list[str]) -> DataFrame:
    """Bit per channel that has any value in the key: ``keys``, ``live_0`` and so on, a word each."""
    present = _words([~F.col(c).isNull() for c in channels])
    return df.groupBy(*keys).agg(*[F.bit_or(w).alias(f"live_{i}") for i, w in enumerate(present)])


def live_from_stats(stats: DataFrame, keys: Iterable[str], channels: list[str]) -> DataFrame:
    """The same from channel statistics, without a pass over the rows."""
    known = stats.where(F.col("channel").isin(channels) & has_data())
    bits = _words([F.col("channel") == c for c in channels])
    return known.groupBy(*keys).agg(*[F.bit_or(w).alias(f"live_{i}") for i, w in enumerate(bits)])


def gap_intervals(
    df: DataFrame,
    keys: Iterable[str],
    chunk: str,
    order: str,
    time: str,
    sets: dict[str, list[str]],
    live: DataFrame | None = None,
) -> DataFrame:
    """Spans of rows in which any live channel of a set is missing.

    Returns ``keys, plot_set, t_start, t_end, n_rows``. A span starts at the time of its first
    row and ends at the time of the next row without a gap, or at the last row of the series.
    A channel without any value in a key takes no part; a set without live channels has no
    spans. ``live`` may be passed when it is known, with the channels of all sets in order.

    1. Rows become runs of equal missing channels, for all sets at once, inside each chunk.
       This is the only shuffle of rows, and it carries five columns.
    2. Runs become spans per set inside each chunk, with the partitioning of step 1.
    3. The first and last span of each chunk are joined across chunks. Spans with good rows
       on both sides in their chunk are final; they travel along in a lane of their chunk.
    """
    keys = list(keys)
    channels = set_channels(sets)
    if live is None:
        live = live_channels(df, keys, channels)
    runs = _runs(df, keys, chunk, order, time, channels)
    known = join_sized(runs, live, keys, "inner", spread=["chunk"])
    return _across_chunks(_spans(known, keys, sets, channels), keys)


def set_channels(sets: dict[str, list[str]]) -> list[str]:
    """Channels of all sets, each once, in declared order."""
    return list(dict.fromkeys(c for names in sets.values() for c in names))


def _words(conditions: list[Column]) -> list[Column]:
    """The conditions as bits, ``WORD`` to a whole number."""
    zero = F.lit(0).cast("bigint")
    bits = [F.when(c, F.lit(1 << i % WORD).cast("bigint")).otherwise(zero) for i, c in enumerate(conditions)]
    return [sum(bits[at : at + WORD], zero) for at in range(0, len(bits), WORD)]


def _mask(positions: list[int], words: int) -> list[Column]:
    return [F.lit(sum(1 << p % WORD for p in positions if p // WORD == w)).cast("bigint").alias(f"mask_{w}") for w in range(words)]


def _any(columns: list[Column]) -> Column:
    return reduce(or_, [c != 0 for c in columns])


def _runs(df: DataFrame, keys: list[str], chunk: str, order: str, time: str, channels: list[str]) -> DataFrame:
    missing = _words([F.col(c).isNull() for c in channels])
    names = [f"missing_{i}" for i in range(len(missing))]
    rows = df.select(
        *keys, F.col(chunk).alias("chunk"), F.col(order).alias("order"), F.col(time).alias("t"),
        *[m.alias(n) for m, n in zip(missing, names, strict=True)],
    )
    here = Window.partitionBy(*keys, "chunk").orderBy("order")
    changed = reduce(or_, [F.coalesce(F.lag(n).over(here) != F.col(n), F.lit(True)) for n in names])
    marked = rows.withColumn("_new", changed.cast("int"))
    run = F.sum("_new").over(here.rowsBetween(Window.unboundedPreceding, 0))
    return (
        marked.withColumn("run", run)
        .groupBy(*keys, "chunk", "run")
        .agg(
            F.min_by("t", "order").alias("t"), F.max_by("t", "order").alias("t_last"),
            *[F.min(n).alias(n) for n in names], F.count("*").alias("n_rows"),
        )
    )


def _spans(runs: DataFrame, keys: list[str], sets: dict[str, list[str]], channels: list[str]) -> DataFrame:
    place = {c: i for i, c in enumerate(channels)}
    words = range(-(-len(channels) // WORD))
    masks = [
        F.struct(F.lit(name).alias("plot_set"), *_mask([place[c] for c in names], len(words))) for name, names in sets.items()
    ]
    watched = [F.col(f"live_{w}").bitwiseAND(F.col(f"mask_{w}")) for w in words]
    flagged = runs.select("*", F.inline(F.array(*masks))).where(_any(watched))
    flagged = flagged.withColumn("gap", _any([F.col(f"missing_{w}").bitwiseAND(watched[w]) for w in words]))
    here = Window.partitionBy(*keys, "chunk", "plot_set").orderBy("run")
    changed = F.coalesce(F.lag("gap").over(here) != F.col("gap"), F.lit(True))
    numbered = flagged.withColumn("_new", changed.cast("int")).withColumn(
        "span", F.sum("_new").over(here.rowsBetween(Window.unboundedPreceding, 0))
    )
    spans = numbered.groupBy(*keys, "chunk", "plot_set", "span").agg(
        F.min_by("t", "run").alias("t"), F.max_by("t_last", "run").alias("t_last"),
        F.bool_and("gap").alias("gap"), F.sum("n_rows").alias("n_rows"),
    )
    along = Window.partitionBy(*keys, "chunk", "plot_set").orderBy("span")
    # The time of the next row is held in a struct: it may itself be missing.
    followed = spans.withColumn("next", F.lead(F.struct("t")).over(along))
    return followed.withColumns({"at_start": F.col("span") == 1, "at_end": F.col("next").isNull()})


def _across_chunks(spans: DataFrame, keys: list[str]) -> DataFrame:
    at_edge = F.col("at_start") | F.col("at_end")
    lanes = spans.where(F.col("gap") | at_edge).withColumn("lane", F.when(at_edge, -1).otherwise(F.col("chunk")))
    along = Window.partitionBy(*keys, "plot_set", "lane").orderBy("chunk", "span")
    before = F.lag(F.struct("gap", "at_end")).over(along)
    # A span goes on from the one before only if that one is a gap up to the end of its chunk.
    opens = F.col("gap") & F.coalesce(~before["gap"] | ~before["at_end"], F.lit(True))
    linked = lanes.withColumns(
        {"_open": opens.cast("int"), "_after": F.coalesce("next", F.lead(F.struct("t")).over(along))}
    )
    grouped = linked.withColumn(
        "_span", F.sum("_open").over(along.rowsBetween(Window.unboundedPreceding, 0))
    ).where("gap")
    place = F.struct("chunk", "span")
    until = F.when(F.col("_after").isNotNull(), F.col("_after.t")).otherwise(F.col("t_last"))
    return (
        grouped.groupBy(*keys, "plot_set", "lane", "_span")
        .agg(
            F.min_by("t", place).alias("t_start"), F.max_by(until, place).alias("t_end"),
            F.sum("n_rows").alias("n_rows"),
        )
        .drop("lane", "_span")
    )
