"""Registered queries: every operator on the driver's tables, each with a DuckDB equivalent.

``events`` stands in for survey data. As a series its session is ``user_id``, its order
``event_id`` and its reading ``value``, missing where ``event_type`` is ``error``. As a log its
session is the day, and every event becomes one line of text, of a kind given by its type.
Parsers get the rendered text; the SQL reads the table itself, so a parser error shows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveypulse import reference as ref
from surveypulse.functions.clock import seconds_of_day
from surveypulse.operators import compare, events, health, profile, series
from surveypulse.sources import config_xml, files, fixed_width, lines

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_SENSOR_NAMES = [s[0] for s in ref.SENSORS]
_MAPPED = [(s, c, i) for s, channels in ref.SENSOR_CHANNELS.items() for i, c in enumerate(channels)]


def _query(sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLE[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _round(column: str, digits: int = 8) -> Column:
    return F.round(column, digits).alias(column)


def _values(rows: list[tuple]) -> str:
    """Constant rows as an SQL VALUES list."""
    def literal(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


# -- events as a series -------------------------------------------------------------------


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a reading and a second channel that have gaps, and a chunk of the row order."""
    reading = F.when(F.col("event_type") != "error", F.col("value"))
    second = F.when(F.col("event_type") != "view", F.col("value") * 2)
    clock = F.hour("ts") * 10000 + F.minute("ts") * 100 + F.second("ts") + F.date_format("ts", "SSS").cast("int") / 1000.0
    sample = (F.dayofmonth("ts") * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("double")
    return _table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", "value", reading.alias("reading"), second.alias("second"),
        clock.alias("clock"), sample.alias("sample"), series.chunk_of("event_id").alias("chunk"),
    )


_SERIES = """
series AS (
  SELECT user_id, event_id, event_type, value,
         CASE WHEN event_type <> 'error' THEN value END AS reading,
         CASE WHEN event_type <> 'view' THEN value * 2 END AS second,
         hour(ts) * 3600 + minute(ts) * 60 + second(ts) + (millisecond(ts) % 1000) / 1000.0 AS sec,
         CAST(day(ts) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS DOUBLE) AS sample
  FROM events)"""


@_query("SELECT DISTINCT event_type AS dataset, CAST(user_id AS INT) AS session FROM events")
def q_sessions(spark, sf_dir):
    """Sessions named by file paths."""
    path = F.format_string("file:/survey/%s/EVT%05d.txt", "event_type", "user_id")
    listing = _table(spark, sf_dir, "events").select(path.alias("path"))
    return files.named_sessions(listing).groupBy("dataset", "session").agg(F.min("folder")).select("dataset", "session")


_ASKED = range(0, 700, 7)


@_query(f"""WITH asked(session) AS (SELECT CAST(range AS INT) FROM range({_ASKED.start}, {_ASKED.stop}, {_ASKED.step}))
SELECT DISTINCT event_type AS dataset, session FROM asked LEFT JOIN events ON user_id = session""")
def q_sessions_asked(spark, sf_dir):
    """Session numbers asked for, with their data sets; a number that no file names is a row all the same."""
    path = F.format_string("file:/survey/%s/EVT%05d.txt", "event_type", "user_id")
    found = files.named_sessions(_table(spark, sf_dir, "events").select(path.alias("path")))
    chosen = files.select_sessions(found, list(_ASKED)).select("dataset", "session")
    lost = files.sessions_missing(found, list(_ASKED))
    return chosen.unionByName(lost.select(F.lit(None).cast("string").alias("dataset"), "session"))


@_query(f"""WITH {_SERIES} SELECT event_id, round(sec, 3) AS sec FROM series""")
def q_time_of_day(spark, sf_dir):
    """HHMMSS.sss as seconds of the day."""
    return _series(spark, sf_dir).select("event_id", F.round(seconds_of_day(F.col("clock")), 3).alias("sec"))


@_query(f"""WITH {_SERIES}, told AS (SELECT *, CASE WHEN event_type <> 'error' THEN sec END AS known FROM series)
SELECT event_id, user_id, round(known - first_value(known IGNORE NULLS) OVER (
         PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 3) AS time_sec
FROM told""")
def q_elapsed(spark, sf_dir):
    """Seconds since the first valid sample of a session."""
    known = F.when(F.col("event_type") != "error", seconds_of_day(F.col("clock")))
    timed = _series(spark, sf_dir).select("event_id", "user_id", "chunk", known.alias("known"))
    elapsed = series.with_elapsed(timed, ["user_id"], "chunk", "event_id", "known")
    return elapsed.select("event_id", "user_id", _round("time_sec", 3))


@_query(f"""WITH {_SERIES}, counted AS (
  SELECT user_id, count(*) AS n, count(*) - count(reading) AS a, count(*) - count(second) AS b FROM series GROUP BY 1),
long AS (SELECT user_id, 'reading' AS channel, n, CASE WHEN user_id % 3 = 0 THEN n ELSE a END AS n_null FROM counted
         UNION ALL SELECT user_id, 'second', n, b FROM counted UNION ALL SELECT user_id, 'sample', n, 0 FROM counted)
SELECT user_id, channel, n, n_null, round(100.0 * n_null / n, 8) AS pct_null,
       CASE WHEN n_null = n THEN 'fully' WHEN n_null > 0 THEN 'partial' ELSE 'clean' END AS class
FROM long""")
def q_missingness(spark, sf_dir):
    """Missing rows, percent and class per channel; the skipped and the whole-number channel leave."""
    skip = spark.createDataFrame([("value",)], "channel STRING")
    # Each third session has no reading at all; the sample time is always there.
    rows = _series(spark, sf_dir).withColumn("reading", F.when(F.col("user_id") % 3 > 0, F.col("reading")))
    stats = profile.channel_stats(rows, ["user_id"], ["reading", "second", "sample", "value", "event_id"])
    return profile.classify(stats, skip).select("user_id", "channel", "n", "n_null", _round("pct_null"), "class")


_LIMITS = [("click", "units", 50.0), ("view", "units", 48.0), ("signup", "units", 40.0), ("purchase", "units", 60.0)]


@_query(f"""WITH limits(channel, unit, max_std) AS (VALUES {_values(_LIMITS)}), {_SERIES}, stats AS (
  SELECT event_type AS channel, count(*) AS n, count(*) - count(reading) AS n_null, avg(reading) AS mean,
         stddev_samp(reading) AS std, min(reading) AS min, max(reading) AS max FROM series GROUP BY 1)
SELECT s.channel, n, n_null, round(mean, 8) AS mean, round(std, 8) AS std, min, max, unit, max_std,
       CASE WHEN n_null = n THEN 'NO_DATA' WHEN max_std IS NULL THEN NULL
            WHEN coalesce(std <= max_std, FALSE) THEN 'OK' ELSE 'HIGH_STD' END AS status
FROM stats s LEFT JOIN limits l ON s.channel = l.channel""")
def q_stability(spark, sf_dir):
    """Spread of each channel against its limit."""
    limits = spark.createDataFrame(_LIMITS, "channel STRING, unit STRING, max_std DOUBLE")
    stats = profile.channel_stats(_series(spark, sf_dir), ["event_type"], ["reading"])
    named = stats.drop("channel").withColumnRenamed("event_type", "channel")
    return profile.stability(named, limits).select(
        "channel", "n", "n_null", _round("mean"), _round("std"), "min", "max", "unit", "max_std", "status"
    )


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@_query(" UNION ALL ".join(
    f"""SELECT l_returnflag, l_linestatus, '{c}' AS channel, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        coalesce(stddev_samp({c}) < 0.03, FALSE) AS "constant" FROM lineitem GROUP BY 1, 2""" for c in _MEASURES))
def q_constant_flag(spark, sf_dir):
    """Channels that hardly vary."""
    stats = profile.channel_stats(_table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], _MEASURES)
    return stats.select("l_returnflag", "l_linestatus", "channel", _round("mean", 4), _round("std", 4),
                        profile.is_constant(F.col("std"), 0.03).alias("constant"))


@_query("""SELECT o_orderstatus, o_orderpriority, channel, n, n_null, round(mean, 4) AS mean, min, max FROM (
  SELECT o_orderstatus, o_orderpriority, 'root' AS channel, count(*) AS n, 0 AS n_null,
         avg(sqrt(o_totalprice)) AS mean, min(sqrt(o_totalprice)) AS min, max(sqrt(o_totalprice)) AS max FROM orders GROUP BY 1, 2
  """ + " ".join(f"""UNION ALL SELECT o_orderstatus, o_orderpriority, 'level_{i}', count(*),
         count(*) - count(CASE WHEN o_totalprice >= {i * 40000} THEN sqrt(o_totalprice) END),
         avg(CASE WHEN o_totalprice >= {i * 40000} THEN sqrt(o_totalprice) END),
         min(CASE WHEN o_totalprice >= {i * 40000} THEN sqrt(o_totalprice) END),
         max(CASE WHEN o_totalprice >= {i * 40000} THEN sqrt(o_totalprice) END) FROM orders GROUP BY 1, 2"""
    for i in range(14)) + ") UNION ALL SELECT NULL, NULL, 'level_' || i, 0, 0, NULL, NULL, NULL FROM range(14) r(i)")
def q_many_channels(spark, sf_dir):
    """Statistics of a wide table; and, without keys, of no rows: a row per channel all the same."""
    price = F.col("o_totalprice")
    levels = [F.when(price >= i * 40000, F.sqrt(price)).alias(f"level_{i}") for i in range(14)]
    wide = _table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority", F.sqrt(price).alias("root"), *levels)
    channels = ["root", *[f"level_{i}" for i in range(14)]]
    stats = profile.channel_stats(wide, ["o_orderstatus", "o_orderpriority"], channels)
    none = profile.channel_stats(wide.where(price < 0), [], channels[1:]).withColumns(
        {k: F.lit(None).cast("string") for k in ("o_orderstatus", "o_orderpriority")})
    return stats.unionByName(none).select("o_orderstatus", "o_orderpriority", "channel", "n", "n_null", _round("mean", 4), "min", "max")


def _gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    rows = _table(spark, sf_dir, "events").select(
        "user_id",
        # Each fifth session has no dilution of precision.
        F.when(kind.isin("click", "view") & (F.col("user_id") % 5 > 0), F.col("value") / 51).alias("dHdop"),
        F.when(kind != "error", F.col("value")).alias("dSNo"),
        F.when(kind == "error", F.col("value")).alias("dAge"),
        F.col("value").alias("Xdgps"),
        F.when(kind == "signup", F.col("value")).alias("Ydgps"),
    )
    return profile.channel_stats(rows, ["user_id"], ["dHdop", "dSNo", "dAge", "Xdgps", "Ydgps"])


_GPS = """
gps AS (SELECT user_id,
  CASE WHEN event_type IN ('click', 'view') AND user_id % 5 > 0 THEN value / 51 END AS dHdop,
  CASE WHEN event_type <> 'error' THEN value END AS dSNo,
  CASE WHEN event_type = 'error' THEN value END AS dAge,
  value AS Xdgps, CASE WHEN event_type = 'signup' THEN value END AS Ydgps FROM events),
gated AS (SELECT * FROM gps WHERE user_id IN (SELECT user_id FROM gps WHERE dHdop IS NOT NULL))"""


@_query(f"WITH {_GPS}" + " UNION ALL ".join(
    f"""SELECT user_id, '{c}' AS channel, round(avg({c}), 8) AS mean, round(stddev_samp({c}), 8) AS std,
        {"CASE WHEN avg(dHdop) < 1 THEN 'EXCELLENT' ELSE 'GOOD' END" if c == "dHdop" else "NULL"} AS grade
        FROM gated GROUP BY 1 HAVING count({c}) > 0""" for c, _ in ref.GPS_CHANNELS))
def q_quality_grade(spark, sf_dir):
    """Receiver quality, for sessions whose dilution of precision has data."""
    shown = profile.gated(_gps(spark, sf_dir), [c for c, _ in ref.GPS_CHANNELS], "dHdop", ["user_id"])
    grade = F.when(F.col("channel") == "dHdop", profile.quality_grade(F.col("mean")))
    return shown.select("user_id", "channel", _round("mean"), _round("std"), grade.alias("grade"))


@_query(f"WITH {_GPS}" + " UNION ALL ".join(
    f"SELECT user_id, '{c}' AS channel, round(stddev_samp({c}), 8) AS std FROM gated GROUP BY 1 HAVING count({c}) > 0"
    for c in ref.POSITION_CHANNELS))
def q_position_scatter(spark, sf_dir):
    """Spread of the position, under the same gate."""
    shown = profile.gated(_gps(spark, sf_dir), ref.POSITION_CHANNELS, "dHdop", ["user_id"])
    return shown.select("user_id", "channel", _round("std"))


_SETS = {"reading": ["reading"], "pair": ["reading", "second"]}


_WIDE = 70


@_query(f"""WITH flags AS (SELECT user_id, event_id, CAST(event_id AS DOUBLE) AS t, event_id % 7 = 0 AS low, event_id % 11 = 0 AS high FROM events),
flagged AS (SELECT user_id, 'last' AS plot_set, event_id, t, high AS gap FROM flags UNION ALL
            SELECT user_id, 'all', event_id, t, low OR high FROM flags),
live AS (SELECT user_id, plot_set FROM flagged GROUP BY 1, 2 HAVING NOT bool_and(gap)),
marked AS (SELECT f.*, CASE WHEN lag(gap) OVER w IS DISTINCT FROM gap THEN 1 ELSE 0 END AS new, lead(t) OVER w AS next
           FROM flagged f JOIN live USING (user_id, plot_set) WINDOW w AS (PARTITION BY user_id, plot_set ORDER BY event_id)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id, plot_set ORDER BY event_id) AS island FROM marked)
SELECT user_id, plot_set, min(t) AS t_start, coalesce(max(next), max(t)) AS t_end, count(*) AS n_rows
FROM numbered WHERE gap GROUP BY user_id, plot_set, island""")
def q_gap_wide(spark, sf_dir):
    """Missing spans over more channels than a number has bits: the first is missing in each seventh
    row, the last in each eleventh, those between never."""
    rows = _table(spark, sf_dir, "events").select(
        "user_id", "event_id", series.chunk_of("event_id").alias("chunk"), F.col("event_id").cast("double").alias("t"),
        F.when(F.col("event_id") % 7 != 0, 1.0).alias("c0"), *[F.lit(1.0).alias(f"c{i}") for i in range(1, _WIDE - 1)],
        F.when(F.col("event_id") % 11 != 0, 1.0).alias(f"c{_WIDE - 1}"),
    )
    sets = {"last": [f"c{_WIDE - 1}"], "all": [f"c{i}" for i in range(_WIDE)]}
    return series.gap_intervals(rows, ["user_id"], "chunk", "event_id", "t", sets)


@_query(f"""WITH {_SERIES}, live AS (
  SELECT user_id, count(reading) > 0 AS a, count(second) > 0 AS b FROM series GROUP BY 1),
flagged AS (
  SELECT s.user_id, 'reading' AS plot_set, event_id, sample, reading IS NULL AS gap FROM series s JOIN live USING (user_id) WHERE a
  UNION ALL
  SELECT s.user_id, 'pair', event_id, sample, (a AND reading IS NULL) OR (b AND second IS NULL)
  FROM series s JOIN live USING (user_id) WHERE a OR b),
marked AS (SELECT *, CASE WHEN lag(gap) OVER w IS DISTINCT FROM gap THEN 1 ELSE 0 END AS new,
                  lead(sample) OVER w AS next FROM flagged WINDOW w AS (PARTITION BY user_id, plot_set ORDER BY event_id)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id, plot_set ORDER BY event_id) AS island FROM marked)
SELECT user_id, plot_set, arg_min(sample, event_id) AS t_start,
       coalesce(arg_max(coalesce(next, -1), event_id) FILTER (next IS NOT NULL AND event_id = last), max(sample)) AS t_end,
       count(*) AS n_rows
FROM (SELECT *, max(event_id) OVER (PARTITION BY user_id, plot_set, island) AS last FROM numbered WHERE gap)
GROUP BY user_id, plot_set, island""")
def q_gap_intervals(spark, sf_dir):
    """Spans of rows in which any live channel of a set is missing."""
    return series.gap_intervals(_series(spark, sf_dir), ["user_id"], "chunk", "event_id", "sample", _SETS)


@_query("""SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2""")
def q_last_wins(spark, sf_dir):
    """Last value per key in row order."""
    return events.last_wins(_table(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id", ["value"])


@_query("""SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rank FROM events""")
def q_ordered_list(spark, sf_dir):
    """Entries of each session with their place in it."""
    rows = _table(spark, sf_dir, "events").select("user_id", "event_id", "value", series.chunk_of("event_id").alias("chunk"))
    return series.ordered_rank(rows, ["user_id"], "chunk", "event_id").drop("chunk")


@_query(f"""WITH {_SERIES}
SELECT user_id, 'reading' AS plot_set, 'reading' AS channel, round(avg(reading), 8) AS mean, round(stddev_samp(reading), 8) AS std
FROM series GROUP BY 1 HAVING count(reading) > 0
UNION ALL SELECT user_id, 'pair', 'reading', round(avg(reading), 8), round(stddev_samp(reading), 8)
FROM series GROUP BY 1 HAVING count(reading) > 0
UNION ALL SELECT user_id, 'pair', 'second', round(avg(second), 8), round(stddev_samp(second), 8)
FROM series GROUP BY 1 HAVING count(second) > 0""")
def q_plot_captions(spark, sf_dir):
    """Mean and deviation of each channel shown in a plot."""
    shown = spark.createDataFrame([(s, c) for s, names in _SETS.items() for c in names], "plot_set STRING, channel STRING")
    stats = profile.channel_stats(_series(spark, sf_dir), ["user_id"], ["reading", "second"])
    valid = stats.where(profile.has_data()).join(F.broadcast(shown), "channel")
    return valid.select("user_id", "plot_set", "channel", _round("mean"), _round("std"))


# -- fixed-width text ---------------------------------------------------------------------


def _rendered(spark: SparkSession, sf_dir: str, reading: Column) -> DataFrame:
    """Events as right-aligned lines, with one header line per user ahead of them."""
    rows = _table(spark, sf_dir, "events")
    shown = F.concat(
        F.lpad(F.col("event_id").cast("string"), 20, " "), F.lpad(reading, 30, " "), F.lpad("event_type", 30, " ")
    )
    body = rows.select("user_id", series.chunk_of("event_id").alias("block"), F.col("event_id").alias("mid"),
                       shown.alias("value"))
    header = "event_id".rjust(20) + "reading".rjust(30) + "Bin".rjust(30)
    first = rows.select("user_id").distinct().select(
        "user_id", F.lit(0).cast("bigint").alias("block"), F.lit(-1).cast("bigint").alias("mid"), F.lit(header).alias("value")
    )
    return body.unionByName(first)


def _parsed(spark: SparkSession, sf_dir: str, reading: Column) -> DataFrame:
    """Data lines with the layout found in the headers."""
    text = _rendered(spark, sf_dir, reading)
    headers = files.headers_by_scan(text, ["user_id"])
    body = files.without_headers(text, headers, ["user_id"])
    return fixed_width.attach_layout(body, fixed_width.layouts(headers), ["user_id"])


@_query(f"""WITH {_SERIES} SELECT user_id, event_id, event_type, reading FROM series""")
def q_fwf_roundtrip(spark, sf_dir):
    """Fixed-width lines, with a run of # for missing, read back as a typed table."""
    shown = F.when(F.col("event_type") == "error", "########").otherwise(F.col("value").cast("string"))
    wide = fixed_width.wide_table(_parsed(spark, sf_dir, shown), ["event_id", "reading", "Bin"], keep=["user_id"])
    return wide.select("user_id", F.col("event_id").cast("bigint").alias("event_id"), F.col("Bin").alias("event_type"), "reading")


@_query("""SELECT event_id, 0 AS cell, CAST(event_id AS DOUBLE) AS value, TRUE AS whole FROM events
UNION ALL SELECT event_id, 1, CASE event_type WHEN 'click' THEN NULL WHEN 'view' THEN NULL WHEN 'signup' THEN NULL
  WHEN 'error' THEN floor(value) ELSE value END, CASE event_type WHEN 'error' THEN TRUE END FROM events""")
def q_fwf_coerce(spark, sf_dir):
    """Cells that look like numbers to a cast but are none: 1.5d, 1.5x, 0x1p3."""
    number = F.col("value").cast("string")
    kind = F.col("event_type")
    shown = (
        F.when(kind == "click", F.concat(number, F.lit("d"))).when(kind == "view", F.concat(number, F.lit("x")))
        .when(kind == "signup", F.lit("0x1p3")).when(kind == "error", F.floor("value").cast("string")).otherwise(number)
    )
    parsed = _parsed(spark, sf_dir, shown).withColumn("event_id", F.col("mid"))
    cells = fixed_width.number_cells(parsed, ["event_id"])
    whole = F.when(F.col("whole") & F.col("value").isNotNull(), True)
    return cells.select("event_id", "cell", "value", whole.alias("whole"))


@_query(f"""WITH {_SERIES}
SELECT user_id, 'event_id' AS channel, 0 AS ordinal, count(*) AS n, 0 AS n_null, round(avg(event_id), 8) AS mean,
       CAST(min(event_id) AS DOUBLE) AS min, CAST(max(event_id) AS DOUBLE) AS max, TRUE AS all_integral FROM series GROUP BY 1
UNION ALL SELECT user_id, 'reading', 1, count(*), count(*) - count(reading), round(avg(reading), 8), min(reading), max(reading),
       FALSE FROM series GROUP BY 1""")
def q_fwf_profile(spark, sf_dir):
    """Statistics of every number channel of fixed-width lines."""
    shown = F.when(F.col("event_type") == "error", "########").otherwise(F.col("value").cast("string"))
    text = _rendered(spark, sf_dir, shown)
    headers = files.headers_by_scan(text, ["user_id"])
    laid_out = fixed_width.layouts(headers)
    body = fixed_width.attach_layout(files.without_headers(text, headers, ["user_id"]), laid_out, ["user_id"])
    counted = profile.count_cells(fixed_width.number_cells(body, ["user_id"]), ["user_id"])
    stats = profile.name_cells(counted, fixed_width.number_channels(laid_out, ["user_id"]), ["user_id"])
    return stats.select("user_id", "channel", "ordinal", "n", "n_null", _round("mean"), "min", "max", "all_integral")


@_query("""SELECT user_id, unnest(['event_id', 'reading', 'Bin']) AS channel, unnest([0, 1, 2]) AS ordinal
FROM (SELECT DISTINCT user_id FROM events)""")
def q_channels_present(spark, sf_dir):
    """Channels named by the header line of each session."""
    headers = files.headers_by_scan(_rendered(spark, sf_dir, F.col("value").cast("string")), ["user_id"])
    return fixed_width.channels_present(fixed_width.layouts(headers), ["user_id"])


# -- events as a log ----------------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log lines keyed by day, with a header line per day."""
    rows = _table(spark, sf_dir, "events")
    number = F.floor("value").cast("int")
    port = F.concat(F.lit("COM"), (3 + number % 8).cast("string"))
    names = F.array(*[F.lit(s) for s in [*_SENSOR_NAMES, "NEWDEV"]])
    sensor = F.get(names, F.floor(F.col("value") / 8).cast("int") % 9)
    rate = F.when(F.col("value") < 20, "0.0").otherwise(F.col("value").cast("string"))
    kind = F.col("event_type")
    message = (
        F.when(kind == "click", F.concat(F.lit("   "), port, F.lit(": Macro "), sensor, F.lit(" OK - 115200/None/8")))
        .when(kind == "view", F.concat(F.lit("Character Rate on "), port, F.lit(" is "), rate, F.lit(" chars/second")))
        .when(kind == "signup", F.concat(F.lit("      M"), (1 + number % 3).cast("string"), F.lit(" latches port "), port,
                                         F.lit(" runs macro "), sensor))
        .when(kind == "purchase", F.concat(F.lit("Health Warning: M"), (1 + number % 4).cast("string"), F.lit(" TimeO|")))
        .when(F.col("value") < 50, F.lit("Mux Timeout > 90% of clock!!!!!!!"))
        .otherwise(F.concat(F.lit("File: D:\\Data\\"), F.col("event_id").cast("string"), F.lit(".txt opened")))
    )
    day = F.date_format("ts", "yyyyMMdd").cast("int").alias("day")
    body = rows.select(day, series.chunk_of("event_id").alias("block"), F.col("event_id").alias("mid"),
                       F.concat(F.date_format("ts", "HH:mm:ss.S"), F.lit(": "), message).alias("value"))
    # On odd days the header has a time that counts, midnight.
    clock = F.when(F.col("day") % 2 == 1, " Time:0000").otherwise(" Time:00:00")
    opened = F.concat(F.lit("Log file opened at Date:"), F.col("day").cast("string"), clock)
    first = rows.select(day).distinct().select(
        "day", F.lit(0).cast("bigint").alias("block"), F.lit(-1).cast("bigint").alias("mid"), opened.alias("value")
    )
    return lines.split_log_lines(body.unionByName(first))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.facts(_log(spark, sf_dir), ["day"])


_LOG = f"""
log AS (SELECT *, CAST(strftime(ts, '%Y%m%d') AS INT) AS day, 'COM' || (3 + CAST(floor(value) AS INT) % 8) AS port,
  [{", ".join(f"'{s}'" for s in [*_SENSOR_NAMES, "NEWDEV"])}][1 + CAST(floor(value / 8) AS INT) % 9] AS sensor,
  CASE WHEN value < 20 THEN 0 ELSE value END AS rate, 'M' || (1 + CAST(floor(value) AS INT) % 3) AS mux,
  'M' || (1 + CAST(floor(value) AS INT) % 4) || ' TimeO' AS warning,
  strftime(ts, '%H:%M:%S') || '.' || ((millisecond(ts) % 1000) // 100) AS stamp,
  date_trunc('day', ts) + to_milliseconds(CAST(hour(ts) * 3600000 + minute(ts) * 60000 + (millisecond(ts) // 100) * 100 AS BIGINT)) AS tick
  FROM events),
ports AS (SELECT day, port, arg_max(sensor, event_id) AS sensor FROM log WHERE event_type = 'click' GROUP BY 1, 2),
rates AS (SELECT day, port, arg_max(rate, event_id) AS rate FROM log WHERE event_type = 'view' GROUP BY 1, 2),
connected AS (SELECT p.day, p.port, sensor, rate,
  CASE WHEN coalesce(rate, 0) > 0 THEN 'CONNECTED' ELSE 'DISCONNECTED' END AS status
  FROM ports p LEFT JOIN rates r ON p.day = r.day AND p.port = r.port)"""

_KNOWN = f"known(sensor, port, full_name) AS (VALUES {_values([(s[0], s[1], s[2]) for s in ref.SENSORS])})"


@_query(f"""WITH {_LOG} SELECT day, port, sensor, CAST(substr(port, 4) AS BIGINT) AS port_number FROM ports""")
def q_log_ports(spark, sf_dir):
    """Sensor on each port, the last line wins; with the number that sorts COM10 after COM9."""
    found = events.ports(_facts(spark, sf_dir), ["day"])
    return found.withColumn("port_number", health.port_number(F.col("port")))


@_query(f"""WITH {_LOG} SELECT day, port, rate FROM rates""")
def q_log_rates(spark, sf_dir):
    """Character rate of each port, the last line wins."""
    return events.rates(_facts(spark, sf_dir), ["day"])


@_query(f"""WITH {_LOG} SELECT day, event_id, mux, port, sensor FROM log WHERE event_type = 'signup'""")
def q_log_mux(spark, sf_dir):
    """Routing entries in log order, repeats kept."""
    found = events.mux_routes(_facts(spark, sf_dir), ["day"])
    return found.select("day", F.col("pos.mid").alias("event_id"), "mux", "port", "sensor").orderBy("day", "mux", "pos")


@_query(f"""WITH {_LOG} SELECT day, event_id, stamp AS ts, stamp || ': Mux Timeout > 90% of clock!!!!!!!' AS line
FROM log WHERE event_type = 'error' AND value < 50""")
def q_log_critical(spark, sf_dir):
    """Critical lines."""
    found = events.critical_lines(_facts(spark, sf_dir), ["day"])
    return found.select("day", F.col("pos.mid").alias("event_id"), "ts", "line")


@_query(f"""WITH {_LOG} SELECT day, event_id, stamp AS ts, 'D:\\Data\\' || event_id || '.txt' AS path
FROM log WHERE event_type = 'error' AND value >= 50""")
def q_log_opens(spark, sf_dir):
    """Files opened."""
    found = events.file_opens(_facts(spark, sf_dir), ["day"])
    return found.select("day", F.col("pos.mid").alias("event_id"), "ts", "path")


@_query(f"""WITH {_LOG} SELECT day, warning, count(*) AS n, min(event_id) AS first_event,
  CASE WHEN warning = 'M4 TimeO' THEN 'Unknown' ELSE m.meaning END AS meaning
FROM log LEFT JOIN (VALUES {_values(ref.WARNING_MEANINGS)}) AS m(word, meaning) ON m.word = warning
WHERE event_type = 'purchase' GROUP BY 1, 2, 5""")
def q_event_extract(spark, sf_dir):
    """Warnings found in log text, counted, most frequent first, with their meaning."""
    counted = events.warnings(_facts(spark, sf_dir), ["day"])
    told = health.with_default(counted, ref.warn_meaning(spark), "warning", "meaning", "Unknown")
    ordered = told.orderBy("day", F.desc("n"), "first_pos")
    return ordered.select("day", "warning", "n", F.col("first_pos.mid").alias("first_event"), "meaning")


@_query(f"""WITH {_LOG}, spans AS (
  SELECT day, CASE WHEN day % 2 = 1 THEN date_trunc('day', min(tick)) ELSE min(tick) END AS start_ts, max(tick) AS end_ts FROM log GROUP BY 1)
SELECT *, round(epoch(end_ts) - epoch(start_ts), 1) AS duration_s FROM spans""")
def q_session_window(spark, sf_dir):
    """Start, end and duration of a log from its stamps, and its header's time where that counts."""
    found = events.session_window(events.log_fields(_log(spark, sf_dir)), ["day"])
    return found.select("day", "start_ts", "end_ts", _round("duration_s", 1))


@_query(f"""WITH {_LOG} SELECT *, CAST(substr(port, 4) AS BIGINT) AS port_number FROM connected
-- Each port has a rate on some day; on a day of its own one has none.
UNION ALL SELECT -1, 'COM3', 'GEMK1', NULL, 'DISCONNECTED', 3""")
def q_connected_ports(spark, sf_dir):
    """Ports with a sensor, connected or not; no rate counts as 0."""
    facts = _facts(spark, sf_dir)
    found = events.ports(facts, ["day"])
    silent = found.limit(1).select(F.lit(-1).alias("day"), F.lit("COM3").alias("port"), F.lit("GEMK1").alias("sensor"))
    return health.connected_ports(found.unionByName(silent), events.rates(facts, ["day"]), ["day"])


@_query(f"""WITH {_LOG}, {_KNOWN} SELECT r.day, r.port, p.sensor, k.full_name, r.rate, CAST(substr(r.port, 4) AS BIGINT) AS port_number,
  CASE WHEN r.rate > 0 THEN 'CONNECTED' ELSE 'DISCONNECTED' END AS status
FROM rates r LEFT JOIN ports p ON r.day = p.day AND r.port = p.port LEFT JOIN known k ON k.sensor = p.sensor""")
def q_port_status(spark, sf_dir):
    """Ports that reported a rate; sensor and name may be unknown."""
    facts = _facts(spark, sf_dir)
    return health.port_status(events.rates(facts, ["day"]), events.ports(facts, ["day"]), ref.sensor_ref(spark), ["day"])


@_query(f"""WITH {_LOG}, {_KNOWN} SELECT d.day, k.sensor, k.port, k.full_name, r.rate,
  CASE WHEN coalesce(r.rate, 0) > 0 THEN 'CONNECTED' ELSE 'DISCONNECTED' END AS status
FROM (SELECT DISTINCT day FROM log) d CROSS JOIN known k LEFT JOIN rates r ON r.day = d.day AND r.port = k.port""")
def q_sensor_status(spark, sf_dir):
    """Every known sensor by its fixed port, in every session."""
    log = _log(spark, sf_dir)
    rates = events.rates(events.facts(log, ["day"]), ["day"])
    return health.sensor_status(log.select("day").distinct(), rates, ["day"]).drop("sensor_ordinal")


@_query("""SELECT event_type, user_id, value,
  coalesce(CASE event_type WHEN 'click' THEN 'pressed' WHEN 'view' THEN 'shown' END, 'Unknown') AS meaning FROM events""")
def q_unknown_default(spark, sf_dir):
    """Lookup with a default for words it does not know."""
    known = spark.createDataFrame([("click", "pressed"), ("view", "shown")], "event_type STRING, meaning STRING")
    rows = _table(spark, sf_dir, "events").select("event_type", "user_id", "value")
    return health.with_default(rows, known, "event_type", "meaning", "Unknown")


_CHANNELS = {
    "Mag1": "CASE WHEN event_type <> 'error' THEN value END",
    "Mag1D": "value",
    "Mag2": "CAST(NULL AS DOUBLE)",
    "Mag2D": "CAST(NULL AS DOUBLE)",
    "Ralt": "value",
    "MagL": "CASE WHEN value > 400 THEN value END",
    "Roll": "CAST(NULL AS DOUBLE)",
    "Pitch": "CASE WHEN value > 350 THEN value END",
    "Vlf1": "CAST(NULL AS DOUBLE)",
    "Sk": "CASE WHEN value > 300 THEN value END",
}
_MAG = [c for c in _CHANNELS if c != "Sk"]


def _channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics per day of channels of every state."""
    rows = _table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").cast("int").alias("day"),
        *[F.expr(e).alias(c) for c, e in _CHANNELS.items()],
    )
    return profile.channel_stats(rows, ["day"], list(_CHANNELS))


_STATS = "counts AS (" + " UNION ALL ".join(
    f"SELECT day, '{c}' AS channel, count(*) AS n, count(*) - count({e}) AS n_null FROM log GROUP BY 1"
    for c, e in _CHANNELS.items()) + ")"
_MAPPING = f"mapping(sensor, channel, ordinal) AS (VALUES {_values(_MAPPED)})"


@_query(f"""WITH {_LOG}, {_STATS}, {_MAPPING}, seen AS (
  SELECT c.day, c.port, c.sensor, c.status, m.channel, m.ordinal,
         CASE WHEN m.channel IS NULL THEN NULL WHEN s.n IS NULL THEN 'ABSENT' WHEN s.n_null = s.n THEN 'ALL_NaN'
              WHEN s.n_null > 0 THEN 'PARTIAL' ELSE 'OK' END AS state,
         -- Half to even, on whole numbers.
         1000 * s.n_null // s.n + CASE WHEN 2 * (1000 * s.n_null % s.n) > s.n
           OR (2 * (1000 * s.n_null % s.n) = s.n AND (1000 * s.n_null // s.n) % 2 = 1) THEN 1 ELSE 0 END AS tenths
  FROM connected c LEFT JOIN mapping m ON m.sensor = c.sensor
  LEFT JOIN counts s ON s.day = c.day AND s.channel = m.channel AND s.channel <> 'Sk')
SELECT day, port, sensor, status AS log_status, count(channel) AS n_channels,
       string_agg(channel || ':' || state || CASE WHEN state = 'PARTIAL' THEN '(' || (tenths // 10) || '.' || (tenths % 10) || '%)' ELSE '' END,
                  '; ' ORDER BY ordinal) AS channel_states, CAST(substr(port, 4) AS BIGINT) AS port_number,
       CASE WHEN status = 'DISCONNECTED' AND coalesce(bool_or(state = 'OK'), FALSE) THEN 'MISMATCH'
            WHEN status = 'CONNECTED' AND coalesce(bool_and(state IN ('ALL_NaN', 'ABSENT')), FALSE) THEN 'MISMATCH'
            ELSE 'OK' END AS verdict
FROM seen GROUP BY 1, 2, 3, 4""")
def q_cross_check(spark, sf_dir):
    """Logged status of each port against the data of its sensor."""
    facts = _facts(spark, sf_dir)
    connected = health.connected_ports(events.ports(facts, ["day"]), events.rates(facts, ["day"]), ["day"])
    stats = _channels(spark, sf_dir).where(F.col("channel").isin(_MAG))
    return health.cross_check(connected, stats, ref.sensor_channels(spark), ["day"])


@_query(f"""WITH {_LOG}, {_STATS}, {_MAPPING}, {_KNOWN},
shown AS (SELECT DISTINCT s.day, m.sensor FROM counts s JOIN mapping m ON m.channel = s.channel WHERE s.n_null < s.n
          UNION SELECT day, 'GDSpec' FROM counts WHERE channel = 'Sk' AND n_null < n)
SELECT d.day, k.sensor, k.full_name,
  CASE WHEN coalesce(r.rate, 0) = 0 THEN 'DISCONNECTED'
       WHEN w.sensor IS NOT NULL OR k.sensor = 'GDLas' THEN 'OK  connected' ELSE 'NO DATA' END AS status
FROM (SELECT DISTINCT day FROM log) d CROSS JOIN known k
LEFT JOIN rates r ON r.day = d.day AND r.port = k.port LEFT JOIN shown w ON w.day = d.day AND w.sensor = k.sensor""")
def q_compare_status(spark, sf_dir):
    """Sensors of every session with presence of their data."""
    log = _log(spark, sf_dir)
    rates = events.rates(events.facts(log, ["day"]), ["day"])
    sensors = health.sensor_status(log.select("day").distinct(), rates, ["day"])
    stats = _channels(spark, sf_dir)
    mag = stats.where(F.col("channel").isin(_MAG))
    return health.data_status(sensors, mag, stats.where("channel = 'Sk'"), ["day"]).drop("sensor_ordinal")


_COMPARED = {"sale": ["l_quantity", "l_discount", "l_tax", "returned_tax", "nothing"]}
_SALE = {"l_quantity": "l_quantity", "l_discount": "l_discount", "l_tax": "l_tax",
         "returned_tax": "CASE WHEN l_returnflag = 'R' THEN l_tax END"}


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(
        "l_linestatus", "l_returnflag", "l_quantity", "l_discount", "l_tax",
        F.expr(_SALE["returned_tax"]).alias("returned_tax"), F.lit(None).cast("double").alias("nothing"),
    )
    keys = ["l_linestatus", "l_returnflag"]
    stats = profile.channel_stats(rows, keys, _COMPARED["sale"]).withColumn("kind", F.lit("sale"))
    expected = compare.expand(stats.select(*keys).distinct(), _COMPARED)
    return compare.compare_means(expected, stats, keys, ["l_linestatus"])


_SALES = "compared AS (" + " UNION ALL ".join(
    f"""SELECT l_linestatus, l_returnflag, '{c}' AS channel, {i} AS channel_ordinal, round(avg({e}), 6) AS mean,
        round(stddev_samp({e}), 6) AS std, CASE WHEN count({e}) > 0 THEN 'DATA' ELSE 'NO DATA' END AS state
        FROM lineitem GROUP BY 1, 2""" for i, (c, e) in enumerate(_SALE.items())) + ")"


@_query(f"WITH {_SALES} SELECT * FROM compared")
def q_compare_means(spark, sf_dir):
    """Mean and deviation per channel and session; a channel without data anywhere is left out."""
    return _sales(spark, sf_dir).select(
        "l_linestatus", "l_returnflag", "channel", "channel_ordinal", _round("mean", 6), _round("std", 6), "state"
    )


@_query(f"""WITH {_SALES} SELECT l_linestatus, channel, """ + ", ".join(
    f"""max(CASE WHEN l_returnflag = '{s}' THEN mean END) AS "{s}_mean",
        max(CASE WHEN l_returnflag = '{s}' THEN std END) AS "{s}_std" """ for s in "ANR") +
    "FROM compared GROUP BY 1, 2")
def q_compare(spark, sf_dir):
    """The same side by side, one pair of columns per session."""
    values = {"mean": F.round("mean", 6), "std": F.round("std", 6)}
    return compare.side_by_side(_sales(spark, sf_dir), ["l_linestatus", "channel"], "l_returnflag", ["A", "N", "R"], values)


@_query(f"""WITH {_LOG} SELECT day, CASE WHEN day % 2 = 1 THEN date_trunc('day', min(tick)) ELSE min(tick) END AS start_ts,
  round(epoch(max(tick)) - epoch(CASE WHEN day % 2 = 1 THEN date_trunc('day', min(tick)) ELSE min(tick) END), 1) AS duration_s,
  count(*) AS n_rows, count(*) FILTER (event_type = 'error' AND value < 50) AS n_critical,
  count(*) FILTER (event_type = 'purchase') AS n_warnings,
  count(*) FILTER (event_type = 'purchase' AND warning <> 'M4 TimeO') AS n_mux_timeouts FROM log GROUP BY 1""")
def q_summary(spark, sf_dir):
    """One row per session: start, duration, rows, critical lines, warnings."""
    log = _log(spark, sf_dir)
    facts = events.facts(log, ["day"])
    window = events.session_window(events.log_fields(log), ["day"])
    rows = _table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyyMMdd").cast("int").alias("day"))
    sizes = rows.agg(F.count("*").alias("n_rows"))
    critical = events.critical_lines(facts, ["day"]).groupBy("day").agg(F.count("*").alias("n_critical"))
    warned = events.warning_totals(events.warnings(facts, ["day"]), ["day"])
    joined = window.join(sizes, "day", "left").join(critical, "day", "left").join(warned, "day", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "n_critical", "n_warnings", "n_mux_timeouts")]
    return joined.select("day", "start_ts", _round("duration_s", 1), *counts)


@_query(f"""WITH {_LOG}, {_STATS} SELECT day, channel, n, n_null, round(100.0 * n_null / n, 8) AS pct_null
FROM counts WHERE channel IN ('Mag1', 'Mag2')""")
def q_magnetometer_gaps(spark, sf_dir):
    """Missing rows of the two magnetometers."""
    shown = _channels(spark, sf_dir).where(F.col("channel").isin("Mag1", "Mag2"))
    return shown.withColumn("pct_null", profile.percent_missing()).select("day", "channel", "n", "n_null", _round("pct_null"))


# -- configuration ------------------------------------------------------------------------


_LEVELS = 9


def _configs(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """Each order as a small configuration document: objects nine levels deep, one under a wrapper
    element, and a setting that is no object. With ``broken``, each seventh is cut short."""
    def item(tag: str | Column, *inside: Column | str, name: str = "Object") -> Column:
        parts = [F.lit(f'<{name} Tag="'), F.lit(tag) if isinstance(tag, str) else tag, F.lit('">')]
        return F.concat(*parts, *[F.lit(p) if isinstance(p, str) else p for p in inside], F.lit(f"</{name}>"))

    def value(content: Column) -> Column:
        return F.concat(F.lit("<Value> "), content, F.lit(" </Value>"))

    port = F.concat(F.lit("COM"), (3 + F.col("o_custkey") % 8).cast("string"), F.lit("STATE"))
    deep = F.lit("")
    for level in range(_LEVELS, 0, -1):
        deep = item(f"L{level}", value(F.lit(str(level))), deep)
    document = F.concat(
        F.lit("<Root>"),
        item("COMPNAME", value(F.col("o_orderpriority"))),
        item(port, value(F.col("o_orderstatus")), item("BAUD", value(F.col("o_custkey").cast("string")), name="Setting"),
             item("MACRO", value(F.lit("?"))),
             item("MACRO", value(F.col("o_orderpriority")), item("LOGLEVEL", value(F.lit("3"))))),
        item("NAVNAME", "<Value/>"), item("UNSET"), deep,
        F.lit("<Group>"), item("WRAPPED", value(F.lit("w"))), F.lit("</Group>"),
        item("COMPNAME", value(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))),
        F.lit("</Root>"),
    )
    if broken:
        document = F.when(F.col("o_orderkey") % 7 == 0, F.substring(document, 1, 200)).otherwise(document)
    # The table may be one partition: parsing takes all cores.
    orders = _table(spark, sf_dir, "orders").repartition(spark.sparkContext.defaultParallelism)
    texts = orders.select(F.col("o_orderkey").alias("session"), document.alias("xml"))
    return config_xml.parse_config(texts, "xml", ["session"])


_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"


@_query(f"""SELECT o_orderkey AS session, unnest(['COMPNAME', 'COM' || (3 + o_custkey % 8) || 'STATE', 'MACRO', 'LOGLEVEL', 'NAVNAME']) AS tag,
  unnest([{_PRICE}, o_orderstatus, o_orderpriority, '3', '']) AS value FROM orders
UNION ALL SELECT o_orderkey, 'L' || i, CAST(i AS VARCHAR) FROM orders, range(1, {_LEVELS + 1}) r(i)
UNION ALL SELECT o_orderkey, 'WRAPPED', 'w' FROM orders""")
def q_config_tags(spark, sf_dir):
    """Configuration trees flattened; the last object of a tag wins."""
    return config_xml.config_tags(_configs(spark, sf_dir), ["session"])


@_query("""SELECT o_orderkey AS session, 'COM' || (3 + o_custkey % 8) AS com, o_orderstatus AS state,
  CAST(o_custkey AS VARCHAR) AS baud, o_orderpriority AS macro FROM orders""")
def q_config_ports(spark, sf_dir):
    """Port settings in configuration trees."""
    return config_xml.config_ports(_configs(spark, sf_dir), ["session"])


@_query(f"""SELECT o_orderkey AS session, {_PRICE} AS compensation, '' AS nav_file, NULL AS clock_port, NULL AS web_host,
  NULL AS line_num, '3' AS log_level FROM orders""")
def q_config_summary(spark, sf_dir):
    """The six named settings, side by side."""
    return config_xml.config_summary(config_xml.config_tags(_configs(spark, sf_dir), ["session"]), ["session"])


@_query("SELECT o_orderkey AS session FROM orders WHERE o_orderkey % 7 = 0")
def q_config_broken(spark, sf_dir):
    """Configurations that cannot be read, a row each."""
    return config_xml.broken_configs(_configs(spark, sf_dir, broken=True), ["session"]).select("session")
