"""Facts in an event log.

All patterns are projected in one pass over the lines. Each is tried only on lines that
hold its fixed words, found by a plain byte search.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveypulse import SESSION_KEYS
from surveypulse.functions.clock import after_midnight, midnight, tenths_of_day
from surveypulse.functions.text import strip
from surveypulse.reference import MUX_TIMEOUTS

# The patterns of the log.
STAMP = r"^(\d{2}:\d{2}:\d{2}\.\d):"
PORT_SENSOR = r"(?U)COM(\d+): Macro (\w+) OK"
PORT_RATE = r"Character Rate on (COM\d+) is ([\d.]+) chars/second"
MUX_ROUTE = r"(?U)(M\d) latches port (COM\d+) runs macro (\w+)"
WARNING = r"(?s)Health Warning: (.+?)\|"
CRITICAL = "!!!!"
FILE_OPENED = r"(?s)File: (.+?) opened"
HEADER_DATE = r"Date:(\d{8})"
HEADER_TIME = r"Date:\d{8} Time:(\d{4})"
WORDS = ("Macro ", "Character Rate", " latches port ", "Health Warning: ", CRITICAL, "File: ")


def _match(pattern: str, words: str, group: int, line: str = "value") -> Column:
    """A group of the first match; NULL without one."""
    found = F.when(F.contains(line, F.lit(words)), F.regexp_extract(line, pattern, group))
    return F.nullif(found, F.lit(""))


def _stripped_match(pattern: str, words: str, line: str = "value") -> Column:
    """Like :func:`_match` for a group that may be empty once stripped."""
    whole = _match(pattern, words, 0, line)
    return F.when(whole.isNotNull(), strip(F.regexp_extract(line, pattern, 1)))


def log_fields(lines: DataFrame) -> DataFrame:
    """Add one column per fact; NULL where the line does not state it. No shuffle."""
    stamp = F.nullif(F.regexp_extract("value", STAMP, 1), F.lit(""))
    return lines.withColumns(
        {
            "ts": stamp,
            "tenths": tenths_of_day(stamp),
            "port": F.concat(F.lit("COM"), _match(PORT_SENSOR, "Macro ", 1)),
            "sensor": _match(PORT_SENSOR, "Macro ", 2),
            "rate_port": _match(PORT_RATE, "Character Rate", 1),
            "rate": _match(PORT_RATE, "Character Rate", 2).try_cast("double"),
            "mux": _match(MUX_ROUTE, " latches port ", 1),
            "mux_port": _match(MUX_ROUTE, " latches port ", 2),
            "mux_sensor": _match(MUX_ROUTE, " latches port ", 3),
            "warning": _stripped_match(WARNING, "Health Warning: "),
            "critical": F.when(F.contains("value", F.lit(CRITICAL)), F.make_valid_utf8(strip(F.col("value")))),
            "opened": F.make_valid_utf8(_stripped_match(FILE_OPENED, "File: ")),
        }
    )


def facts(lines: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Lines that may state a fact, with their fields and ``pos``, the order of lines.

    Chosen by the fixed words alone, so that a table of one fact computes the patterns of
    that fact only. A line may still state nothing; the tables below drop it.
    """
    worded = [F.contains("value", F.lit(w)) for w in WORDS]
    return log_fields(lines.where(reduce(or_, worded))).select(
        *keys, F.struct("block", "mid", "part").alias("pos"), "ts", "port", "sensor", "rate_port", "rate",
        "mux", "mux_port", "mux_sensor", "warning", "critical", "opened",
    )


def last_wins(df: DataFrame, keys: Iterable[str], order: str, values: Iterable[str]) -> DataFrame:
    """Values of the last row per key; partial results are merged before the shuffle."""
    values = list(values)
    kept = F.struct(*values) if len(values) > 1 else F.col(values[0])
    last = df.groupBy(*keys).agg(F.max_by(kept, order).alias("_last"))
    if len(values) == 1:
        return last.withColumnRenamed("_last", values[0])
    return last.select(*keys, "_last.*")


def ports(facts: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Sensor on each port, by the last line that says so."""
    return last_wins(facts.where("port IS NOT NULL"), [*keys, "port"], "pos", ["sensor"])


def rates(facts: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Character rate of each port, by the last line that says so; NULL if it is no number."""
    told = facts.where("rate_port IS NOT NULL").select(*keys, F.col("rate_port").alias("port"), "pos", "rate")
    return told.groupBy(*keys, "port").agg(F.max_by("rate", "pos").alias("rate"))


def mux_routes(facts: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Routing entries, repeats kept; sort by ``mux, pos`` to read them."""
    return facts.where("mux IS NOT NULL").select(
        *keys, "pos", "mux", F.col("mux_port").alias("port"), F.col("mux_sensor").alias("sensor")
    )


def warnings(facts: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Count and first appearance per warning text.

    Counted by file piece first: the order inside a piece is one number, which Spark
    aggregates in place, and only one row per piece and text is left to merge.
    """
    keys = list(keys)
    told = facts.where("warning IS NOT NULL").select(*keys, "warning", "pos.*")
    pieces = told.groupBy(*keys, "warning", "block").agg(F.count("*").alias("n"), F.min("mid").alias("mid"))
    return pieces.groupBy(*keys, "warning").agg(
        F.sum("n").alias("n"), F.min(F.struct("block", "mid")).alias("first_pos")
    )


def critical_lines(facts: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    return facts.where("critical IS NOT NULL").select(*keys, "pos", "ts", F.col("critical").alias("line"))


def file_opens(facts: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    return facts.where("opened IS NOT NULL").select(*keys, "pos", "ts", F.col("opened").alias("path"))


def session_window(fields: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Start, end and duration of each session.

    The survey date comes from the first line of the log only. Start is the header's time if
    the header has one, otherwise the earliest stamp; end is the latest stamp.

    One aggregate over file pieces, on numbers only: the first line is recognised afterwards,
    as the piece whose first dated line is also its first line.
    """
    keys = list(keys)
    lead = F.col("part") == 0
    date = F.when(lead, _match(HEADER_DATE, "Date:", 1)).cast("int")
    clock = F.when(lead, F.coalesce(_match(HEADER_TIME, "Date:", 1).cast("int"), F.lit(-1)))
    dated = fields.select(
        *keys, "block", "mid", "tenths", date.alias("date"), clock.alias("clock"),
    )
    has_date = F.col("date").isNotNull()
    dated_mid = F.when(has_date, F.col("mid"))
    pieces = dated.groupBy(*keys, "block").agg(
        F.min("mid").alias("first_mid"), F.min(dated_mid).alias("dated_mid"),
        F.min_by("date", dated_mid).alias("date"), F.min_by("clock", dated_mid).alias("clock"),
        F.min("tenths").alias("lo"), F.max("tenths").alias("hi"),
    )
    in_header = F.col("dated_mid") == F.col("first_mid")
    whole = pieces.groupBy(*keys).agg(
        F.min_by(F.when(in_header, F.col("date")), "block").alias("date"),
        F.min_by(F.when(in_header & (F.col("clock") >= 0), F.col("clock")), "block").alias("clock"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )
    day = midnight(F.col("date"))
    hour, minute = F.floor(F.col("clock") / 100).cast("int"), (F.col("clock") % 100).cast("int")
    header = F.when((hour < 24) & (minute < 60), (hour * 60 + minute) * 600)
    timed = whole.select(
        *keys, day.alias("_day"), F.coalesce(header, "lo").alias("_start"), F.col("hi").alias("_end")
    )
    spans = F.col("_day").isNotNull()
    return timed.select(
        *keys,
        after_midnight(F.col("_day"), F.col("_start")).alias("start_ts"),
        after_midnight(F.col("_day"), F.col("_end")).alias("end_ts"),
        F.when(spans, (F.col("_end") - F.col("_start")) / 10.0).alias("duration_s"),
    )


def warning_totals(warnings: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """All warnings, and those that are a mux time-out by exactly these names."""
    timeout = F.when(F.col("warning").isin(MUX_TIMEOUTS), F.col("n")).otherwise(0)
    return warnings.groupBy(*keys).agg(F.sum("n").alias("n_warnings"), F.sum(timeout).alias("n_mux_timeouts"))
