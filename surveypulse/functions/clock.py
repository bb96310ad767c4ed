"""Time-of-day expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_of_day(hhmmss: Column) -> Column:
    """``HHMMSS.sss`` held in a double, as seconds since midnight. No range check.

    Hours are cut towards zero and remainders are never negative, so that a garbled time still
    gives the known number; no step can overflow.
    """
    part = hhmmss / 10000
    hours = F.when(hhmmss < 0, F.ceil(part)).otherwise(F.floor(part)).cast("double")
    minutes = F.floor(F.pmod(hhmmss, F.lit(10000.0)) / 100)
    return hours * 3600 + minutes * 60 + F.pmod(hhmmss, F.lit(100.0))


def tenths_of_day(stamp: Column) -> Column:
    """``HH:MM:SS.d`` text as tenths of a second since midnight; NULL when out of range."""
    hour = F.substring(stamp, 1, 2).try_cast("int")
    minute = F.substring(stamp, 4, 2).try_cast("int")
    second = F.substring(stamp, 7, 2).try_cast("int")
    tenth = F.substring(stamp, 10, 1).try_cast("int")
    in_range = (hour < 24) & (minute < 60) & (second < 60)
    return F.when(in_range, ((hour * 60 + minute) * 60 + second) * 10 + tenth)


def midnight(yyyymmdd: Column) -> Column:
    """An eight-digit date as a zone-less timestamp; NULL when there is no such day."""
    year = F.floor(yyyymmdd / 10000).cast("int")
    month = F.floor(yyyymmdd % 10000 / 100).cast("int")
    day = (yyyymmdd % 100).cast("int")
    zero = F.lit(0)
    return F.when(year > 0, F.try_make_timestamp_ntz(year, month, day, zero, zero, zero))


def after_midnight(day: Column, tenths: Column) -> Column:
    """The moment ``tenths`` of a second into ``day``."""
    zero = F.lit(0)
    return day + F.make_dt_interval(zero, zero, zero, (tenths / 10).cast("decimal(18,6)"))
