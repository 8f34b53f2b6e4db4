"""Clock windows and weekday sets as expressions; clocks are numbers such as 0730, days are lower-case names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DAYS

MIDNIGHT = 1440


def minutes(clock: Column) -> Column:
    return F.floor(clock / 100).cast("int") * 60 + (clock % 100).cast("int")


def clock(minute: Column) -> Column:
    return F.floor(minute / 60).cast("int") * 100 + (minute % 60).cast("int")


def parsed(text: Column) -> Column:
    """HH:MM as a clock; 24:00 is 2400; null for anything else."""
    h, m = F.regexp_extract(text, r"^(\d{1,2}):(\d{2})$", 1).try_cast("int"), F.regexp_extract(text, r"^(\d{1,2}):(\d{2})$", 2).try_cast("int")
    return F.when((h * 60 + m <= MIDNIGHT) & (m < 60), h * 100 + m)


def pieces(start: Column, end: Column) -> Column:
    """A window in minutes as same-day windows: one that runs past midnight is two; an end of 0 is midnight. Each with the days it lies after its start's."""
    stop = F.when(end == 0, MIDNIGHT).otherwise(end)
    one = lambda a, b, d: F.named_struct(F.lit("start"), a.cast("int"), F.lit("end"), b.cast("int"), F.lit("later"), F.lit(d))
    return F.when(start < stop, F.array(one(start, stop, 0))).when(start == stop, F.array().cast("array<struct<start:int,end:int,later:int>>")).otherwise(F.array(one(start, F.lit(MIDNIGHT), 0), one(F.lit(0), stop, 1)))


def utc(start: Column, end: Column, offset: Column) -> Column:
    """A local window, `offset` minutes ahead of UTC, as UTC windows with the days by which each shifts the local weekday."""
    a, b = start - offset, F.when(end == 0, MIDNIGHT).otherwise(end) - offset
    shift = F.floor(a / MIDNIGHT).cast("int")
    a, b = a - shift * MIDNIGHT, b - shift * MIDNIGHT
    one = lambda x, y, d: F.named_struct(F.lit("start"), x.cast("int"), F.lit("end"), y.cast("int"), F.lit("shift"), d.cast("int"))
    return F.when(b <= MIDNIGHT, F.array(one(a, b, shift))).otherwise(F.array(one(a, F.lit(MIDNIGHT), shift), one(F.lit(0), b - MIDNIGHT, shift + 1)))


def complement(start: Column, end: Column) -> Column:
    """The rest of the day beside a window in minutes, split at midnight."""
    return F.filter(F.array(F.struct(F.lit(0).alias("start"), start.cast("int").alias("end")), F.struct(F.when(end == 0, MIDNIGHT).otherwise(end).cast("int").alias("start"), F.lit(MIDNIGHT).alias("end"))), lambda w: w["start"] < w["end"])


def _index(day: Column) -> Column:
    return F.array_position(F.array(*[F.lit(d) for d in DAYS]), day).cast("int") - 1


def _names(index: Column) -> Column:
    return F.transform(F.array_sort(F.array_distinct(index)), lambda i: F.get(F.array(*[F.lit(d) for d in DAYS]), i))


def in_order(days: Column) -> Column:
    """A day-set once each, Monday first."""
    return _names(F.transform(days, _index))


def shifted(days: Column, by: Column) -> Column:
    """A day-set moved by some days, in calendar order."""
    return _names(F.transform(days, lambda d: F.pmod(_index(d) + by, F.lit(7)).cast("int")))


def day_range(first: Column, last: Column) -> Column:
    """All days from one to another, over the week's end if need be, in calendar order."""
    n = F.pmod(_index(last) - _index(first), F.lit(7))
    return _names(F.transform(F.sequence(F.lit(0), n), lambda i: F.pmod(_index(first) + i, F.lit(7)).cast("int")))


def week_row(day: Column) -> Column:
    """The Monday that a day's calendar row begins with."""
    return F.date_sub(day, (F.weekday(day)).cast("int"))
