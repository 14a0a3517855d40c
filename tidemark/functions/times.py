"""Time expressions. Every function takes and returns columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(value: Column) -> Column:
    """Text or timestamp to timestamp; text that is no time becomes null."""
    return F.try_to_timestamp(value)


def effective_time(event_time: Column, arrival_time: Column) -> Column:
    """When the action happened; when it arrived, if that is unknown."""
    return F.coalesce(parse_time(event_time), parse_time(arrival_time))


def epoch_seconds(value: Column) -> Column:
    return F.unix_seconds(value)


def time_cell(value: Column, seconds: int) -> Column:
    """Number of the fixed-width interval a timestamp falls in."""
    return F.floor(F.unix_seconds(value) / F.lit(seconds))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Distance counted in whole clock seconds."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def micros_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def plus_seconds(value: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(value) + seconds.cast("long") * F.lit(1_000_000))


def day_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def partition_date(year: Column, month: Column, day: Column) -> Column:
    return F.make_date(year, month, day)


def date_part(text: Column, place: int) -> Column:
    """Part ``place`` (from 1) of a text such as 2024-10-15 as a number; null where it is none."""
    return F.split_part(text, F.lit("-"), F.lit(place)).try_cast("int")


def on_day(text: Column, year: str = "year", month: str = "month", day: str = "day") -> Column:
    """Do the partition columns hold the day that ``text`` names? With a literal the
    parts are folded before the scan, so partitions are still pruned."""
    return (F.col(year) == date_part(text, 1)) & (F.col(month) == date_part(text, 2)) & (F.col(day) == date_part(text, 3))


def duration_label(seconds: Column) -> Column:
    """252 -> ``4m 12s``; hours are not split off."""
    whole = F.floor(seconds)
    return F.format_string("%dm %02ds", F.floor(whole / 60), whole % 60)
