"""Lenient date parsing on wall-clock time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layouts tried after ISO 8601; month-first wins where both readings are valid.
OTHER_LAYOUTS = (
    "yyyyMMdd",
    "yyyyMMdd'T'HHmmss",
    "yyyy/M/d[ H:mm[:ss]]",
    "M/d/yyyy[ H:mm[:ss]]",
    "d/M/yyyy[ H:mm[:ss]]",
    "M-d-yyyy[ H:mm[:ss]]",
    "d-M-yyyy[ H:mm[:ss]]",
    "d MMM yyyy[ H:mm[:ss]]",
    "d MMMM yyyy[ H:mm[:ss]]",
    "MMM d, yyyy[ H:mm[:ss]]",
    "MMMM d, yyyy[ H:mm[:ss]]",
    "MMM d yyyy[ H:mm[:ss]]",
    "d-MMM-yyyy[ H:mm[:ss]]",
)

DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd'T'HH:mm:ss"

_OFFSET = r"(Z|[+-]\d{2}(?::?\d{2})?)$"


def wall_clock(text: Column) -> Column:
    """Parse to TIMESTAMP_NTZ, dropping any offset; null when unreadable.

    Give the result its own column before using it more than once: the list of
    layouts makes it a large expression.
    """
    other = [F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in OTHER_LAYOUTS]
    return F.when(text != "", F.coalesce(text.try_cast("timestamp_ntz"), *other))


def offset_text(text: Column) -> Column:
    """``Z`` or ``+hh:mm`` at the end of a date-time, else an empty string."""
    ending = F.regexp_extract(F.right(text, F.lit(6)), _OFFSET, 1)
    return F.when(F.contains(text, F.lit(":")), ending).otherwise("")


def _offset_seconds(offset: Column) -> Column:
    digits = F.replace(offset, F.lit(":"), F.lit(""))
    size = (
        F.coalesce(F.substring(digits, 2, 2).try_cast("int"), F.lit(0)) * 3600
        + F.coalesce(F.substring(digits, 4, 2).try_cast("int"), F.lit(0)) * 60
    )
    return F.when(offset.isin("Z", ""), F.lit(0)).otherwise(
        F.when(offset.startswith("-"), -size).otherwise(size)
    )


def _clock_seconds(wall: Column) -> Column:
    whole = (
        F.unix_date(wall.cast("date")).cast("long") * 86400
        + F.hour(wall) * 3600
        + F.minute(wall) * 60
        + F.second(wall)
    )
    # The sub-second part is the same in every time zone.
    fraction = F.pmod(F.unix_micros(wall.cast("timestamp")), F.lit(1_000_000))
    return whole + fraction / F.lit(1_000_000.0)


def elapsed_seconds(
    start_offset: Column, end_offset: Column, start_wall: Column, end_wall: Column
) -> Column:
    """Seconds from start to end, given wall clocks and offset texts.

    Null when either end is unreadable or only one of them carries an offset.
    """
    wall = _clock_seconds(end_wall) - _clock_seconds(start_wall)
    shift = _offset_seconds(end_offset) - _offset_seconds(start_offset)
    return F.when((start_offset == "") == (end_offset == ""), wall - shift)
