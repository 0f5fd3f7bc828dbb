"""Date functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DATE_IN_NAME = r"\d{4}-\d{2}-\d{2}"


def date_text_in_name(name: Column) -> Column:
    """First ISO date inside a file name, NULL when there is none."""
    return F.regexp_substr(name, F.lit(DATE_IN_NAME))


def parse_date(text: Column, strict: bool = False) -> Column:
    """ISO text to a date.  ``strict`` raises on bad text, otherwise it becomes NULL."""
    fmt = "yyyy-MM-dd"
    return F.to_date(text, fmt) if strict else F.try_to_date(text, fmt)


def date_of_name(name: Column) -> Column:
    """Date in a file name; the pattern already fixed the format, so a plain cast is enough."""
    return date_text_in_name(name).try_cast("date")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def weekday_number(day: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(day).cast("bigint")


def week_start(day: Column) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(day, "WEEK")


def week_label(day: Column) -> Column:
    """Calendar year with ISO week number.

    The two disagree around New Year, so one Monday-to-Sunday week can carry two labels; the weekly
    roll-up groups on both start and label and therefore keeps the two parts apart.
    """
    return F.concat(F.date_format(day, "yyyy"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MONTH")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM yyyy")


def long_date(day: Column) -> Column:
    return F.date_format(day, "MMMM dd, yyyy")


def days_ago(day: Column, as_of: Column) -> Column:
    return F.datediff(as_of, day).cast("bigint")


def date_series(start: Column, end: Column) -> Column:
    """Array of every day from start to end, both included; empty when end precedes start."""
    step = F.expr("interval 1 day")
    return F.when(start <= end, F.sequence(start, end, step)).otherwise(F.array().cast("array<date>"))


def day_hash(as_of: Column, *parts: Column) -> Column:
    """64-bit hash that changes once per day and is independent of row order and partitioning."""
    return F.xxhash64(*parts, F.unix_date(as_of))


def uniform_of_hash(hashed: Column, low: float, high: float) -> Column:
    """Map a 64-bit hash to a double in [low, high) using its low 53 bits."""
    unit = hashed.bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / F.lit(float(1 << 53))
    return unit * F.lit(high - low) + F.lit(low)
