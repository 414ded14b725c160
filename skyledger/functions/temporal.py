"""Date codes, hours of day and time differences as Column expressions.

Only wall-clock arithmetic is used. ``date_format``, ``unix_micros`` and
``timestampdiff`` first convert a TIMESTAMP_NTZ to the session zone, which
shifts values around a daylight-saving change, so none of them appears here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS = "decimal(18,6)"  # a duration in seconds, exact to the microsecond
SECONDS_SUM = "decimal(28,6)"
SECONDS_PER_HOUR = 3600
SECONDS_PER_DAY = 24 * 3600


def wall_clock(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def calendar_day(ts: Column) -> Column:
    """The day as DATE: what the engine groups and shuffles by."""
    return ts.cast("date")


def calendar_month(ts: Column) -> Column:
    """First day of the month as DATE."""
    return F.trunc(ts.cast("date"), "MM")


def day_id(ts: Column) -> Column:
    """``2024-1-5``: year, month and day without padding."""
    part = lambda f: f(ts).cast("string")
    return F.concat(part(F.year), F.lit("-"), part(F.month), F.lit("-"), part(F.dayofmonth))


def month_id(ts: Column) -> Column:
    """``202401``: year, then the month in two digits."""
    return (F.year(ts) * 100 + F.month(ts)).cast("string")


def hour_code(ts: Column) -> Column:
    """``16:30:02``, or ``[invalid date]`` where there is no time."""
    clock = F.substring(wall_clock(ts).cast("string"), 12, 8)
    return F.coalesce(clock, F.lit("[invalid date]"))


def slot_hour(ts: Column) -> Column:
    """Hour of day; minutes are dropped."""
    return F.hour(wall_clock(ts))


def seconds_between(start: Column, end: Column) -> Column:
    """Signed, exact seconds from ``start`` to ``end``; NULL if either is."""
    return (wall_clock(end) - wall_clock(start)).cast(SECONDS)


def duration_parts(name: str, interval: str) -> dict[str, str]:
    """A duration as two BIGINTs to be summed: whole seconds and microseconds.

    Both have the sign of the duration. Sums of wide decimals rewrite a byte
    array per row, and sums of microseconds alone leave BIGINT at 292 thousand
    years, which a hot key reaches; these sums are cheap and exact up to nine
    trillion rows.
    """
    return {
        f"{name}_sec": f"cast({interval} as bigint)",
        f"{name}_us": f"cast(extract(second from {interval}) * 1000000 as bigint) % 1000000",
    }


def seconds_of(name: str) -> Column:
    """Exact seconds from the (summed) parts of a duration."""
    return F.expr(
        f"cast(cast({name}_sec as decimal(28,6)) + cast({name}_us as decimal(20,0)) * 0.000001BD as {SECONDS_SUM})"
    )


def day_columns(day: Column) -> list[Column]:
    """The columns of one ``days`` row."""
    return [day_id(day).alias("day_id"), F.dayofmonth(day).alias("day"), month_id(day).alias("month_id")]


def month_columns(month: Column) -> list[Column]:
    """The columns of one ``months`` row."""
    return [month_id(month).alias("month_id"), F.month(month).alias("month"), F.year(month).alias("year")]
