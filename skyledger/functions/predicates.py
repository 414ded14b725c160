"""Row rules of flights, maintenance and reports as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.temporal import seconds_between

# Fixed values.
DELAY_SECONDS = 15 * 60  # a delay counts only beyond this, strictly
MAREP, PIREP = "MAREP", "PIREP"
NAMED_MANUFACTURERS = ("Airbus", "Boeing")  # the only ones the raw KPIs name
MISSING_REPORTER = "None"  # how a missing reporter id is spelled


def flagged(flag: Column) -> Column:
    """A boolean where NULL means false."""
    return F.coalesce(flag, F.lit(False))


def effectively_cancelled(cancelled: Column, departure: Column, arrival: Column) -> Column:
    """Flagged as cancelled, or without an actual departure or arrival."""
    return flagged(cancelled) | departure.isNull() | arrival.isNull()


def is_swapped(departure: Column, arrival: Column) -> Column:
    """Arrival strictly before departure."""
    return arrival < departure


def delay_seconds(planned: Column, actual: Column) -> Column:
    return seconds_between(planned, actual)


def is_delayed(delay: Column) -> Column:
    return delay > F.lit(DELAY_SECONDS)


def counted_delay(delay: Column) -> Column:
    """The delay if it counts as one, else zero."""
    return F.when(is_delayed(delay), delay).otherwise(F.lit(0))


def reporter_key(reporter_id: Column) -> Column:
    """Reporter id of a report as text, untrimmed."""
    return F.coalesce(reporter_id.cast("string"), F.lit(MISSING_REPORTER))


def is_marep(report_class: Column) -> Column:
    return flagged(report_class == MAREP)


def is_pirep(report_class: Column) -> Column:
    return flagged(report_class == PIREP)
