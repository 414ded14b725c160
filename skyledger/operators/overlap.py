"""BR-21: one aircraft cannot do two things at once.

Within one aircraft and scheduled day, events are taken in order (flights by
actual departure, then maintenance by scheduled departure) and an event is
accepted if its slot ``(start hour, end hour)`` overlaps no slot accepted
before. The outcome depends on the order, so no self-join gives it.

What makes it scale is that slots are whole hours, so a group has at most
24 * 24 distinct slots however many events it has, and that

* overlap is symmetric, so once a slot is accepted nothing that conflicts with
  it can be accepted later, and once it is rejected it stays rejected: the
  first event of each distinct slot decides for the slot;
* a slot with ``start < end`` overlaps itself, so only its first event can be
  accepted; a slot with ``start >= end`` never overlaps itself, so all its
  events share the fate of the first.

Hence the events are reduced to one row per distinct slot with a map-side
combined aggregate, and only those rows, at most 576 per aircraft and day, are
brought together and folded in order. A group with a third of all events costs
no more there than any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions import predicates as P
from skyledger.functions import temporal as t

FLIGHT, MAINTENANCE = 0, 1  # flights go first
GROUP = ["registration", "day"]
SLOT = ["start_hour", "end_hour"]

# The order of events, then what the measures need. Content after the row key
# makes the order total even where no row key is given.
EVENT = ["activity", "began", "row_key", *SLOT, "ended", "planned", "programmed"]
KEYED_ORDER = EVENT[:5]


def slots_overlap(start_1: Column, end_1: Column, start_2: Column, end_2: Column) -> Column:
    """Strict overlap: slots that only touch do not overlap."""
    return (start_1 < end_2) & (start_2 < end_1)


def overlaps_any(slot: Column, slots: Column) -> Column:
    """Whether ``slot`` overlaps any element of an array of slots."""
    return F.exists(
        slots,
        lambda other: slots_overlap(slot["start_hour"], slot["end_hour"], other["start_hour"], other["end_hour"]),
    )


def _row_key(df: DataFrame) -> Column:
    return F.col(schemas.ROW_KEY).cast("long") if schemas.ROW_KEY in df.columns else F.lit(None).cast("long")


def activity_events(flights: DataFrame, maintenance: DataFrame) -> DataFrame:
    """Flights and maintenance in one shape. Cancelled flights take no slot."""
    planned = t.wall_clock(F.col("scheduleddeparture"))
    departure, arrival = t.wall_clock(F.col("actualdeparture")), t.wall_clock(F.col("actualarrival"))
    cancelled = P.effectively_cancelled(F.col("cancelled"), departure, arrival)
    flown = flights.select(
        F.col("aircraftregistration").alias("registration"),
        t.calendar_day(planned).alias("day"),
        F.lit(FLIGHT).alias("activity"),
        departure.alias("began"),
        arrival.alias("ended"),
        planned.alias("planned"),
        F.lit(None).cast("boolean").alias("programmed"),
        cancelled.alias("cancelled"),
        _row_key(flights).alias("row_key"),
        F.when(~cancelled, t.slot_hour(departure)).alias("start_hour"),
        F.when(~cancelled, t.slot_hour(arrival)).alias("end_hour"),
    )
    until = t.wall_clock(F.col("scheduledarrival"))
    maintained = maintenance.select(
        F.col("aircraftregistration").alias("registration"),
        t.calendar_day(planned).alias("day"),
        F.lit(MAINTENANCE).alias("activity"),
        planned.alias("began"),
        until.alias("ended"),
        planned.alias("planned"),
        P.flagged(F.col("programmed")).alias("programmed"),
        F.lit(False).alias("cancelled"),
        _row_key(maintenance).alias("row_key"),
        t.slot_hour(planned).alias("start_hour"),
        t.slot_hour(until).alias("end_hour"),
    )
    return flown.unionByName(maintained)


def _event_measures(prefix: str, swap: bool) -> dict[str, str]:
    """What one accepted event adds, as SQL; NULL where it adds nothing."""
    began, ended, planned = f"{prefix}began", f"{prefix}ended", f"{prefix}planned"
    flight, programmed = f"{prefix}activity = {FLIGHT}", f"{prefix}programmed"
    # BR-23 puts the two times in order before hours and delay are taken.
    start, end = (f"least({began}, {ended})", f"greatest({began}, {ended})") if swap else (began, ended)
    delayed = f"{flight} and {start} - {planned} > interval {P.DELAY_SECONDS} seconds"
    durations = {
        "flight": f"case when {flight} then {end} - {start} end",
        "delay": f"case when {delayed} then {start} - {planned} end",
        "programmed": f"case when not {flight} and {programmed} then {ended} - {began} end",
        "unprogrammed": f"case when not {flight} and not {programmed} then {ended} - {began} end",
    }
    measures = {
        "take_offs": f"case when {flight} then 1 end",
        "delays": f"case when {delayed} then 1 end",
        "swapped": f"case when {flight} and {ended} < {began} then 1 end",
        "maintenances": f"case when not {flight} then 1 end",
    }
    for name, interval in durations.items():
        measures |= t.duration_parts(name, interval)
    return measures


MEASURES = tuple(_event_measures("", swap=True))  # all BIGINT


def _summed(condition: str, amount: str) -> Column:
    return F.expr(f"coalesce(sum(case when {condition} then {amount} end), 0)")


def distinct_slots(events: DataFrame) -> DataFrame:
    """One row per aircraft, day and slot; cancelled flights share a NULL slot.

    ``first`` is the earliest event. ``totals`` adds up all events and is there
    only for slots that do not overlap themselves.
    """
    repeats = F.col("start_hour") >= F.col("end_hour")
    measures = _event_measures("", swap=True)
    reduced = events.groupBy(*GROUP, *SLOT).agg(
        F.min(F.when(~F.col("cancelled"), F.struct(*EVENT))).alias("first"),
        F.count_if(F.col("activity") == FLIGHT).alias("flights"),
        F.count_if(F.col("activity") == MAINTENANCE).alias("services"),
        *[_summed("start_hour >= end_hour", measures[name]).alias(name) for name in MEASURES],
    )
    return reduced.select(
        *GROUP,
        *SLOT,
        "first",
        "flights",
        "services",
        F.when(repeats, F.struct(*MEASURES)).alias("totals"),
    )


def _taken(firsts: Column, none: Column) -> Column:
    """The accepted ones of an array of first events, in order.

    Most aircraft and days have one or two slots: those are decided by plain expressions, which are
    compiled; a fold is interpreted, event by event.
    """
    fold = F.aggregate(
        F.array_sort(F.filter(firsts, lambda event: event.isNotNull())),
        none,
        lambda taken, event: F.when(overlaps_any(event, taken), taken).otherwise(F.array_append(taken, event)),
    )
    one, two = F.get(firsts, F.lit(0)), F.get(firsts, F.lit(1))
    former, latter = F.least(one, two), F.greatest(one, two)
    apart = F.when(
        slots_overlap(former["start_hour"], former["end_hour"], latter["start_hour"], latter["end_hour"]), F.array(former)
    ).otherwise(F.array(former, latter))
    return (
        F.when((F.size(firsts) == 1) & one.isNotNull(), F.array(one))
        .when((F.size(firsts) == 2) & one.isNotNull() & two.isNotNull(), apart)
        .otherwise(fold)
    )


def decided_slots(events: DataFrame) -> DataFrame:
    """The greedy fold: each distinct slot with ``accepted`` and with ``taken``,
    the first events of all accepted slots of its aircraft and day.

    Slots are placed by aircraft and month (at most 31 * 577 rows) and gathered
    by day, so that grouping the result by day or by month needs no further
    shuffle. A slot travels as one column: whatever a query needs of it, the
    shuffle is the same and is shared within a query.
    """
    grouped = (
        distinct_slots(events).select(
            "registration",
            t.calendar_month(F.col("day")).alias("month"),
            "day",
            F.struct("first", "flights", "services", "totals").alias("slot"),
        )
        .repartition("registration", "month")
        .groupBy("registration", "month", "day")
        .agg(F.collect_list("slot").alias("slots"))
    )
    firsts = F.col("slots.first")
    first_type = grouped.select(firsts.alias("f")).schema["f"].dataType
    return (
        grouped.withColumn("taken", _taken(firsts, F.array().cast(first_type)))
        .select("registration", "month", "day", "taken", F.explode("slots").alias("slot"))
        .withColumn("accepted", F.array_contains("taken", F.col("slot.first")))
    )


def usage_by_day(decided: DataFrame) -> DataFrame:
    """Measures per aircraft and day under BR-21 and BR-23, from decided slots.

    ``flights`` and ``services`` count all events, rejected ones included.
    """
    first = _event_measures("slot.first.", swap=True)
    adds = "case when slot.totals is not null then slot.totals.{name} else {first} end"
    return (
        decided.groupBy("registration", "month", "day")
        .agg(
            F.sum("slot.flights").alias("flights"),
            F.sum("slot.services").alias("services"),
            F.expr("sum(case when slot.first is null then slot.flights else 0 end)").alias("cancellations"),
            *[_summed("accepted", adds.format(name=name, first=first[name])).alias(name) for name in MEASURES],
        )
    )


def usage_by_day_unruled(events: DataFrame) -> DataFrame:
    """The same measures with BR-21 and BR-23 off: every event counts."""
    measures = _event_measures("", swap=False)
    return (
        events.withColumn("month", t.calendar_month(F.col("day")))
        .groupBy("registration", "month", "day")
        .agg(
            F.count_if(F.col("activity") == FLIGHT).alias("flights"),
            F.count_if(F.col("activity") == MAINTENANCE).alias("services"),
            F.count_if("cancelled").alias("cancellations"),
            *[_summed("not cancelled", measures[name]).alias(name) for name in MEASURES],
        )
    )


def slot_decisions(decided: DataFrame, order: list[str]) -> DataFrame:
    """One row per distinct slot: the ``order`` columns of its first event, whether it was
    accepted, and the same columns of the first events of all accepted slots of that
    aircraft and day."""
    only = lambda event: F.struct(*[event[c].alias(c) for c in order])
    return decided.where(F.col("slot.first").isNotNull()).select(
        *GROUP,
        *[F.col(f"slot.first.{c}").alias(c) for c in SLOT],
        only(F.col("slot.first")).alias("first"),
        F.col("accepted").alias("slot_accepted"),
        F.transform("taken", only).alias("taken"),
    )


def event_decisions(events: DataFrame, keyed: bool, decided: DataFrame | None = None) -> DataFrame:
    """Accept or reject every event that takes a slot; ``decided``: the slots, if they are at hand.

    Rows are events if they carry a unique row key (``keyed``), which then also tells
    events apart, so that of the taken slots little else travels. Otherwise
    events alike in every column share a row and ``events`` and ``accepted``
    count them. ``existing_slots`` lists the distinct slots taken before.

    The join back is on (aircraft, day, slot). One of these may be hot, but the
    other side is unique on them, so adaptive execution can split it.
    """
    active = events.where(~F.col("cancelled"))
    if keyed:
        counted = active.withColumn("events", F.lit(1).cast("long"))
    else:
        counted = active.groupBy(*GROUP, *EVENT).agg(F.count("*").alias("events"))
    order = KEYED_ORDER if keyed else EVENT
    decisions = slot_decisions(decided_slots(events) if decided is None else decided, order)
    same_slot = reduce(
        lambda a, b: a & b,
        [F.col(f"e.{c}").eqNullSafe(F.col(f"d.{c}")) for c in [*GROUP, *SLOT]],
    )
    event = F.struct(*[F.col(f"e.{c}") for c in order])
    is_first = event.eqNullSafe(F.col("d.first"))
    accepted = (
        F.when(~F.col("d.slot_accepted"), F.lit(0))
        .when(F.col("e.start_hour") >= F.col("e.end_hour"), F.col("e.events"))
        .when(is_first, F.lit(1))
        .otherwise(F.lit(0))
        .cast("long")
    )
    # Copies of an accepted event find the slot of the first copy taken.
    before = F.filter(F.col("d.taken"), lambda s: (s < event) | ((s == event) & (F.col("e.events") > 1)))
    return (
        counted.alias("e")
        .join(decisions.alias("d"), same_slot)
        .select(
            *[F.col(f"e.{c}") for c in [*GROUP, *EVENT]],
            "e.events",
            accepted.alias("accepted"),
            F.transform(before, lambda s: F.struct(s["start_hour"], s["end_hour"])).alias("existing_slots"),
        )
    )


def shared_slots(decided: DataFrame) -> DataFrame:
    """The decided slots that more than one event has, as a rule a small part."""
    return decided.where("slot.first is not null and slot.flights + slot.services > 1")


def lone_events(decided: DataFrame, keyed: bool) -> DataFrame:
    """The rows of ``event_decisions`` for all other slots: their one event is at hand, so no event is read again."""
    order = KEYED_ORDER if keyed else EVENT
    only = lambda event: F.struct(*[event[c].alias(c) for c in order])
    before = F.filter(F.transform("taken", only), lambda s: s < only(F.col("slot.first")))
    return decided.where("slot.first is not null and slot.flights + slot.services = 1").select(
        *GROUP,
        *[F.col(f"slot.first.{c}").alias(c) for c in EVENT],
        F.lit(1).cast("long").alias("events"),
        F.col("accepted").cast("long").alias("accepted"),
        F.transform(before, lambda s: F.struct(s["start_hour"], s["end_hour"])).alias("existing_slots"),
    )
