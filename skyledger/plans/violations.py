"""Rule hits: one table of cases and one of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions import predicates as P
from skyledger.functions import temporal as t
from skyledger.operators import overlap, reports

OVERLAP, SWAPPED, FOREIGN = "BR-21", "BR-23", "FOREIGN-AIRCRAFT"
SOURCE_NAMES = {overlap.FLIGHT: "flight", overlap.MAINTENANCE: "maintenance"}

_SLOT = "struct<start_hour:int,end_hour:int>"


def _source():
    return F.when(F.col("activity") == overlap.FLIGHT, SOURCE_NAMES[overlap.FLIGHT]).otherwise(
        SOURCE_NAMES[overlap.MAINTENANCE]
    )


def _keyed(sources: dict[str, DataFrame]) -> bool:
    return all(schemas.ROW_KEY in sources[name].columns for name in ("flights", "maintenance"))


def event_decisions(sources: dict[str, DataFrame], decided: DataFrame | None = None) -> DataFrame:
    events = overlap.activity_events(sources["flights"], sources["maintenance"])
    return overlap.event_decisions(events, _keyed(sources), decided)


def foreign_report_cases(sources: dict[str, DataFrame]) -> DataFrame:
    return reports.of_foreign_aircraft(sources["reports"], sources["aircrafts"], "aircraftregistration").select(
        F.lit(FOREIGN).alias("rule_id"),
        F.col("aircraftregistration").alias("registration"),
        t.day_id(F.col("reportingdate")).alias("day_id"),
        F.lit("report").alias("source"),
        F.lit(None).cast(_SLOT).alias("slot"),
        F.lit(None).cast(f"array<{_SLOT}>").alias("existing_slots"),
        t.wall_clock(F.col("reportingdate")).alias("ts"),
        F.lit(1).cast("long").alias("cases"),
    )


def rule_violations(
    sources: dict[str, DataFrame],
    apply_business_rules: bool = True,
    decided: DataFrame | None = None,
    shared: DataFrame | None = None,
) -> DataFrame:
    """Every hit of a rule, with the slots already taken for BR-21.

    ``cases`` counts events alike in every column; it is 1 where the sources
    carry a unique row key, and for reports. With the rules off only reports on
    foreign aircraft are left. ``decided``: the decided slots, if they are at hand, and ``shared``
    those of them with more than one event: only these meet the events again.
    """
    foreign = foreign_report_cases(sources)
    if not apply_business_rules:
        return foreign
    none_taken = F.lit(None).cast(f"array<{_SLOT}>")
    hit = lambda rule, taken, cases: F.struct(
        F.lit(rule).alias("rule_id"), taken.alias("existing_slots"), cases.cast("long").alias("cases")
    )
    rejected, swapped = F.col("accepted") < F.col("events"), _is_swapped()
    hit_by_one = lambda events: events.where(rejected | swapped)
    if decided is None:
        events = hit_by_one(event_decisions(sources))
    else:
        again = event_decisions(sources, overlap.shared_slots(decided) if shared is None else shared)
        events = hit_by_one(overlap.lone_events(decided, _keyed(sources))).unionByName(hit_by_one(again))
    hits = F.array_compact(
        F.array(
            F.when(rejected, hit(OVERLAP, F.col("existing_slots").cast(f"array<{_SLOT}>"), F.col("events") - F.col("accepted"))),
            F.when(swapped, hit(SWAPPED, none_taken, F.col("accepted"))),
        )
    )
    found = events.select(
        "registration",
        t.day_id(F.col("day")).alias("day_id"),
        _source().alias("source"),
        F.struct("start_hour", "end_hour").cast(_SLOT).alias("slot"),
        F.col("began").alias("ts"),
        F.inline(hits),
    )
    return found.select(*foreign.columns).unionByName(foreign)


def _is_swapped():
    return (F.col("activity") == overlap.FLIGHT) & (F.col("accepted") > 0) & P.is_swapped(F.col("began"), F.col("ended"))


def swapped_flights(decided: DataFrame) -> DataFrame:
    """Accepted flights whose arrival precedes their departure."""
    return decided.where(_is_swapped())


def foreign_reports(counts: DataFrame, aircrafts: DataFrame) -> DataFrame:
    """Reports per aircraft outside the lookup."""
    return (
        reports.of_foreign_aircraft(counts, aircrafts)
        .groupBy("registration")
        .agg(F.sum("reps").cast("long").alias("reports"))
    )


def rule_summary(usage: DataFrame, counts: DataFrame, aircrafts: DataFrame) -> DataFrame:
    """Hits per rule out of the rows it was applied to, from the grouped frames.

    A rule without hits still has its row.
    """
    seen = F.coalesce(F.sum("flights"), F.lit(0)).cast("long")
    totals = usage.agg(
        seen.alias("flights"),
        F.sum("services").alias("services"),
        F.sum("cancellations").alias("cancellations"),
        F.sum("take_offs").alias("take_offs"),
        F.sum("maintenances").alias("maintenances"),
        F.sum("swapped").alias("swapped"),
    )
    long = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    rejected_flights = long(F.col("flights") - F.col("cancellations") - F.col("take_offs"))
    rejected_services = long(F.col("services") - F.col("maintenances"))
    entry = lambda rule, source, hits, rows: F.struct(
        F.lit(rule).alias("rule_id"), F.lit(source).alias("source"), hits.alias("hits"), rows.alias("rows_checked")
    )
    on_events = totals.select(
        F.inline(
            F.array(
                entry(OVERLAP, "flight", rejected_flights, long(F.col("flights"))),
                entry(OVERLAP, "maintenance", rejected_services, long(F.col("services"))),
                entry(SWAPPED, "flight", long(F.col("swapped")), long(F.col("flights"))),
            )
        )
    )
    known = aircrafts.where("registration is not null").select("registration").distinct().withColumn("known", F.lit(True))
    # One row for each registration meets the lookup, so reports without one are no hot key.
    on_reports = (
        counts.groupBy("registration")
        .agg(F.sum("reps").alias("reps"))
        .join(known, "registration", "left")
        .agg(
            long(F.sum(F.when(F.col("known").isNull(), F.col("reps")))).alias("hits"),
            long(F.sum("reps")).alias("rows_checked"),
        )
        .select(F.lit(FOREIGN).alias("rule_id"), F.lit("report").alias("source"), "hits", "rows_checked")
    )
    return on_events.unionByName(on_reports)
