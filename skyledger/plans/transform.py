"""Sources to the seven warehouse tables.

Both usage facts, the calendar dimensions and the rule summary come from one
frame at (aircraft, day) grain; everything about reports comes from one frame
at (aircraft, month, reporter) grain. A stored warehouse stages these two.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import numeric as n
from skyledger.functions import temporal as t
from skyledger.operators import overlap, reports
from skyledger.plans.warehouse import together, unique
from skyledger.schemas import TABLES

# 365.25 / 12 days, in seconds: an average month, exactly.
MONTH_SECONDS = 2_629_800

Stage = Callable[[DataFrame, str], DataFrame]


def decided_slots(sources: dict[str, DataFrame]) -> DataFrame:
    return overlap.decided_slots(overlap.activity_events(sources["flights"], sources["maintenance"]))


def usage(sources: dict[str, DataFrame], apply_business_rules: bool = True) -> DataFrame:
    if apply_business_rules:
        return overlap.usage_by_day(decided_slots(sources))
    return overlap.usage_by_day_unruled(overlap.activity_events(sources["flights"], sources["maintenance"]))


def daily_usage(usage: DataFrame) -> DataFrame:
    """Any flight makes a row, also one that is cancelled or rejected."""
    return usage.where("flights > 0").select(
        "registration",
        t.day_id(F.col("day")).alias("day_id"),
        n.as_units(t.seconds_of("flight"), t.SECONDS_PER_HOUR).alias("fh"),
        F.col("take_offs").alias("tos"),
        (F.col("take_offs") + F.col("cancellations")).alias("sto"),
    )


def monthly_usage(usage: DataFrame) -> DataFrame:
    """Any flight or any *accepted* maintenance makes a row."""
    summed = (
        usage.where("flights > 0 or maintenances > 0")
        .groupBy("registration", "month")
        .agg(
            F.sum("delays").alias("dy"),
            F.sum("cancellations").alias("cn"),
            *[
                F.sum(f"{name}_{part}").alias(f"{name}_{part}")
                for name in ("delay", "programmed", "unprogrammed")
                for part in ("sec", "us")
            ],
        )
    )
    programmed, unprogrammed = t.seconds_of("programmed"), t.seconds_of("unprogrammed")
    out = programmed + unprogrammed
    return summed.select(
        "registration",
        t.month_id(F.col("month")).alias("month_id"),
        "dy",
        "cn",
        n.as_units(t.seconds_of("delay"), t.SECONDS_PER_HOUR).alias("dh"),
        n.as_units(out, t.SECONDS_PER_DAY).alias("ados"),
        n.as_units(programmed, t.SECONDS_PER_DAY).alias("adoss"),
        n.as_units(unprogrammed, t.SECONDS_PER_DAY).alias("adosu"),
        n.as_units(F.lit(MONTH_SECONDS) - out, t.SECONDS_PER_DAY).alias("adis"),
    )


def reportage_usage(kept: DataFrame) -> DataFrame:
    return kept.select(
        "registration", t.month_id(F.col("month")).alias("month_id"), "reporteur_uid", "reps", "mareps", "pireps"
    )


def days(usage: DataFrame) -> DataFrame:
    """Days of flights only."""
    return usage.where("flights > 0").select("day").distinct().select(*t.day_columns(F.col("day")))


def months(usage: DataFrame, kept: DataFrame) -> DataFrame:
    """Months of flights, of all maintenance and of kept reports."""
    seen = usage.select("month").distinct().union(kept.select("month").distinct())
    return seen.distinct().select(*t.month_columns(F.col("month")))


def aircrafts(lookup: DataFrame) -> DataFrame:
    return lookup.select("registration", "model", "manufacturer").dropDuplicates()


@dataclass(frozen=True)
class Grains:
    """The frames everything else is derived from."""

    usage: DataFrame  # per aircraft and day
    report_counts: DataFrame  # per aircraft, month and reporter, foreign aircraft included
    other_classes: DataFrame | None = None  # per aircraft, reporter and class, where counts have the dates of the named ones


def grains(
    sources: dict[str, DataFrame], apply_business_rules: bool = True, stage: Stage | None = None, roles: bool = True
) -> Grains:
    """``stage`` stores the frames, so that they are computed once. Without ``roles`` the counts do not carry
    the latest date of each class, and the table ``reporteurs`` cannot be derived."""
    stage = stage or (lambda df, name: df)
    reported = sources["reports"]
    jobs = [lambda: stage(usage(sources, apply_business_rules), "usage_by_day")]
    if roles:
        jobs.append(lambda: stage(reports.count_reports_by_date(reported), "report_counts"))
        jobs.append(lambda: stage(reports.other_classes(reported), "other_classes"))
    else:
        jobs.append(lambda: stage(reports.count_reports(reported, roles), "report_counts"))
    return Grains(*together(jobs))


def rows_to_load(grains: Grains, lookup: DataFrame, personnel: DataFrame) -> dict[str, DataFrame]:
    """The seven tables in load order, with all rows that share a key: the load chooses among them.

    Without ``reporteurs`` where the counts carry no roles.
    """
    kept = reports.of_known_aircraft(grains.report_counts, lookup)
    others = None if grains.other_classes is None else reports.of_known_aircraft(grains.other_classes, lookup)
    return {
        "days": days(grains.usage),
        "months": months(grains.usage, kept),
        "aircrafts": aircrafts(lookup),
        **({"reporteurs": reports.reporters(personnel, kept, others)} if others is not None or "last" in kept.columns else {}),
        "daily_usage": daily_usage(grains.usage),
        "monthly_usage": monthly_usage(grains.usage),
        "reportage_usage": reportage_usage(kept),
    }


def tables(grains: Grains, lookup: DataFrame, personnel: DataFrame) -> dict[str, DataFrame]:
    """The seven tables in load order, as a load stores them: one row for each key of a dimension."""
    found = rows_to_load(grains, lookup, personnel)
    for name in found.keys() & {"aircrafts", "reporteurs"}:
        found[name] = unique(found[name], TABLES[name].primary_key)
    return found


def transform(
    sources: dict[str, DataFrame], apply_business_rules: bool = True, stage: Stage | None = None
) -> dict[str, DataFrame]:
    """Sources to tables.

    The rules toggle covers BR-21 and BR-23; reports on foreign aircraft are
    left out either way.
    """
    return tables(grains(sources, apply_business_rules, stage), sources["aircrafts"], sources["personnel"])
