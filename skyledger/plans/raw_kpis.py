"""The same KPIs straight from the source relations, without cleaning rules.

They differ from the warehouse KPIs on purpose: delay is arrival delay, only
the flag cancels a flight, a year has 365 days, and an aircraft that is neither
Airbus nor Boeing is a group of its own. Ratios are exact.

Rows are summed per registration and year first, so the lookup join sees one
row for each; a hot registration is combined before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import predicates as P
from skyledger.functions import temporal as t
from skyledger.functions.numeric import from_units, micros, rounded_units

GROUP = ["manufacturer", "year"]
DAYS_PER_YEAR = 365
HOUR_US, DAY_US, MINUTE_US = 3_600_000_000, 86_400_000_000, 60_000_000


def aircraft_by_manufacturer(aircrafts: DataFrame) -> DataFrame:
    """Registrations of each manufacturer, in rows and sorted: a manufacturer
    may have any number of aircraft, so they are not gathered into one value."""
    return aircrafts.select("manufacturer", "registration").orderBy("manufacturer", "registration")


def named_manufacturer(df: DataFrame, aircrafts: DataFrame, registration: str = "registration") -> DataFrame:
    """Adds ``manufacturer``: Airbus or Boeing by the lookup, else the registration.

    The first of the two wins where the lookup lists an aircraft under both.
    """
    lookup = (
        aircrafts.where(F.col("manufacturer").isin(*P.NAMED_MANUFACTURERS))
        .groupBy(F.col("registration").alias("known_registration"))
        .agg(F.min("manufacturer").alias("known_manufacturer"))
    )
    return (
        df.join(lookup, F.col(registration) == F.col("known_registration"), "left")
        .withColumn("manufacturer", F.coalesce("known_manufacturer", registration))
        .drop("known_registration", "known_manufacturer")
    )


def _year(ts: Column) -> Column:
    return F.year(ts).cast("string").alias("year")


# Rows that are no flown flight count zero hours: the sum is NULL only where
# every row is a flown flight without times.
FLIGHT_US_FILLED = f"coalesce({micros('flight')}, case when rows > cycles then 0 end)"

_FLOWN = "not coalesce(cancelled, false)"
_LATE = "actualarrival - scheduledarrival"
_DELAYED = f"({_FLOWN} and coalesce({_LATE} > interval {P.DELAY_SECONDS} seconds, false))"
_OUT = "scheduledarrival - scheduleddeparture"
_PROGRAMMED = "coalesce(programmed, false)"
_FLIGHT_PARTS = t.duration_parts("flight", f"case when {_FLOWN} then actualarrival - actualdeparture end")


def _expr(sql: str, name: str) -> Column:
    return F.expr(sql).alias(name)


def _utilization_rows(flights: DataFrame, maintenance: DataFrame) -> DataFrame:
    """Flights and maintenance in one shape; what a row does not have is zero,
    and a missing flight time stays missing."""
    flown = {
        **_FLIGHT_PARTS,
        "cycles": f"cast({_FLOWN} as int)",
        "cancellations": f"cast(not {_FLOWN} as int)",
        "delays": f"cast({_DELAYED} as int)",
        **t.duration_parts("delay", f"case when {_DELAYED} then {_LATE} end"),
    }
    out = {
        **t.duration_parts("programmed", f"case when {_PROGRAMMED} then {_OUT} end"),
        **t.duration_parts("unprogrammed", f"case when not {_PROGRAMMED} then {_OUT} end"),
    }
    keys = [F.col("aircraftregistration").alias("registration"), _year(F.col("scheduleddeparture"))]
    none = "cast(null as bigint)"
    flown_rows = flights.select(*keys, *[_expr(sql, name) for name, sql in (flown | dict.fromkeys(out, none)).items()])
    absent = {name: none if name.startswith("flight_") else "0" for name in flown}
    out_rows = maintenance.select(*keys, *[_expr(sql, name) for name, sql in (absent | out).items()])
    return flown_rows.unionByName(out_rows)


def query_utilization_baseline(flights: DataFrame, maintenance: DataFrame, aircrafts: DataFrame) -> DataFrame:
    rows = _utilization_rows(flights, maintenance)
    summed = [c for c in rows.columns if c not in ("registration", "year")]
    per_aircraft = rows.groupBy("registration", "year").agg(
        *[F.sum(c).alias(c) for c in summed], F.count("*").alias("rows")
    )
    total = (
        named_manufacturer(per_aircraft, aircrafts)
        .groupBy(*GROUP)
        .agg(*[F.sum(x).alias(x) for x in summed], F.sum("rows").alias("rows"), F.count("registration").alias("n"))
        .orderBy(*GROUP)
    )
    exact = total.select(
        *GROUP,
        "cycles",
        "cancellations",
        "delays",
        _expr("cast(n as decimal(20,0))", "n"),
        _expr(FLIGHT_US_FILLED, "flight_us"),
        *[_expr(f"coalesce({micros(x)}, 0)", f"{x}_us") for x in ("delay", "programmed", "unprogrammed")],
    )
    hundredths = exact.select(
        *GROUP,
        "cycles",
        "cancellations",
        "delays",
        "delay_us",
        _expr(rounded_units("flight_us", f"n * {HOUR_US}", 2), "fh"),
        _expr(rounded_units("cycles", "n", 2), "tos"),
        _expr(rounded_units("programmed_us", f"n * {DAY_US}", 2), "adoss"),
        _expr(rounded_units("unprogrammed_us", f"n * {DAY_US}", 2), "adosu"),
        _expr(rounded_units("(programmed_us + unprogrammed_us)", f"n * {DAY_US}", 2), "ados"),
    ).withColumn("adis", F.expr(f"{100 * DAYS_PER_YEAR} - ados"))
    return hundredths.select(
        *GROUP,
        *[_expr(from_units(m, 2), m) for m in ("fh", "tos", "adoss", "adosu", "ados", "adis")],
        _expr(from_units(rounded_units("fh", "adis * 24", 2), 2), "du"),
        _expr(from_units(rounded_units("tos", "adis", 2), 2), "dc"),
        _expr(from_units(rounded_units("delays", "cycles", 4), 2), "dyr"),
        _expr(from_units(rounded_units("cancellations", "cycles", 4), 2), "cnr"),
        # Integers divide without a fraction here, so this is a whole number.
        _expr("cast(100 - (100 * (delays + cancellations)) div nullif(cycles, 0) as double)", "tdr"),
        _expr(f"cast({rounded_units('delay_us', f'cast(delays as decimal(20,0)) * {MINUTE_US}', 2)} as double)", "add"),
    )


def _flown_totals(flights: DataFrame, aircrafts: DataFrame) -> DataFrame:
    parts = list(_FLIGHT_PARTS)
    per_aircraft = flights.groupBy(
        F.col("aircraftregistration").alias("registration"), _year(F.col("scheduleddeparture"))
    ).agg(
        *[_expr(f"sum({sql})", name) for name, sql in _FLIGHT_PARTS.items()],
        _expr(f"count_if({_FLOWN})", "cycles"),
        F.count("*").alias("rows"),
    )
    return (
        named_manufacturer(per_aircraft, aircrafts)
        .groupBy(*GROUP)
        .agg(*[F.sum(c).alias(c) for c in (*parts, "cycles", "rows")])
        .select(*GROUP, _expr(FLIGHT_US_FILLED, "flight_us"), "cycles")
    )


def _report_totals(reports: DataFrame, aircrafts: DataFrame, per_role: bool = False) -> DataFrame:
    role = ["role"] if per_role else []
    per_aircraft = (
        reports.select(
            F.col("aircraftregistration").alias("registration"),
            _year(F.col("reportingdate")),
            F.col("reporteurclass").alias("role"),
        )
        .groupBy("registration", "year", *role)
        .agg(F.count("*").alias("reports"))
    )
    return named_manufacturer(per_aircraft, aircrafts).groupBy(*GROUP, *role).agg(F.sum("reports").alias("reports"))


def _rates() -> list[Column]:
    """Rounded first, then scaled: whole numbers."""
    per_hour = rounded_units(f"(cast(reports as decimal(24,0)) * {HOUR_US})", "flight_us", 3)
    return [
        _expr(f"cast({per_hour} as double)", "rrh"),
        _expr(f"cast({rounded_units('reports', 'cycles', 2)} as double)", "rrc"),
    ]


def query_reporting_baseline(flights: DataFrame, reports: DataFrame, aircrafts: DataFrame) -> DataFrame:
    joined = _report_totals(reports, aircrafts).join(_flown_totals(flights, aircrafts), GROUP)
    return joined.orderBy(*GROUP).select(*GROUP, *_rates())


def query_reporting_per_role_baseline(flights: DataFrame, reports: DataFrame, aircrafts: DataFrame) -> DataFrame:
    joined = _report_totals(reports, aircrafts, per_role=True).join(_flown_totals(flights, aircrafts), GROUP)
    return joined.orderBy(*GROUP, F.col("role").asc_nulls_last()).select(*GROUP, "role", *_rates())
