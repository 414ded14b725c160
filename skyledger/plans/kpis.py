"""KPIs by manufacturer and year from the star schema.

Each function takes the warehouse tables by name. Facts are summed per aircraft
and year before they meet the aircraft dimension, so that join and the final
grouping see one row per aircraft and year, and counting those rows counts
distinct aircraft. No join is forced to broadcast: dimensions are broadcast
where their size allows it, and shuffled beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numeric import double_ratio, round_double
from skyledger.functions.predicates import MAREP, PIREP

GROUP = ["manufacturer", "year"]
Tables = dict[str, DataFrame]


def _months(tables: Tables) -> DataFrame:
    return tables["months"].select("month_id", "year")


def _dated(fact: DataFrame, calendar: DataFrame, key: str) -> DataFrame:
    """With the year. Facts stored by year meet the calendar by it too: what leaves out years there leaves out
    their files. Rows of a month without a year appear in no KPI either way."""
    return fact.join(calendar.select(key, "year"), [key, "year"] if "year" in fact.columns else key)


def _per_manufacturer(fact: DataFrame, tables: Tables, measures: list[str], aircraft_count: bool = False) -> DataFrame:
    """Yearly sums of ``fact``, which carries ``registration`` and ``year``."""
    per_aircraft = fact.groupBy("registration", "year").agg(*[F.sum(m).alias(m) for m in measures])
    named = per_aircraft.join(tables["aircrafts"].select("registration", "manufacturer"), "registration")
    extra = [F.count("*").alias("n_aircrafts")] if aircraft_count else []
    return named.groupBy(*GROUP).agg(*[F.sum(m).alias(m) for m in measures], *extra)


def _yearly_daily(tables: Tables, measures: list[str], aircraft_count: bool = False) -> DataFrame:
    calendar = tables["days"].select("day_id", "month_id").join(_months(tables), "month_id")
    return _per_manufacturer(_dated(tables["daily_usage"], calendar, "day_id"), tables, measures, aircraft_count)


def _yearly_monthly(tables: Tables, fact: str, measures: list[str]) -> DataFrame:
    return _per_manufacturer(_dated(tables[fact], _months(tables), "month_id"), tables, measures)


def ratio(num: str, den: str, digits: int) -> str:
    """SQL text of a rounded quotient."""
    return round_double(double_ratio(num, den), digits)


def _sorted(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def query_utilization(tables: Tables) -> DataFrame:
    """Utilization, delay, cancellation and dispatch reliability.

    ``add`` is 100 times the average delay in minutes.
    """
    daily = _yearly_daily(tables, ["fh", "tos", "sto"], aircraft_count=True)
    monthly = _yearly_monthly(tables, "monthly_usage", ["ados", "adoss", "adosu", "adis", "dh", "dy", "cn"])
    kpis = {m: ratio(m, "n_aircrafts", 2) for m in ("fh", "tos", "adoss", "adosu", "ados", "adis")} | {
        "du": ratio("fh", "24 * adis", 2),
        "dc": ratio("tos", "adis", 2),
        "dyr": ratio("100 * dy", "sto", 2),
        "cnr": ratio("100 * cn", "tos", 2),
        "tdr": round_double(f"(100D * (1D - {double_ratio('dy + cn', 'sto')}))", 2),
        "add": ratio("6000 * dh", "dy", 2),
    }
    grouped = _sorted(daily.join(monthly, GROUP), *GROUP)
    return grouped.select(*GROUP, *[F.expr(kpi).alias(name) for name, kpi in kpis.items()])


def _rates(reports: str) -> list[Column]:
    """Reports per 1000 flight hours and per 100 take-offs: rounded, then scaled."""
    return [
        F.expr(f"1000D * {ratio(reports, 'fh', 3)}").alias("rrh"),
        F.expr(f"100D * {ratio(reports, 'tos', 2)}").alias("rrc"),
    ]


def query_reporting(tables: Tables) -> DataFrame:
    daily = _yearly_daily(tables, ["fh", "tos"])
    reported = _yearly_monthly(tables, "reportage_usage", ["reps"])
    return _sorted(daily.join(reported, GROUP), *GROUP).select(*GROUP, *_rates("reps"))


def query_reporting_per_role(tables: Tables) -> DataFrame:
    """One row per manufacturer, year and role.

    Known deviation: the PIREP rate counts ``pireps``. The query this stands for
    sums ``mareps`` under that name, which gives both roles the same rates.
    """
    daily = _yearly_daily(tables, ["fh", "tos"])
    reported = _yearly_monthly(tables, "reportage_usage", ["mareps", "pireps"])
    per_role = F.expr(f"stack(2, '{MAREP}', mareps, '{PIREP}', pireps) as (role, reports)")
    long_form = daily.join(reported, GROUP).select(*GROUP, "fh", "tos", per_role)
    return _sorted(long_form, *GROUP, "role").select(*GROUP, "role", *_rates("reports"))
