import random
from decimal import Decimal

import pytest

from conftest import as_dicts
from skyledger.operators import reports
from skyledger.plans import transform as tr
from skyledger.plans import violations


@pytest.fixture(scope="module")
def sources(make):
    return {
        "flights": make.flights([
            ("A", "2024-01-05T08:00", "2024-01-05T10:00", "2024-01-05T08:16", "2024-01-05T10:00", False),  # delayed
            ("A", "2024-01-05T12:00", "2024-01-05T13:00", "2024-01-05T12:15", "2024-01-05T13:00", None),  # not delayed
            ("A", "2024-01-05T12:00", "2024-01-05T14:00", "2024-01-05T12:30", "2024-01-05T14:00", False),  # BR-21
            ("A", "2024-01-06T08:00", "2024-01-06T10:00", "2024-01-06T08:00", None, False),  # no arrival
            ("B", "2024-02-01T08:00", "2024-02-01T10:00", "2024-02-01T11:00", "2024-02-01T09:00", False),  # BR-23, delayed
            ("B", "2024-02-02T08:00", "2024-02-02T10:00", None, None, True),
            ("F", "2024-03-01T08:00", "2024-03-01T10:00", "2024-03-01T08:00", "2024-03-01T10:00", False),  # foreign
        ]),
        "maintenance": make.maintenance([
            ("A", "2024-01-05T09:00", "2024-01-05T11:00", True),  # rejected by the first flight
            ("A", "2024-01-07T00:00", "2024-01-08T12:00", True),
            ("A", "2024-01-09T00:00", "2024-01-09T06:00", None),
            ("B", "2024-04-01T00:00", "2024-04-02T00:00", False),
            ("F", "2024-03-01T08:00", "2024-03-01T09:00", True),  # rejected, month of a flight
            ("C", "2024-05-01T23:00", "2024-05-02T01:00", False),
            ("C", "2024-06-01T08:00", "2024-06-01T10:00", True),
            ("C", "2024-06-01T09:00", "2024-06-01T10:00", True),
        ]),
        "reports": make.reports([
            ("A", "2024-01-05", 1, "MAREP"),
            ("A", "2024-01-06", 1, "PIREP"),
            ("A", "2024-01-06", 1, "OTHER"),
            ("A", "2024-07-01", None, "PIREP"),
            ("B", "2024-01-06", 9, "MAREP"),
            ("F", "2024-12-01", 7, "MAREP"),
            (None, "2024-12-01", 7, "MAREP"),
        ]),
        "aircrafts": make.aircrafts([("A", "A350", "Airbus"), ("B", "737", "Boeing"), ("C", "E190", "Embraer")]),
        "personnel": make.personnel([(" 1 ", "CGN"), ("5", "BCN")]),
    }


@pytest.fixture(scope="module")
def tables(sources):
    return tr.transform(sources)


def rows(df, *keys):
    return sorted((tuple(r[k] for k in keys) for r in as_dicts(df)), key=repr)


def test_daily_usage(tables):
    assert rows(tables["daily_usage"], "registration", "day_id", "fh", "tos", "sto") == [
        ("A", "2024-1-5", Decimal("2.48"), 2, 2),  # 104 + 45 minutes
        ("A", "2024-1-6", Decimal("0.00"), 0, 1),
        ("B", "2024-2-1", Decimal("2.00"), 1, 1),
        ("B", "2024-2-2", Decimal("0.00"), 0, 1),
        ("F", "2024-3-1", Decimal("2.00"), 1, 1),
    ]


def test_monthly_usage(tables):
    d = Decimal
    assert rows(
        tables["monthly_usage"], "registration", "month_id", "dy", "cn", "dh", "ados", "adoss", "adosu", "adis"
    ) == [
        ("A", "202401", 1, 1, d("0.27"), d("1.75"), d("1.50"), d("0.25"), d("28.69")),
        ("B", "202402", 1, 1, d("1.00"), d("0.00"), d("0.00"), d("0.00"), d("30.44")),
        ("B", "202404", 0, 0, d("0.00"), d("1.00"), d("0.00"), d("1.00"), d("29.44")),
        ("C", "202405", 0, 0, d("0.00"), d("0.08"), d("0.00"), d("0.08"), d("30.35")),
        ("C", "202406", 0, 0, d("0.00"), d("0.08"), d("0.08"), d("0.00"), d("30.35")),
        ("F", "202403", 0, 0, d("0.00"), d("0.00"), d("0.00"), d("0.00"), d("30.44")),
    ]


def test_a_month_of_rejected_maintenance_only_has_no_usage_row(make, sources):
    only = sources | {
        "flights": make.flights([("A", "2024-01-31T08:00", "2024-01-31T10:00", "2024-01-31T08:00", "2024-01-31T10:00", False)]),
        "maintenance": make.maintenance([("A", "2024-01-31T09:00", "2024-01-31T10:00", True)]),
        "reports": make.reports([]),
    }
    tables = tr.transform(only)
    assert rows(tables["monthly_usage"], "month_id", "ados") == [("202401", Decimal("0.00"))]
    # The slot is taken by day, so a later month cannot be rejected by it.
    assert rows(tables["months"], "month_id") == [("202401",)]


def test_calendar_dimensions(tables):
    assert rows(tables["days"], "day_id", "day", "month_id") == [
        ("2024-1-5", 5, "202401"), ("2024-1-6", 6, "202401"), ("2024-2-1", 1, "202402"),
        ("2024-2-2", 2, "202402"), ("2024-3-1", 1, "202403"),
    ]
    # 07 comes from a kept report only; 12 is seen only by foreign reports.
    assert rows(tables["months"], "month_id", "month", "year") == [(f"20240{m}", m, 2024) for m in range(1, 8)]


def test_reportage_and_reporters(tables):
    assert rows(tables["reportage_usage"], "registration", "month_id", "reporteur_uid", "reps", "mareps", "pireps") == [
        ("A", "202401", "1", 3, 1, 1), ("A", "202407", "None", 1, 0, 1), ("B", "202401", "9", 1, 1, 0),
    ]
    assert rows(tables["reporteurs"], "reporteur_uid", "airport", "role") == [
        ("1", "CGN", "PIREP"), ("5", "BCN", None), ("9", None, "MAREP"), ("None", None, "PIREP"),
    ]


def test_rules_off(sources):
    tables = tr.transform(sources, apply_business_rules=False)
    daily = {(r[0], r[1]): r[2:] for r in rows(tables["daily_usage"], "registration", "day_id", "fh", "tos", "sto")}
    assert daily[("B", "2024-2-1")] == (Decimal("-2.00"), 1, 1)
    assert daily[("A", "2024-1-5")] == (Decimal("3.98"), 3, 3)
    assert rows(tables["reportage_usage"], "reps") == [(1,), (1,), (3,)]


def test_rule_summary_and_violations(sources):
    grains = tr.grains(sources)
    summary = rows(
        violations.rule_summary(grains.usage, grains.report_counts, sources["aircrafts"]),
        "rule_id", "source", "hits", "rows_checked",
    )
    assert summary == [
        ("BR-21", "flight", 1, 7), ("BR-21", "maintenance", 3, 8), ("BR-23", "flight", 1, 7),
        ("FOREIGN-AIRCRAFT", "report", 2, 7),
    ]
    cases = rows(violations.rule_violations(sources), "rule_id", "source", "registration")
    assert cases == [
        ("BR-21", "flight", "A"), ("BR-21", "maintenance", "A"), ("BR-21", "maintenance", "C"),
        ("BR-21", "maintenance", "F"), ("BR-23", "flight", "B"),
        ("FOREIGN-AIRCRAFT", "report", "F"), ("FOREIGN-AIRCRAFT", "report", None),
    ]
    off = violations.rule_violations(sources, apply_business_rules=False)
    assert {r[0] for r in rows(off, "rule_id")} == {"FOREIGN-AIRCRAFT"}


def test_summary_of_nothing(make, sources):
    empty = sources | {"flights": make.flights([]), "maintenance": make.maintenance([]), "reports": make.reports([])}
    grains = tr.grains(empty)
    summary = violations.rule_summary(grains.usage, grains.report_counts, sources["aircrafts"])
    assert [tuple(r)[2:] for r in summary.collect()] == [(0, 0)] * 4


def test_reports_are_either_kept_or_foreign(sources):
    counts = reports.count_reports(sources["reports"])
    total = lambda df: sum(r.reps for r in df.collect())
    kept = reports.of_known_aircraft(counts, sources["aircrafts"])
    foreign = reports.of_foreign_aircraft(counts, sources["aircrafts"])
    assert total(kept) + total(foreign) == sources["reports"].count() == 7


def test_last_report_wins_and_ties_go_to_the_greater_class(make):
    counts = reports.count_reports(make.reports([
        ("A", "2024-03-01", 1, "MAREP"), ("B", "2024-02-01", 1, "PIREP"),
        ("A", "2024-03-01", 2, "MAREP"), ("B", "2024-03-01", 2, "PIREP"),
    ]))
    assert rows(reports.reporter_roles(counts), "reporteur_uid", "role") == [("1", "MAREP"), ("2", "PIREP")]


def test_roles_from_dates_equal_roles_from_the_latest_class(make):
    rng = random.Random(3)
    classes, dates = ["MAREP", "PIREP", None, "CABIN", "ATC"], [None, "2024-01-05", "2024-01-06", "2024-02-05"]
    given = make.reports(
        [(rng.choice(["A", "B", "F", None]), rng.choice(dates), rng.choice([None, *range(40)]), rng.choice(classes)) for _ in range(160)]
        + [("A", None, 50, "MAREP"), ("A", None, 51, None), ("A", None, 52, "CABIN"), ("F", "2024-01-05", 53, "CABIN")]
    )
    lookup = make.aircrafts([("A", "A350", "Airbus"), ("B", "737", "Boeing")])
    known = lambda df: reports.of_known_aircraft(df, lookup)
    counts, by_date = reports.count_reports(given), reports.count_reports_by_date(given)
    keys = ("registration", "month", "reporteur_uid", "reps", "mareps", "pireps")
    assert rows(counts, *keys) == rows(by_date, *keys)
    expected = rows(reports.reporter_roles(known(counts)), "reporteur_uid", "role")
    assert rows(reports.reporter_roles(known(by_date), known(reports.other_classes(given))), "reporteur_uid", "role") == expected
    assert ("52", "CABIN") in expected and ("51", None) in expected and "53" not in dict(expected)


def test_what_a_load_stages_of_reports_is_not_sorted(make, sources):
    grains = tr.grains(sources)
    for df in (grains.report_counts, grains.other_classes):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()
