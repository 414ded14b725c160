import pytest

from conftest import as_dicts
from skyledger.plans import kpis, raw_kpis
from skyledger.plans.reconcile import REPORTING, reconcile
from skyledger.plans.transform import transform
from skyledger.schemas import TABLES


@pytest.fixture(scope="module")
def tables(spark):
    from decimal import Decimal as D

    data = {
        "days": [("2024-1-1", 1, "202401"), ("2024-2-1", 1, "202402"), ("2025-1-1", 1, "202501")],
        "months": [("202401", 1, 2024), ("202402", 2, 2024), ("202501", 1, 2025)],
        "aircrafts": [("A", "x", "Airbus"), ("B", "x", "Airbus"), ("C", "x", "Boeing"), ("D", "x", "Fokker")],
        "reporteurs": [("1", None, "PIREP")],
        "daily_usage": [
            ("A", "2024-1-1", D("10.00"), 4, 5), ("A", "2024-2-1", D("2.50"), 1, 1), ("B", "2024-1-1", D("3.00"), 2, 2),
            ("C", "2024-1-1", D("0.00"), 0, 1), ("A", "2025-1-1", D("1.00"), 1, 1), ("Z", "2024-1-1", D("9.00"), 9, 9),
        ],
        "monthly_usage": [
            ("A", "202401", 2, 1, D("1.00"), D("1.50"), D("1.00"), D("0.50"), D("28.94")),
            ("B", "202401", 0, 0, D("0.00"), D("0.00"), D("0.00"), D("0.00"), D("30.44")),
            ("C", "202401", 0, 1, D("0.00"), D("0.00"), D("0.00"), D("0.00"), D("30.44")),
            ("D", "202401", 0, 0, D("0.00"), D("2.00"), D("2.00"), D("0.00"), D("28.44")),
        ],
        "reportage_usage": [("A", "202401", "1", 5, 2, 3), ("B", "202402", "1", 1, 1, 0), ("C", "202401", "1", 1, 0, 1)],
    }
    return {name: spark.createDataFrame(rows, TABLES[name].schema) for name, rows in data.items()}


def test_utilization(tables):
    airbus, boeing = as_dicts(kpis.query_utilization(tables))
    # 2025 has no monthly rows and Fokker no daily rows: both are left out.
    assert (airbus["manufacturer"], airbus["year"]) == ("Airbus", 2024)
    assert (airbus["fh"], airbus["tos"], airbus["ados"], airbus["adis"]) == (7.75, 3.5, 0.75, 29.69)
    assert (airbus["du"], airbus["dc"]) == (0.01, 0.12)
    assert (airbus["dyr"], airbus["cnr"], airbus["tdr"], airbus["add"]) == (25.0, 14.29, 62.5, 3000.0)
    # Nothing took off: ratios over take-offs and delays have no value.
    assert (boeing["cnr"], boeing["add"], boeing["tdr"]) == (None, None, 0.0)


def test_reporting(tables):
    rows = [tuple(r.values()) for r in as_dicts(kpis.query_reporting(tables))]
    assert rows == [("Airbus", 2024, 387.0, 86.0), ("Boeing", 2024, None, None)]


def test_reporting_per_role_counts_pilot_reports(tables):
    rows = [tuple(r.values()) for r in as_dicts(kpis.query_reporting_per_role(tables))]
    assert rows[:2] == [
        ("Airbus", 2024, "MAREP", pytest.approx(194.0), 43.0), ("Airbus", 2024, "PIREP", pytest.approx(194.0), 43.0),
    ]
    assert [r[2] for r in rows] == ["MAREP", "PIREP", "MAREP", "PIREP"]


@pytest.fixture(scope="module")
def raw(make):
    return {
        "flights": make.flights([
            ("A", "2024-01-01T08:00", "2024-01-01T10:00", "2024-01-01T08:00", "2024-01-01T10:15", False),  # 15 min: no delay
            ("A", "2024-01-02T08:00", "2024-01-02T10:00", "2024-01-02T08:00", "2024-01-02T10:16", False),
            ("A", "2024-01-03T08:00", "2024-01-03T10:00", "2024-01-03T10:00", "2024-01-03T08:00", False),  # negative hours
            ("A", "2024-01-04T08:00", "2024-01-04T10:00", None, None, True),
            ("B", "2024-01-05T08:00", "2024-01-05T10:00", "2024-01-05T08:00", None, None),  # a cycle without hours
            ("K", "2024-01-05T08:00", "2024-01-05T10:00", "2024-01-05T08:00", "2024-01-05T09:00", False),  # third maker
        ]),
        "maintenance": make.maintenance([
            ("A", "2024-01-05T00:00", "2024-01-06T12:00", True), ("A", "2024-01-07T00:00", "2024-01-07T06:00", None),
        ]),
        "reports": make.reports([
            ("A", "2024-02-01", 1, "MAREP"), ("A", "2024-02-01", 1, "OTHER"), ("K", "2024-02-01", 1, "PIREP"),
            ("A", "2023-02-01", 1, "MAREP"), ("B", "2024-02-01", 1, None),
        ]),
        "aircrafts": make.aircrafts([("A", "", "Airbus"), ("B", "", "Boeing"), ("K", "", "Embraer"), ("A", "", "Boeing")]),
    }


def test_raw_utilization(raw):
    got = {r["manufacturer"]: r for r in as_dicts(
        raw_kpis.query_utilization_baseline(raw["flights"], raw["maintenance"], raw["aircrafts"]))}
    assert set(got) == {"Airbus", "Boeing", "K"}
    a = got["Airbus"]
    assert a["year"] == "2024"
    assert (a["fh"], a["tos"], a["adoss"], a["adosu"], a["ados"], a["adis"]) == (2.52, 3.0, 1.5, 0.25, 1.75, 363.25)
    assert (a["du"], a["dc"], a["dyr"], a["cnr"], a["add"]) == (0.0, 0.01, 33.33, 33.33, 1600.0)
    assert a["tdr"] == 100 - 200 // 3
    # Every flight lacks times: no hours, not zero hours.
    assert got["Boeing"]["fh"] is None and got["Boeing"]["tos"] == 1.0
    assert got["K"]["fh"] == 1.0


def test_raw_reporting(raw):
    got = [tuple(r.values()) for r in as_dicts(
        raw_kpis.query_reporting_baseline(raw["flights"], raw["reports"], raw["aircrafts"]))]
    assert got == [("Airbus", "2024", 795.0, 67.0), ("Boeing", "2024", None, 100.0), ("K", "2024", 1000.0, 100.0)]
    per_role = [tuple(r.values()) for r in as_dicts(
        raw_kpis.query_reporting_per_role_baseline(raw["flights"], raw["reports"], raw["aircrafts"]))]
    assert [r[:3] for r in per_role] == [
        ("Airbus", "2024", "MAREP"), ("Airbus", "2024", "OTHER"), ("Boeing", "2024", None), ("K", "2024", "PIREP"),
    ]


def test_aircraft_by_manufacturer(raw):
    got = [tuple(r) for r in raw_kpis.aircraft_by_manufacturer(raw["aircrafts"]).collect()]
    assert got == [("Airbus", "A"), ("Boeing", "A"), ("Boeing", "B"), ("Embraer", "K")]


def test_reconcile_of_clean_data(make):
    """Without missing times, swaps, overlaps or foreign aircraft both sides agree."""
    flights = [
        (reg, f"2024-{m:02}-01T{h:02}:00", f"2024-{m:02}-01T{h + 2:02}:00", f"2024-{m:02}-01T{h:02}:00", f"2024-{m:02}-01T{h + 2:02}:00", False)
        for reg in "AB" for m in range(1, 13) for h in (4, 8, 12)
    ]
    sources = {
        "flights": make.flights(flights), "maintenance": make.maintenance([]),
        "reports": make.reports([(reg, f"2024-{m:02}-03", 1, "PIREP") for reg in "AAB" for m in range(1, 13)]),
        "aircrafts": make.aircrafts([("A", "", "Airbus"), ("B", "", "Boeing")]), "personnel": make.personnel([("1", "X")]),
    }
    both = reconcile(
        kpis.query_reporting(transform(sources, apply_business_rules=False)),
        raw_kpis.query_reporting_baseline(sources["flights"], sources["reports"], sources["aircrafts"]),
        REPORTING,
    )
    for row in as_dicts(both):
        assert row["status"] == "both"
        assert row["rrc_delta"] == pytest.approx(0) and row["rrh_delta"] == pytest.approx(0)


def test_reconcile_statuses(spark):
    side = lambda rows: spark.createDataFrame(rows, "manufacturer string, year string, x double")
    got = reconcile(side([("A", "1", 1.0), ("B", "1", 2.0)]), side([("B", "1", 0.5), ("C", "1", 1.0)]), ["x"])
    assert [tuple(r) for r in got.collect()] == [
        ("A", "1", "only_dw", 1.0, None, None), ("B", "1", "both", 2.0, 0.5, 1.5), ("C", "1", "only_raw", None, 1.0, None),
    ]
