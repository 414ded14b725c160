from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import as_dicts
from skyledger import fixtures
from skyledger.plans import etl, kpis
from skyledger.plans.etl import run_etl_on
from skyledger.plans.transform import transform
from skyledger.plans.warehouse import ConstraintViolation, Warehouse, begin, primary_key_summary
from skyledger.schemas import DIMENSIONS, TABLES

SF = "/root/testdata/sf0.001"
MOST_JOBS = 80


def frames(spark, **rows):
    return {n: spark.createDataFrame(rows.get(n, []), t.schema.simpleString()[7:-1].replace(":", " ")
                                     .replace("int", "bigint").replace("decimal(10,2)", "decimal(28,2)"))
            for n, t in TABLES.items()}


SOUND = {
    "days": [("2024-1-1", 1, "202401")], "months": [("202401", 1, 2024)], "aircrafts": [("A", "m", "Airbus")],
    "reporteurs": [("1", None, None)],
    "daily_usage": [("A", "2024-1-1", Decimal("1.00"), 1, 1)], "reportage_usage": [("A", "202401", "1", 1, 0, 1)],
}


def test_new_warehouse_is_empty_and_can_be_opened(spark, tmp_path):
    Warehouse(spark, str(tmp_path / "w"), create=True)
    opened = Warehouse(spark, str(tmp_path / "w"))
    for name, df in opened.tables().items():
        assert df.count() == 0 and df.columns == TABLES[name].columns
    assert opened.table("nothing") is None


def test_opening_what_is_not_there(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Warehouse(spark, str(tmp_path / "none"))


def test_load_and_restart(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), create=True)
    results = {r.table: (r.written, r.rejected) for r in w.load(frames(spark, **SOUND))}
    assert list(results) == list(TABLES) and set(results.values()) == {(1, 0), (0, 0)}
    stored = w.table("daily_usage")
    assert [f.dataType for f in stored.schema] == [f.dataType for f in TABLES["daily_usage"].schema]
    assert tuple(stored.first()) == ("A", "2024-1-1", Decimal("1.00"), 1, 1)
    w.restart()
    assert all(df.count() == 0 for df in w.tables().values())


def test_broken_rows_are_set_aside(spark, tmp_path):
    rows = SOUND | {
        "aircrafts": [("A", "m", "Airbus"), ("A", "m", "Airbus"), ("B", "x", "Airbus"), ("B", "y", "Airbus"), (None, "z", "z")],
        "daily_usage": [
            ("A", "2024-1-1", Decimal("1.00"), 1, 1), ("B", "2024-1-1", Decimal("1.00"), 1, 1),
            ("F", "2024-9-9", Decimal("1.00"), 1, 1), (None, "2024-1-1", Decimal("1.00"), 1, 1),
            ("A", "2024-1-1", Decimal("123456789.00"), 1, 2**40),
        ],
    }
    w = Warehouse(spark, str(tmp_path / "w"), create=True)
    results = {r.table: (r.written, r.rejected) for r in w.load(frames(spark, **rows))}
    assert results["aircrafts"] == (2, 2)  # copies alike are one row; of rivals for a key the greatest stays
    assert {tuple(r) for r in w.table("aircrafts").collect()} == {("A", "m", "Airbus"), ("B", "y", "Airbus")}
    assert results["daily_usage"] == (3, 2)  # a missing reference passes
    reasons = sorted(tuple(r.reasons) for r in w.rejects("daily_usage").collect())
    assert reasons == [("orphan:registration", "orphan:day_id"), ("out_of_range:fh", "out_of_range:sto")]
    assert any("1099511627776" in r.row for r in w.rejects("daily_usage").collect())
    assert sorted(tuple(r.reasons) for r in w.rejects("aircrafts").collect()) == [
        ("duplicate_key:registration",), ("null_key:registration",)]


def stored_files(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in sorted(folder.rglob("*")) if p.is_file()}


def test_fail_publishes_nothing(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), create=True)
    w.load(frames(spark, **SOUND))
    before = stored_files(tmp_path / "w")
    rows = SOUND | {"days": [("2024-1-2", 2, "202401")], "daily_usage": [("F", "2024-1-2", Decimal("1.00"), 1, 1)]}
    with pytest.raises(ConstraintViolation, match="orphan:registration"):
        w.load(frames(spark, **rows), on_violation="fail")
    assert stored_files(tmp_path / "w") == before
    assert [r.day_id for r in Warehouse(spark, str(tmp_path / "w")).table("days").collect()] == ["2024-1-1"]
    with pytest.raises(ValueError):
        w.load(frames(spark), on_violation="ignore")


def test_a_failed_reload_changes_nothing(spark, make, tmp_path):
    sources = fixtures.sources(spark, SF)
    run_etl_on(spark, sources, str(tmp_path / "w"))
    before = stored_files(tmp_path / "w")
    broken = sources["reports"].withColumn("reportingdate", F.expr("if(reporteurid > 0, cast('no time' as timestamp_ntz), reportingdate)"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_etl_on(spark, sources | {"reports": broken}, str(tmp_path / "w"))
    assert stored_files(tmp_path / "w") == before
    assert Warehouse(spark, str(tmp_path / "w")).table("daily_usage").count() > 0


def test_a_run_without_its_marker_does_not_count(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), create=True)
    w.load(frames(spark, **SOUND))
    begin(spark, str(tmp_path / "w")).write_empty()
    assert Warehouse(spark, str(tmp_path / "w"), create=True).table("days").count() == 1


def test_jobs_of_one_etl(spark, tmp_path):
    """The number of Spark jobs is bounded: at this size they are most of the time."""
    context = spark.sparkContext
    tracker = context._jsc.sc().dagScheduler()
    first = tracker.nextJobId()
    run_etl_on(spark, fixtures.sources(spark, SF), str(tmp_path / "w"))
    assert tracker.nextJobId() - first <= MOST_JOBS


def test_primary_key_summary(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "registration string")
    assert tuple(primary_key_summary(df, TABLES["aircrafts"]).first()) == ("aircrafts", 4, 2, 1, 1)


def test_etl_round_trip(spark, tmp_path):
    sources = fixtures.sources(spark, SF)
    report = run_etl_on(spark, sources, str(tmp_path / "w"))
    assert report.rows_read == {"flights": 1007, "maintenance": 493, "reports": 6000}
    assert report.set_aside["aircrafts"] == 2
    w = Warehouse(spark, str(tmp_path / "w"))
    for result in report.loaded:
        assert w.table(result.table).count() == result.written
        assert w.rejects(result.table).count() == result.rejected
    live = transform(sources)
    loaded = {r.table: r.written + (0 if r.table in DIMENSIONS else r.rejected) for r in report.loaded}
    assert loaded == {n: df.count() for n, df in live.items()}
    # Orphans never reach the KPIs, so stored and live tables give the same.
    assert as_dicts(kpis.query_utilization(w.tables())) == as_dicts(kpis.query_utilization(live))
    logged = {r.rule_id: r.n for r in w.log("rule_violations").groupBy("rule_id")
              .agg({"cases": "sum"}).withColumnRenamed("sum(cases)", "n").collect()}
    summed = {r.rule_id: r.n for r in w.log("rule_summary").groupBy("rule_id")
              .agg({"hits": "sum"}).withColumnRenamed("sum(hits)", "n").collect()}
    assert logged == summed and logged["FOREIGN-AIRCRAFT"] > 0


def stage_rows(w):
    return {(r.stage, r.name): (r.rows, r.observed) for r in w.log("stage_counts").collect()}


@pytest.mark.parametrize("rules", [True, False])
def test_stage_counts(spark, tmp_path, rules):
    sources = fixtures.sources(spark, SF)
    report = run_etl_on(spark, sources, str(tmp_path / "w"), rules, log_violations=False)
    rows = stage_rows(Warehouse(spark, str(tmp_path / "w")))
    assert all(n == seen for n, seen in rows.values())
    assert {n: rows["read", n][0] for n in report.rows_read} == report.rows_read == {n: sources[n].count() for n in report.rows_read}
    assert {r.table: (rows["written", r.table][0], rows["set_aside", r.table][0]) for r in report.loaded} == {
        r.table: (r.written, r.rejected) for r in report.loaded}
    assert (("staged", "slots") in rows) == rules


def test_stage_counts_without_rows(spark, make, tmp_path):
    sources = {"flights": make.flights([]), "maintenance": make.maintenance([]), "reports": make.reports([]),
               "aircrafts": make.aircrafts([]), "personnel": make.personnel([])}
    run_etl_on(spark, sources, str(tmp_path / "w"))
    assert {n for n, _ in stage_rows(Warehouse(spark, str(tmp_path / "w"))).values()} == {0}


def test_loads_of_the_same_sources_share_what_is_staged(spark, tmp_path, monkeypatch):
    """The reports are counted once for all loads, the slots once for those with the rules; what is logged is the same."""
    staged = []

    class Seen(etl.Staging):
        def __call__(self, df, name):
            staged.append(name)
            return super().__call__(df, name)

    monkeypatch.setattr(etl, "Staging", Seen)
    sources = fixtures.sources(spark, SF)
    reduction = etl.Reduction(spark, sources)
    logs = {}
    for rules in (True, False, True):
        for at, shared in ((f"{tmp_path}/shared", reduction), (f"{tmp_path}/alone", None)):
            run_etl_on(spark, sources, at, rules, reduction=shared)
            found = [Warehouse(spark, at).log(n) for n in ("rule_violations", "stage_counts")]
            logs.setdefault(rules, []).append([sorted(map(repr, df.collect())) for df in found])
    reduction.close()
    assert all(seen == of[0] for of in logs.values() for seen in of)
    # Alone: three loads that count reports, two that decide slots. Shared: one each.
    assert staged.count("report_counts") == 4 and sum(n.startswith("slots") for n in staged) == 3


def test_a_load_without_the_log_stores_no_slots(spark, tmp_path, monkeypatch):
    staged = []

    class Seen(etl.Staging):
        def __call__(self, df, name):
            staged.append(name)
            return super().__call__(df, name)

    monkeypatch.setattr(etl, "Staging", Seen)
    counted = []
    for log in (True, False):
        staged.clear()
        run_etl_on(spark, fixtures.sources(spark, SF), str(tmp_path / f"w{log}"), log_violations=log)
        assert any(n.startswith("slots") for n in staged) == log
        counted.append(sorted(map(repr, Warehouse(spark, str(tmp_path / f"w{log}")).log("stage_counts").collect())))
    assert counted[0] == counted[1]
