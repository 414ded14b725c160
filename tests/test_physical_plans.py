"""What keeps the plans fit for large inputs."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from skyledger import fixtures
from skyledger.operators import overlap, reports
from skyledger.plans import kpis, violations, warehouse
from skyledger.plans import transform as tr
from skyledger.plans.etl import run_etl_on
from skyledger.plans.warehouse import Warehouse
from skyledger.schemas import TABLES

SF = "/root/testdata/sf0.001"
STAGED = ("kpi_", "pk_", "fk_", "reconcile_", "warehouse_", "logged_", "etl_", "op", "pipeline")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in entry_module.queries() if not n.startswith(STAGED)))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry_module.queries()[name](spark, SF))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas", "Window"):
        assert operator not in text, operator


def test_events_are_combined_before_the_first_shuffle(spark):
    text = plan(tr.usage(fixtures.sources(spark, SF)))
    first_shuffle = text.rindex("Exchange hashpartitioning")
    below = text[first_shuffle:]
    assert "start_hour" in below.splitlines()[0] and "end_hour" in below.splitlines()[0]
    assert "partial_min" in below


def test_day_and_month_grain_share_one_placement(spark):
    text = plan(tr.monthly_usage(tr.usage(fixtures.sources(spark, SF))))
    # (aircraft, day, slot), then (aircraft, month) for both grains.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2


def test_reports_are_counted_before_a_shuffled_join(spark):
    """A small lookup is broadcast and filters first; a large one meets counts."""
    kept = lambda: tr.transform(fixtures.sources(spark, SF))["reportage_usage"]
    assert "BroadcastHashJoin [" in plan(kept())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(kept())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.index("SortMergeJoin") < text.index("HashAggregate") < text.index("lineitem.parquet")


def test_only_used_columns_are_read(spark):
    text = plan(tr.transform(fixtures.sources(spark, SF))["reportage_usage"])
    schema = re.search(r"ReadSchema: struct<([^>]*l_[^>]*)>", text).group(1)
    used = {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate"}
    assert set(re.findall(r"(l_\w+):", schema)) <= used


def test_reports_hash_before_the_first_shuffle(spark):
    """The frame that a load stages carries the latest class; no report is sorted for it."""
    text = plan(reports.count_reports(fixtures.sources(spark, SF)["reports"]))
    assert "SortAggregate" not in text[text.rindex("Exchange hashpartitioning") :]


def test_rule_hits_read_the_events_twice(spark):
    """Once for the decisions and once to join them back."""
    sources = fixtures.sources(spark, SF)
    text = plan(violations.rule_violations(sources | {"reports": sources["reports"].limit(0)}))
    assert text.count("orders.parquet") <= 4 and text.count("Join") <= 2


def test_no_forced_broadcast(spark):
    for name in ("fact_reportage_usage", "raw_utilization", "br21_decisions", "rule_violations"):
        assert "strategy=broadcast" not in optimized(entry_module.queries()[name](spark, SF))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    location = str(tmp_path_factory.mktemp("plans") / "w")
    run_etl_on(spark, fixtures.sources(spark, SF), location, log_violations=False, database="plans_test")
    return Warehouse(spark, location)


def test_a_kpi_of_one_year_reads_its_partition(spark, stored):
    for kpi in (kpis.query_utilization, kpis.query_reporting, kpis.query_reporting_per_role):
        for tables in (stored.tables(partitions=True), {n: spark.table(f"plans_test.{n}") for n in TABLES}):
            of_year = kpi(tables).where("year = 1995")
            scans = [n for n in of_year._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters: [isnotnull(year" in n]
            assert len(scans) == 2 and all(re.search(r"\(year#\d+L? = 1995\)", n) for n in scans)
            whole = [tuple(r) for r in kpi(stored.tables()).collect() if r.year == 1995]
            assert sorted(map(tuple, of_year.collect())) == sorted(whole) and whole


def test_files_of_one_year_are_all_that_is_read(spark, stored):
    fact = stored.tables(partitions=True)["daily_usage"]
    files = {r[0] for r in fact.where("year = 1995").select(F.input_file_name()).distinct().collect()}
    assert files and all("/year=1995/" in f for f in files)
    assert len(files) <= 2  # a year is a few files, however many tasks there are


def test_years_found_at_run_time_prune_too(spark, stored):
    """A condition on the calendar, here on the month, leaves out the partitions of other years."""
    tables = stored.tables(partitions=True)
    tables["months"] = tables["months"].where("month_id like '1996%'")
    assert "dynamicpruning" in plan(kpis.query_reporting(tables))


def test_gathered_slots_are_bounded(spark, make):
    """Many events of one aircraft and day arrive as one row per distinct slot."""
    rows = [("A", "2024-01-05T00:00", "2024-01-05T00:00", f"2024-01-05T{h:02}:{m:02}", f"2024-01-05T{(h * 7 + m) % 24:02}:30", False)
            for h in range(24) for m in range(60)] * 5
    events = overlap.activity_events(make.flights(rows), make.maintenance([]))
    assert overlap.distinct_slots(events).count() <= 24 * 24


def test_reasons_are_gathered_only_for_rows_that_have_one(spark):
    text = optimized(warehouse._fitted(spark.range(1).selectExpr("'A' registration", "'1' day_id", "id fh", "id tos", "id sto"), TABLES["daily_usage"]))
    assert "if (" in text.lower() and text.index("if (") < text.index("filter(")


def test_days_of_one_or_two_slots_are_decided_without_a_fold(spark, make):
    flights = make.flights([
        ("A", "2024-01-05T00:00", "2024-01-05T00:00", "2024-01-05T08:00", "2024-01-05T10:00", False),
        ("B", "2024-01-05T00:00", "2024-01-05T00:00", "2024-01-05T09:30", "2024-01-05T12:00", False),
        ("B", "2024-01-05T00:00", "2024-01-05T00:00", "2024-01-05T08:00", "2024-01-05T10:00", False),
        ("C", "2024-01-05T00:00", "2024-01-05T00:00", "2024-01-05T12:00", "2024-01-05T13:00", False),
        ("C", "2024-01-05T00:00", "2024-01-05T00:00", "2024-01-05T08:00", "2024-01-05T10:00", False),
        ("D", "2024-01-05T00:00", "2024-01-05T00:00", None, None, None),
        ("E", "2024-01-05T00:00", "2024-01-05T00:00", None, None, None),
        ("E", "2024-01-05T00:00", "2024-01-05T00:00", "2024-01-05T12:00", "2024-01-05T13:00", False),
    ])
    decided = overlap.decided_slots(overlap.activity_events(flights, make.maintenance([])))
    text = optimized(decided)
    assert text.index("CASE WHEN ((size(") < text.index("aggregate(")
    taken = {r.registration: [e.start_hour for e in r.taken] for r in decided.collect()}
    assert taken == {"A": [8], "B": [8], "C": [8, 12], "D": [], "E": [12]}


def test_reports_are_sorted_once(spark):
    """The rows per class are placed by the final key: no aggregate that sorts feeds a shuffle. Counts without roles hash."""
    counts = reports.count_reports(fixtures.sources(spark, SF)["reports"])
    assert "SortAggregate" not in plan(counts)[plan(counts).index("Exchange hashpartitioning") :]
    assert "SortAggregate" not in plan(reports.count_reports(fixtures.sources(spark, SF)["reports"], roles=False))


def test_kpis_of_reports_stage_counts_without_roles(spark, monkeypatch):
    staged = {}

    class Seen(entry_module.Staging):
        def __call__(self, df, name):
            staged[name] = df.columns
            return super().__call__(df, name)

    monkeypatch.setattr(entry_module, "Staging", Seen)
    for name in ("kpi_reporting", "reconcile_reporting"):
        staged.clear()
        entry_module.queries()[name](spark, SF)
        assert "last" not in staged["report_counts"] and "reps" in staged["report_counts"]


def test_reporter_roles_hash_before_the_shuffle(spark):
    """Only one row per reporter and class is compared, not every count."""
    counts = reports.count_reports(fixtures.sources(spark, SF)["reports"])
    text = plan(reports.reporter_roles(counts))
    latest = text.index("HashAggregate(keys=[reporteur_uid")
    assert text.index("SortAggregate(key=[reporteur_uid") < latest < text.index("SortAggregate(key=[registration")


def test_source_files_are_written_side_by_side(spark, monkeypatch):
    sizes, together = [], warehouse.together

    def seen(jobs):
        jobs = list(jobs)
        sizes.append(len(jobs))
        return together(jobs)

    monkeypatch.setattr(warehouse, "together", seen)
    entry_module._as_files(spark, SF)
    assert sizes == [5]
