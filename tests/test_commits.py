"""Commits: one at a time, readable while others load, cleaned up by commits and age."""

from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

import pytest

from skyledger.plans import commits
from skyledger.plans.catalog import WarehouseCatalog
from skyledger.plans.commits import CommitLog, Retention, Superseded
from skyledger.plans.warehouse import Warehouse, begin, published
from skyledger.schemas import FACTS, TABLES
from skyledger.sources import paths
from test_warehouse import SOUND, frames

AT_ONCE = Retention(commits=1, replaced=timedelta(0), unfinished=timedelta(0))
DAY = 24 * 60 * 60 * 1000


def days(warehouse, at=None):
    return [r.day_id for r in warehouse.table("days", at).collect()]


def dated(day):
    return SOUND | {"days": [(f"2024-1-{day}", day, "202401")], "daily_usage": []}


def runs(location):
    return sorted(p.name for p in (location / "runs").iterdir())


@pytest.mark.parametrize("way", ["link", "rename"])
def test_a_name_is_given_once(spark, tmp_path, way, monkeypatch):
    if way == "rename":
        monkeypatch.setattr(paths, "_link", paths._rename)
    assert paths.create_once(spark, f"{tmp_path}/c/1.json", "first") and not paths.create_once(spark, f"{tmp_path}/c/1.json", "second")
    assert paths.read_line(spark, f"{tmp_path}/c/1.json") == "first"
    assert paths.children(spark, f"{tmp_path}/c") == ["1.json"]


def test_many_writers_get_a_number_each(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: log.add(f"run{i}", "load"), range(24)))
    assert sorted(c.number for c in made) == list(range(1, 25))
    assert {c.run: c.number for c in log.all()} == {c.run: c.number for c in made}


def test_only_one_of_those_that_want_to_be_alone(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    log.add("before", "load")

    def attempt(i):
        try:
            return log.add(f"run{i}", "load", after=1).number
        except Superseded:
            return None

    with ThreadPoolExecutor(8) as pool:
        made = [n for n in pool.map(attempt, range(8)) if n]
    assert made == [2]


def test_two_loads_at_a_time_and_one_broken_off(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), create=True)
    broken = begin(spark, w.location)
    broken.load(frames(spark, **dated(9)))  # its process ends here, before the commit
    first, second = begin(spark, w.location), begin(spark, w.location)
    second.load(frames(spark, **dated(2)))
    assert second.publish().number == 2 and days(w) == ["2024-1-2"]
    w.clean(Retention(commits=1, replaced=timedelta(0)))  # while the first is still at work
    first.load(frames(spark, **dated(1)))
    assert first.publish().number == 3 and days(w) == ["2024-1-1"]
    assert days(w, at=2) == ["2024-1-2"] and [c.number for c in w.available()] == [2, 3]
    assert broken.name in runs(tmp_path / "w")
    assert days(Warehouse(spark, w.location)) == ["2024-1-1"]


def test_clean_up_goes_by_commits_and_age(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), create=True)
    for day in (1, 2, 3):
        with published(spark, w.location, retention=None) as run:
            run.load(frames(spark, **dated(day)))
    idle = begin(spark, w.location)
    now = commits.file_system_now(spark, w.location)
    names = {c.number: c.run for c in w.history()}
    assert w.clean(now=now) == []  # replaced less than a day ago
    assert w.clean(now=now + 2 * DAY) == [names[2], names[1]]  # the last two commits stay
    assert days(w, at=3) == ["2024-1-2"] and days(w) == ["2024-1-3"]
    assert w.clean(now=now + 6 * DAY) == [] and idle.name in runs(tmp_path / "w")
    assert w.clean(now=now + 8 * DAY) == [idle.name]
    assert [c.number for c in w.history()] == [1, 2, 3, 4] and [c.number for c in w.available()] == [3, 4]
    assert w.clean(AT_ONCE) == [names[3]] and days(w) == ["2024-1-3"]


def test_a_late_load_may_ask_to_be_alone(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), create=True)
    with pytest.raises(Superseded), published(spark, w.location, alone=True) as late:
        late.load(frames(spark, **dated(1)))
        w.load(frames(spark, **dated(2)))
    assert days(w) == ["2024-1-2"] and late.name not in runs(tmp_path / "w")


def test_a_run_that_lacks_a_table_is_not_published(spark, tmp_path):
    Warehouse(spark, str(tmp_path / "w"), create=True)
    with pytest.raises(FileNotFoundError, match="lacks"):
        begin(spark, str(tmp_path / "w")).publish()


def test_logs_outlive_their_runs(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), create=True)
    assert w.log_history("hits") is None
    for n in (1, 2, 3):
        with published(spark, w.location, retention=AT_ONCE) as run:
            run.load(frames(spark, **dated(n)))
            run.write_log(spark.createDataFrame([(n,)] * n, "hit int"), "hits")
    with pytest.raises(ZeroDivisionError), published(spark, w.location) as run:
        run.write_log(spark.createDataFrame([(9,)], "hit int"), "hits")
        1 / 0
    begin(spark, w.location).write_log(spark.createDataFrame([(8,)], "hit int"), "hits")  # broken off
    assert len(w.available()) == 1
    assert sorted(tuple(r) for r in w.log_history("hits").select("commit", "hit").collect()) == [(2, 1), (3, 2), (3, 2), (4, 3), (4, 3), (4, 3)]
    assert [r.hit for r in w.log("hits").collect()] == [3, 3, 3]
    w.clean(AT_ONCE)
    assert sorted(p.name for p in (tmp_path / "w" / "logs" / "hits").iterdir()) == sorted(f"run={c.run}" for c in w.history()[1:])


def test_facts_are_stored_by_the_year_of_their_calendar_row(spark, tmp_path):
    rows = SOUND | {
        "days": [("2024-1-1", 1, "202401"), ("odd", 1, "202312"), ("lost", 1, "none")],
        "months": [("202401", 1, 2024), ("202312", 12, 2023), ("no year", 1, None)],
        "daily_usage": [("A", "2024-1-1", None, 1, 1), ("A", "odd", None, 2, 2), ("A", "lost", None, 3, 3), ("A", None, None, 4, 4)],
        "monthly_usage": [("A", "202312", *[None] * 7), ("A", "no year", *[None] * 7)],
    }
    w = Warehouse(spark, str(tmp_path / "w"), create=True)
    w.load(frames(spark, **rows))
    stored = w.tables(partitions=True)
    assert {(r.tos, r.year) for r in stored["daily_usage"].collect()} == {(1, 2024), (2, 2023), (3, None), (4, None)}
    assert {(r.month_id, r.year) for r in stored["monthly_usage"].collect()} == {("202312", 2023), ("no year", None)}
    assert w.table("daily_usage").columns == TABLES["daily_usage"].columns
    folder = tmp_path / "w" / "runs" / w.history()[-1].run
    for fact in FACTS:
        assert all(p.name.startswith("year=") for p in (folder / fact).iterdir() if p.is_dir())
    assert sorted(p.name for p in (folder / "daily_usage").iterdir() if p.is_dir()) == [
        "year=2023", "year=2024", "year=__HIVE_DEFAULT_PARTITION__"]


def test_names_move_to_the_last_commit(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), create=True)
    catalog = WarehouseCatalog(w, "fleet_test")
    names = [f"fleet_test.{t}" for t in TABLES]
    assert catalog.sync() == 1 and all(spark.catalog.tableExists(n) and spark.table(n).count() == 0 for n in names)
    w.load(frames(spark, **SOUND))
    assert spark.table("fleet_test.days").count() == 0
    assert catalog.sync() == 2 and catalog.sync() == 2
    assert spark.sql("SELECT d.month_id, u.year, u.tos FROM fleet_test.daily_usage u JOIN fleet_test.days d USING (day_id)").collect() == [("202401", 2024, 1)]
    assert spark.table("fleet_test.daily_usage_c1").count() == 0  # a commit by its number
    w.load(frames(spark, **dated(7)))
    w.clean(AT_ONCE)
    assert catalog.sync() == 3 and [r.day_id for r in spark.table("fleet_test.days").collect()] == ["2024-1-7"]
    assert sorted(t.name for t in spark.catalog.listTables("fleet_test")) == sorted([*TABLES, *[f"{t}_c3" for t in TABLES]])
