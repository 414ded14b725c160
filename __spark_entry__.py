"""Registered queries and their expected results.

``queries()`` maps a name to a function of (spark, folder of tables); the
matching DuckDB SQL is in ``oracle_queries.py``. KPI queries stage the two
grouped frames the star schema is derived from, as the stored warehouse does.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle_queries  # noqa: E402
from skyledger import fixtures, schemas  # noqa: E402
from skyledger.functions import predicates as P  # noqa: E402
from skyledger.functions import temporal as t  # noqa: E402
from skyledger.operators import reports  # noqa: E402
from skyledger.operators.ordering import with_position  # noqa: E402
from skyledger.plans import etl, kpis, raw_kpis, violations, warehouse  # noqa: E402
from skyledger.plans import transform as tr  # noqa: E402
from skyledger.plans.commits import Retention  # noqa: E402
from skyledger.plans.reconcile import REPORTING, UTILIZATION, reconcile  # noqa: E402
from skyledger.sources import SourceConfig, TableSource, read_sources, readers  # noqa: E402
from skyledger.sources.paths import Staging  # noqa: E402
from skyledger.sources.readers import project  # noqa: E402

# Training-data operators are a part by themselves: everything else works without them.
try:
    import corpus_pipeline
    from skyledger.llm import queries as training_data
except ImportError:
    corpus_pipeline = training_data = None

Sources = dict[str, DataFrame]
Query = Callable[[SparkSession, str], DataFrame]


def _on_sources(fn: Callable[[Sources], DataFrame]) -> Query:
    return lambda spark, folder: fn(fixtures.sources(spark, folder))


def _on_tables(
    fn: Callable[[Sources, dict[str, DataFrame]], DataFrame], rules: bool = True, reported: bool = True, roles: bool = True
) -> Query:
    """The star schema from staged frames, for queries over several tables.

    Without ``reported`` there are no reports in it, for queries that read none; without ``roles`` no table
    ``reporteurs``, for queries that count reports and do not ask who reported.
    """

    def run(spark: SparkSession, folder: str) -> DataFrame:
        sources, stage = fixtures.sources(spark, folder), Staging(spark)
        if reported:
            grains = tr.grains(sources, rules, stage, roles)
        else:
            none = reports.count_reports(sources["reports"]).where(F.lit(False))
            grains = tr.Grains(stage(tr.usage(sources, rules), "usage_by_day"), none)
        return fn(sources, tr.tables(grains, sources["aircrafts"], sources["personnel"]))

    return run


def _fitted(name: str, rules: bool = True) -> Query:
    """One table with its declared types. Nothing is shared, so nothing is staged."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        table = schemas.TABLES[name]
        df = tr.transform(fixtures.sources(spark, folder), rules)[name]
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])

    return run


def _date_codes(s: Sources) -> DataFrame:
    ts = F.col("scheduleddeparture")
    month = [c for c in t.month_columns(ts)][1:]
    return s["flights"].select("row_key", *t.day_columns(ts), *month)


def _hour_code(s: Sources) -> DataFrame:
    return s["flights"].select(
        "row_key",
        t.hour_code(F.col("actualdeparture")).alias("departure_code"),
        t.hour_code(F.col("actualarrival")).alias("arrival_code"),
        t.slot_hour(F.col("actualdeparture")).alias("departure_hour"),
    )


def _time_differences(s: Sources) -> DataFrame:
    seconds = t.seconds_between(F.col("actualdeparture"), F.col("actualarrival")).cast("double")
    return s["flights"].select("row_key", seconds.alias("seconds"), (seconds / t.SECONDS_PER_HOUR).alias("hours"))


def _effective_cancellation(s: Sources) -> DataFrame:
    c = F.col
    return s["flights"].select(
        "row_key",
        c("cancelled").alias("flagged"),
        P.effectively_cancelled(c("cancelled"), c("actualdeparture"), c("actualarrival")).alias("effectively_cancelled"),
    )


def _delay_flags(s: Sources) -> DataFrame:
    delay = P.delay_seconds(F.col("scheduleddeparture"), F.col("actualdeparture"))
    return s["flights"].select(
        "row_key",
        delay.cast("double").alias("delay_s"),
        P.is_delayed(delay).alias("delayed"),
        (P.counted_delay(delay).cast("double") / t.SECONDS_PER_HOUR).alias("delay_hours"),
    )


def _maintenance_split(s: Sources) -> DataFrame:
    out = t.seconds_between(F.col("scheduleddeparture"), F.col("scheduledarrival")).cast("double") / t.SECONDS_PER_DAY
    programmed = P.flagged(F.col("programmed"))
    return s["maintenance"].select(
        "row_key",
        out.alias("days"),
        F.when(programmed, out).otherwise(0.0).alias("scheduled_days"),
        F.when(programmed, 0.0).otherwise(out).alias("unscheduled_days"),
    )


def _report_classes(s: Sources) -> DataFrame:
    marep, pirep = P.is_marep(F.col("reporteurclass")), P.is_pirep(F.col("reporteurclass"))
    return (
        s["reports"]
        .groupBy(P.reporter_key(F.col("reporteurid")).alias("reporteur_uid"))
        .agg(
            F.count_if(marep).alias("mareps"),
            F.count_if(pirep).alias("pireps"),
            F.count_if(~marep & ~pirep).alias("others"),
        )
    )


def _manufacturer_lookup(s: Sources) -> DataFrame:
    counted = s["flights"].groupBy(F.col("aircraftregistration").alias("registration")).agg(F.count("*").alias("flights"))
    return raw_kpis.named_manufacturer(counted, s["aircrafts"]).select("registration", "manufacturer", "flights")


def _source_name() -> F.Column:
    return violations._source().alias("source")


def _br21_decisions(s: Sources) -> DataFrame:
    return violations.event_decisions(s).select("row_key", _source_name(), (F.col("accepted") > 0).alias("accepted"))


def _br23_swapped(s: Sources) -> DataFrame:
    return violations.swapped_flights(violations.event_decisions(s)).select(
        "row_key",
        "registration",
        t.day_id(F.col("day")).alias("day_id"),
        t.seconds_between(F.col("ended"), F.col("began")).cast("double").alias("seconds"),
    )


def _rule_violations(s: Sources) -> DataFrame:
    text = lambda slot: F.concat_ws("-", slot["start_hour"].cast("string"), slot["end_hour"].cast("string"))
    return violations.rule_violations(s).select(
        "rule_id",
        "registration",
        "day_id",
        "source",
        F.when(F.col("slot").isNotNull(), text(F.col("slot"))).alias("slot"),
        F.array_join(F.transform("existing_slots", text), ",").alias("existing_slots"),
        "ts",
    )


def _reports_foreign(s: Sources) -> DataFrame:
    return violations.foreign_reports(reports.count_reports(s["reports"]), s["aircrafts"])


def _rule_summary(spark: SparkSession, folder: str) -> DataFrame:
    sources = fixtures.sources(spark, folder)
    return violations.rule_summary(
        tr.usage(sources), reports.count_reports(sources["reports"]), sources["aircrafts"]
    )


def _pk_violations(s: Sources, tables: dict[str, DataFrame]) -> DataFrame:
    """Over the rows before the load chooses among them."""
    found = tables | {"aircrafts": tr.aircrafts(s["aircrafts"])}
    summaries = [warehouse.primary_key_summary(found[n], schemas.TABLES[n]) for n in schemas.DIMENSIONS]
    first, *rest = summaries
    for summary in rest:
        first = first.unionByName(summary)
    return first


def _lookup_rivals(s: Sources) -> DataFrame:
    return warehouse.set_aside(tr.aircrafts(s["aircrafts"]), schemas.TABLES["aircrafts"])


def _fk_orphans(fact: str) -> Query:
    """Rows that miss a dimension row; for reports before those on foreign aircraft are left out."""

    def run(s: Sources, tables: dict[str, DataFrame]) -> DataFrame:
        table = schemas.TABLES[fact]
        rows = tables[fact]
        if fact == "reportage_usage":
            rows = tr.reportage_usage(reports.count_reports(s["reports"]))
        found = [
            warehouse.orphans(rows, tables[dimension], column, schemas.TABLES[dimension].primary_key).select(
                *table.foreign_keys, F.lit(column).alias("missing")
            )
            for column, dimension in table.foreign_keys.items()
        ]
        first, *rest = found
        for df in rest:
            first = first.unionByName(df)
        return first

    return _on_tables(run, reported=fact == "reportage_usage")


def _stored_counts(spark: SparkSession, location: str) -> DataFrame:
    stored = warehouse.Warehouse(spark, location)
    counts = [
        df.agg(F.count("*").alias("written")).select(
            F.lit(name).alias("table_name"), "written", F.lit(stored.rejects(name).count()).cast("long").alias("rejected")
        )
        for name, df in stored.tables().items()
    ]
    return _union(counts)


def _warehouse_load(spark: SparkSession, folder: str) -> DataFrame:
    """A full run, with the log of rule hits, into a warehouse beside the staged data; what was written and set aside."""
    location = Staging(spark).folder
    etl.run_etl_on(spark, fixtures.sources(spark, folder), location)
    return _stored_counts(spark, location)


def _logged_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Cases per rule and source in the table that a run writes."""
    location = Staging(spark).folder
    etl.run_etl_on(spark, fixtures.sources(spark, folder), location)
    logged = warehouse.Warehouse(spark, location).log("rule_violations")
    return logged.groupBy("rule_id", "source").agg(F.sum("cases").cast("long").alias("cases"))


def _as_files(spark: SparkSession, folder: str) -> SourceConfig:
    """The source relations as files of several formats, with columns in another order and one too many."""
    sources = fixtures.sources(spark, folder)
    at = Staging(spark).folder
    mixed = sources["flights"].select(F.lit("x").alias("remark"), *reversed(sources["flights"].columns))
    lookups = f"{at}/lookups"
    aircrafts = sources["aircrafts"].select(
        F.col("registration").alias("aircraft_reg_code"),
        F.lit("MSN").alias("manufacturer_serial_number"),
        F.col("model").alias("aircraft_model"),
        F.col("manufacturer").alias("aircraft_manufacturer"),
    )
    kept_blanks = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    warehouse.together([
        lambda: mixed.write.csv(f"{at}/flights", header=True),
        lambda: sources["maintenance"].write.json(f"{at}/maintenance"),
        lambda: sources["reports"].write.parquet(f"{at}/reports"),
        lambda: aircrafts.write.csv(f"{lookups}/{readers.AIRCRAFT_FILES[1]}", **kept_blanks),
        lambda: sources["personnel"].write.csv(f"{lookups}/{readers.PERSONNEL_FILE}", **kept_blanks),
    ])
    return SourceConfig(
        TableSource(f"{at}/flights", "csv"),
        TableSource(f"{at}/maintenance", "json", row_key=True),
        TableSource(f"{at}/reports"),
        lookups,
    )


def _from_files(name: str) -> Query:
    return lambda spark, folder: read_sources(spark, _as_files(spark, folder))[name]


def _etl_from_files(spark: SparkSession, folder: str) -> DataFrame:
    location = Staging(spark).folder
    etl.run_etl(spark, _as_files(spark, folder), location)
    return _stored_counts(spark, location)


def _with_broken_lines(spark: SparkSession, folder: str) -> SourceConfig:
    """The source relations as files, with short, long and unclosed lines in both lookup files."""
    config = _as_files(spark, folder)
    sources, lookups = fixtures.sources(spark, folder), f"{Staging(spark).folder}/lookups"

    def store(lines: DataFrame, header: str, name: str) -> None:
        as_they_are = {"sep": "\u0001", "quote": "", "escape": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        lines.select(F.col("line").alias(header)).write.options(header=True, **as_they_are).csv(f"{lookups}/{name}")

    def lines(rows: DataFrame, sound: F.Column, key: F.Column, number: F.Column) -> DataFrame:
        broken = F.array(
            F.when(number % 5 == 0, key),
            F.when(number % 9 == 0, F.concat(sound, F.lit(',"more, and",more'))),
            F.when(number % 8 == 0, F.concat(sound, F.lit('"'))),
        )
        return rows.select(F.explode(F.array_compact(F.concat(F.array(sound), broken))).alias("line"))

    c = F.col
    registration = F.coalesce(c("registration"), F.lit(""))
    aircraft = F.concat_ws(",", registration, F.lit("MSN"), c("model"), c("manufacturer"))
    numbered = F.substring(c("registration"), 4, 20).cast("long")
    store(lines(sources["aircrafts"], aircraft, registration, numbered), "aircraft_reg_code,manufacturer_serial_number,aircraft_model,aircraft_manufacturer", readers.AIRCRAFT_FILES[0])
    person = F.concat_ws(",", c("reporteurid"), c("airport"))
    store(lines(sources["personnel"], person, c("reporteurid"), F.trim("reporteurid").cast("long")), "reporteurid,airport", readers.PERSONNEL_FILE)
    return replace(config, lookup_folder=lookups, broken_lines="set_aside")


def _broken_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What a load sets aside of the lookup files."""
    location = Staging(spark).folder
    etl.run_etl(spark, _with_broken_lines(spark, folder), location)
    logged = warehouse.Warehouse(spark, location).log("broken_lines")
    return logged.groupBy("file", "line", "reason").agg(F.count("*").alias("copies"))


def _etl_with_broken_lines(spark: SparkSession, folder: str) -> DataFrame:
    location = Staging(spark).folder
    etl.run_etl(spark, _with_broken_lines(spark, folder), location)
    return _stored_counts(spark, location)


def _stored_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by commit and table: a new warehouse, a load that was broken off, two loads at a time, a clean-up."""
    location = Staging(spark).folder
    stored = warehouse.Warehouse(spark, location, create=True)
    warehouse.begin(spark, location).write_empty()
    load = lambda: etl.run_etl_on(spark, fixtures.sources(spark, folder), location, log_violations=False)
    warehouse.together([load, load])
    stored.clean()
    counts = [
        df.agg(F.count("*").alias("written")).select(F.lit(c.number).alias("commit"), F.lit(c.kind).alias("kind"), F.lit(name).alias("table_name"), "written")
        for c in stored.available()
        for name, df in stored.tables(c.number).items()
    ]
    return _union(counts)


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df)
    return first


REPORTING_BY_NAME = """
WITH calendar AS (
    SELECT d.day_id, m.year FROM {db}.days d JOIN {db}.months m ON m.month_id = d.month_id
), flown AS (
    SELECT a.manufacturer, c.year, sum(u.fh) AS fh, sum(u.tos) AS tos
    FROM {db}.daily_usage u JOIN calendar c ON c.day_id = u.day_id AND c.year = u.year JOIN {db}.aircrafts a ON a.registration = u.registration
    GROUP BY a.manufacturer, c.year
), reported AS (
    SELECT a.manufacturer, m.year, sum(u.reps) AS reps
    FROM {db}.reportage_usage u JOIN {db}.months m ON m.month_id = u.month_id AND m.year = u.year JOIN {db}.aircrafts a ON a.registration = u.registration
    GROUP BY a.manufacturer, m.year
)
SELECT manufacturer, year, 1000D * {per_hour} AS rrh, 100D * {per_cycle} AS rrc FROM flown JOIN reported USING (manufacturer, year)
"""


def _reporting_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Q2 as SQL over table names, which the second of two loads has moved."""
    location, database = Staging(spark).folder, f"fleet_{uuid.uuid4().hex[:12]}"
    for rules in (False, True):
        etl.run_etl_on(spark, fixtures.sources(spark, folder), location, rules, log_violations=False, database=database)
    rates = {"per_hour": kpis.ratio("reps", "fh", 3), "per_cycle": kpis.ratio("reps", "tos", 2)}
    return spark.sql(REPORTING_BY_NAME.format(db=database, **rates))


def _one_year(spark: SparkSession, folder: str) -> DataFrame:
    """Q1 of the last year of a stored warehouse, which reads the files of that year."""
    location = Staging(spark).folder
    etl.run_etl_on(spark, fixtures.sources(spark, folder), location, log_violations=False)
    tables = warehouse.Warehouse(spark, location).tables(partitions=True)
    last = tables["months"].agg(F.max("year")).first()[0]
    return kpis.query_utilization(tables).where(F.col("year") == last)


def _log_over_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Cases by load, of three loads of which the second applies no rules; the tables of the first are gone."""
    location, sources = Staging(spark).folder, fixtures.sources(spark, folder)
    reduction = etl.Reduction(spark, sources)
    for rules in (True, False, True):
        etl.run_etl_on(spark, sources, location, rules, reduction=reduction)
    reduction.close()
    stored = warehouse.Warehouse(spark, location)
    stored.clean(Retention(commits=2, replaced=timedelta(0)))
    logged = stored.log_history("rule_violations")
    return logged.groupBy("commit", "rule_id", "source").agg(F.sum("cases").cast("long").alias("cases"))


def _stage_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows read, staged, written and set aside by a load, as it counted them."""
    location = Staging(spark).folder
    etl.run_etl_on(spark, fixtures.sources(spark, folder), location, log_violations=False)
    return warehouse.Warehouse(spark, location).log("stage_counts")


def _restarted(spark: SparkSession, folder: str) -> DataFrame:
    """Rows before and after a warehouse is emptied, and opened again."""
    location = Staging(spark).folder
    etl.run_etl_on(spark, fixtures.sources(spark, folder), location, log_violations=False)
    warehouse.Warehouse(spark, location).restart()
    stored = warehouse.Warehouse(spark, location, create=True)
    count = lambda df, name: df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
    before = _union([count(df, name) for name, df in stored.tables(at=1).items()]).withColumnRenamed("rows", "loaded")
    return before.join(_union([count(df, name) for name, df in stored.tables().items()]), "table_name")


def _failed_load(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a warehouse after a load that was told to fail on broken keys: those of the load before."""
    location = Staging(spark).folder
    etl.run_etl_on(spark, fixtures.sources(spark, folder), location, False, log_violations=False)
    try:
        etl.run_etl_on(spark, fixtures.sources(spark, folder), location, on_violation="fail")
        failed = False
    except warehouse.ConstraintViolation:
        failed = True
    return _stored_counts(spark, location).withColumn("second_load_failed", F.lit(failed))


def _positions(kpi: Callable[[dict[str, DataFrame]], DataFrame], *keys: str) -> Query:
    """A KPI with the place of each row in its order."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        sources = fixtures.sources(spark, folder)
        grains = tr.grains(sources, True, Staging(spark), roles=False)
        found = kpi(tr.tables(grains, sources["aircrafts"], sources["personnel"]))
        return with_position(found, [F.col(k).asc_nulls_last() for k in keys], Staging(spark))

    return run


def _raw(fn: Callable[..., DataFrame], *names: str) -> Query:
    return _on_sources(lambda s: fn(*[s[n] for n in names]))


_RAW = {
    "raw_utilization": (raw_kpis.query_utilization_baseline, ("flights", "maintenance", "aircrafts")),
    "raw_reporting": (raw_kpis.query_reporting_baseline, ("flights", "reports", "aircrafts")),
    "raw_reporting_per_role": (raw_kpis.query_reporting_per_role_baseline, ("flights", "reports", "aircrafts")),
}


def _reconcile(kpi: Callable, raw_name: str, measures: list[str], keys: list[str] | None = None) -> Query:
    raw, names = _RAW[raw_name]
    return _on_tables(lambda s, tables: reconcile(kpi(tables), raw(*[s[n] for n in names]), measures, keys), roles=False)


def entry(spark: SparkSession) -> DataFrame:
    """Fleet utilization by manufacturer and year."""
    return queries()["kpi_utilization"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "source_flights": _on_sources(lambda s: project(s["flights"], schemas.FLIGHTS, keep_key=True)),
        "source_maintenance": _on_sources(lambda s: project(s["maintenance"], schemas.MAINTENANCE, keep_key=True)),
        "source_reports": _on_sources(lambda s: project(s["reports"], schemas.REPORTS)),
        "source_lookup_aircrafts": _from_files("aircrafts"),
        "source_lookup_personnel": _from_files("personnel"),
        "source_files_flights": _from_files("flights"),
        "source_files_maintenance": _from_files("maintenance"),
        "etl_from_files": _etl_from_files,
        "date_codes": _on_sources(_date_codes),
        "hour_code": _on_sources(_hour_code),
        "time_differences": _on_sources(_time_differences),
        "effective_cancellation": _on_sources(_effective_cancellation),
        "delay_flags": _on_sources(_delay_flags),
        "maintenance_split": _on_sources(_maintenance_split),
        "report_classes": _on_sources(_report_classes),
        "manufacturer_lookup": _on_sources(_manufacturer_lookup),
        "aircraft_by_manufacturer": _on_sources(lambda s: raw_kpis.aircraft_by_manufacturer(s["aircrafts"])),
        "br21_decisions": _on_sources(_br21_decisions),
        "br23_swapped": _on_sources(_br23_swapped),
        "rule_violations": _on_sources(_rule_violations),
        "reports_foreign": _on_sources(_reports_foreign),
        "rule_summary": _rule_summary,
        "lookup_rivals": _on_sources(_lookup_rivals),
        "logged_violations": _logged_violations,
        "pk_violations": _on_tables(_pk_violations),
        "fk_orphans_daily": _fk_orphans("daily_usage"),
        "fk_orphans_monthly": _fk_orphans("monthly_usage"),
        "fk_orphans_reportage": _fk_orphans("reportage_usage"),
        "warehouse_load": _warehouse_load,
        "warehouse_broken_lines": _broken_lines,
        "warehouse_with_broken_lines": _etl_with_broken_lines,
        "warehouse_stored_runs": _stored_runs,
        "warehouse_by_name": _reporting_by_name,
        "warehouse_one_year": _one_year,
        "warehouse_log_over_loads": _log_over_loads,
        "warehouse_stage_counts": _stage_counts,
        "warehouse_restarted": _restarted,
        "warehouse_failed_load": _failed_load,
        "kpi_utilization_positions": _positions(kpis.query_utilization, "manufacturer", "year"),
        "kpi_reporting_per_role_positions": _positions(kpis.query_reporting_per_role, "manufacturer", "year", "role"),
        "kpi_utilization": _on_tables(lambda s, tables: kpis.query_utilization(tables), reported=False),
        "kpi_utilization_norules": _on_tables(lambda s, tables: kpis.query_utilization(tables), rules=False, reported=False),
        "kpi_reporting": _on_tables(lambda s, tables: kpis.query_reporting(tables), roles=False),
        "kpi_reporting_per_role": _on_tables(lambda s, tables: kpis.query_reporting_per_role(tables), roles=False),
        **{name: _raw(fn, *names) for name, (fn, names) in _RAW.items()},
        "reconcile_utilization": _reconcile(kpis.query_utilization, "raw_utilization", UTILIZATION),
        "reconcile_reporting": _reconcile(kpis.query_reporting, "raw_reporting", REPORTING),
        "reconcile_reporting_per_role": _reconcile(
            kpis.query_reporting_per_role, "raw_reporting_per_role", REPORTING, ["manufacturer", "year", "role"]
        ),
    }
    for name in schemas.DIMENSIONS:
        q[f"dim_{name}"] = _fitted(name)
    for name in schemas.FACTS:
        q[f"fact_{name}"] = _fitted(name)
        q[f"fact_{name}_norules"] = _fitted(name, rules=False)
    if training_data:
        q |= training_data.queries() | {"pipeline": corpus_pipeline.run}
    return q


def oracle_sql() -> dict[str, str]:
    found = oracle_queries.oracle_sql()
    if training_data:
        found |= training_data.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
