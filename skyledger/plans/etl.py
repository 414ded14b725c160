"""Extract, transform, load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import overlap, reports
from skyledger.plans import transform as tr
from skyledger.plans import violations
from skyledger.plans.catalog import WarehouseCatalog
from skyledger.plans.stage_counts import READ, STAGED, StageCounts
from skyledger.plans.warehouse import LoadResult, Warehouse, published, together
from skyledger.sources import SourceConfig, read_sources
from skyledger.sources.paths import Staging


@dataclass(frozen=True)
class EtlReport:
    rows_read: dict[str, int]
    loaded: list[LoadResult]
    broken_lines: int = 0  # of lookup files, if they are set aside

    @property
    def set_aside(self) -> dict[str, int]:
        """Rows that were not loaded, for each table that has any."""
        return {r.table: r.rejected for r in self.loaded if r.rejected}


def _rows_read(grains: tr.Grains) -> dict[str, int]:
    """Source rows, from the staged frames: exact even if tasks were retried."""
    total = lambda column: F.coalesce(F.sum(column), F.lit(0))
    events = grains.usage.agg(total("flights"), total("services")).first()
    reported = grains.report_counts.agg(total("reps")).first()
    return {"flights": int(events[0]), "maintenance": int(events[1]), "reports": int(reported[0])}


@dataclass(frozen=True)
class Slots:
    """The decided slots, and apart those that more than one event has."""

    decided: DataFrame
    shared: DataFrame


class Reduction:
    """Sources reduced to the frames that loads write from, each staged once.

    Loads of the same sources may share one: a load with the rules and one without share the counted
    reports. What is staged goes with ``close``.
    """

    def __init__(self, spark: SparkSession, sources: dict[str, DataFrame]):
        self.sources = sources
        self._staging = Staging(spark)
        self._lookup: DataFrame | None = None
        self._reports: tuple[StageCounts, DataFrame, DataFrame] | None = None
        self._events: dict[tuple[bool, bool], tuple[StageCounts, DataFrame, Slots | None]] = {}

    def _counted_reports(self) -> tuple[StageCounts, DataFrame, DataFrame]:
        counts, reported = StageCounts(), self.sources["reports"]
        read = counts.observe(reported, READ, "reports")
        stage = lambda df: self._staging(counts.observe(df, STAGED, "report_counts"), "report_counts")
        return counts, *together([
            lambda: stage(reports.count_reports_by_date(read)),
            lambda: self._staging(reports.other_classes(reported), "other_classes"),
        ])

    def _reduced_events(self, apply_business_rules: bool, slots: bool) -> tuple[StageCounts, DataFrame, Slots | None]:
        counts = StageCounts()
        read = {n: counts.observe(self.sources[n], READ, n) for n in ("flights", "maintenance")}
        label = f"{'ruled' if apply_business_rules else 'unruled'}{'_slots' if slots else ''}"

        def stage(df: DataFrame, name: str) -> DataFrame:
            return self._staging(counts.observe(df, STAGED, name), f"{name}_{label}")

        if not apply_business_rules:
            return counts, stage(tr.usage(read, False), "usage"), None
        if not slots:
            # Only the usage is asked for: it follows in the task that decides, so no slot is stored.
            decided = counts.observe(tr.decided_slots(read).drop("taken"), STAGED, "slots")
            return counts, stage(overlap.usage_by_day(decided), "usage"), None
        decided = stage(tr.decided_slots(read), "slots")
        usage, shared = together([
            lambda: stage(overlap.usage_by_day(decided), "usage"),
            lambda: self._staging(overlap.shared_slots(decided), f"shared_{label}"),
        ])
        return counts, usage, Slots(decided, shared)

    def of(self, apply_business_rules: bool, slots: bool) -> tuple[StageCounts, tr.Grains, Slots | None]:
        """The counted rows, the two grains and, with the rules, the ``slots`` where they are asked for."""
        slots, jobs = slots and apply_business_rules, []
        kind = (apply_business_rules, slots)
        if kind not in self._events:
            jobs.append(lambda: self._events.update({kind: self._reduced_events(*kind)}))
        if self._reports is None:
            jobs.append(lambda: setattr(self, "_reports", self._counted_reports()))
            jobs.append(lambda: setattr(self, "_lookup", self._staging(self.sources["aircrafts"], "aircrafts")))
        together(jobs)
        counted, usage, found = self._events[kind]
        of_reports, report_counts, others = self._reports
        return StageCounts.joined(counted, of_reports), tr.Grains(usage, report_counts, others), found

    @property
    def lookup(self) -> DataFrame:
        """The aircraft lookup, which several tables and logs meet; known after ``of``."""
        return self._lookup

    def close(self) -> None:
        self._staging.close()


def run_etl_on(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    location: str,
    apply_business_rules: bool = True,
    on_violation: str = "quarantine",
    log_violations: bool = True,
    database: str | None = None,
    reduction: Reduction | None = None,
) -> EtlReport:
    """Fills the warehouse at ``location`` from source relations, all tables at once at the end.

    The events are reduced to decided slots once, for the tables and for the table
    ``rule_violations``, which reads the events themselves once more where several share a slot; ``log_violations``
    leaves that table out. Lookup lines that were set aside become the table ``broken_lines``;
    ``stage_counts`` has the rows of each stage. If anything fails the warehouse stays as it was. ``database``: where
    the tables go by name; its names move once the load is committed. ``reduction``: these sources reduced, for loads
    that share it; its owner closes it.
    """
    reduced = reduction or Reduction(spark, sources)
    try:
        counts, grains, slots = reduced.of(apply_business_rules, log_violations)
        lookup, personnel = reduced.lookup, sources["personnel"]
        with published(spark, location, on_violation) as run:
            jobs = [
                lambda: run.load(tr.rows_to_load(grains, lookup, personnel), on_violation),
                lambda: _rows_read(grains),
            ]
            if apply_business_rules:
                summary = violations.rule_summary(grains.usage, grains.report_counts, lookup)
                jobs.append(lambda: run.write_log(summary, "rule_summary"))
            if log_violations:
                at_hand = (slots.decided, slots.shared) if slots else ()
                hits = violations.rule_violations(sources | {"aircrafts": lookup}, apply_business_rules, *at_hand)
                jobs.append(lambda: run.write_log(hits, "rule_violations"))
            if "broken_lines" in sources:
                jobs.append(lambda: run.write_log(sources["broken_lines"], "broken_lines"))
            loaded, rows_read, *_ = together(jobs)
            run.write_log(counts.table(spark, rows_read, loaded), "stage_counts")
            broken = run.log("broken_lines").count() if "broken_lines" in sources else 0
    finally:
        if reduction is None:
            reduced.close()
    if database:
        WarehouseCatalog(Warehouse(spark, location), database).sync()
    return EtlReport(rows_read, loaded, broken)


def run_etl(spark: SparkSession, config: SourceConfig, location: str, **options) -> EtlReport:
    return run_etl_on(spark, read_sources(spark, config), location, **options)
