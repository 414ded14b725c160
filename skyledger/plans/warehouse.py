"""The stored star schema: create, load with key checks, publish, open, empty.

A warehouse is a folder of runs. A run is a folder of parquet tables with the declared
schemas, facts in a folder for each year; it counts from the moment a commit names it
(``commits.py``), and a warehouse is opened at the last commit. A load that fails leaves the
tables as they were, and loads at the same time do not touch each other's runs. Logs lie beside
the runs, in a folder for each, and stay when a run goes. Rows that do not fit a declared type, lose against another row with their
primary key or miss a dimension row are kept apart in ``<table>_rejects`` with the reason,
and counted. Nothing is dropped, and a load never claims more than it wrote.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.plans import commits
from skyledger.plans.commits import Commit, CommitLog, Retention
from skyledger.schemas import DIMENSIONS, FACTS, PARTITION, TABLES, Table
from skyledger.sources.paths import children, delete, exists, write_text

R = TypeVar("R")

REASONS = "reasons"
AS_GIVEN = "as_given"  # the row before it was made to fit


REJECTS = T.StructType(
    [T.StructField("row", T.StringType()), T.StructField(REASONS, T.ArrayType(T.StringType()))]
)


class ConstraintViolation(ValueError):
    """Rows break a key or type constraint and the load was told to fail."""


@dataclass(frozen=True)
class LoadResult:
    table: str
    written: int
    rejected: int


def primary_key_summary(df: DataFrame, table: Table) -> DataFrame:
    """Rows, distinct keys, keys held more than once and rows without a key."""
    key = F.col(table.primary_key)
    return (
        df.groupBy(key.alias("key"))
        .agg(F.count("*").alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("row_count"),
            F.count("key").alias("key_count"),
            F.count_if(F.col("key").isNotNull() & (F.col("copies") > 1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("copies"))), F.lit(0)).cast("long").alias("null_keys"),
        )
        .select(F.lit(table.name).alias("table_name"), "*")
    )


def orphans(fact: DataFrame, dimension: DataFrame, column: str, key: str) -> DataFrame:
    """Rows whose ``column`` is set and absent from the dimension."""
    keys = dimension.select(F.col(key).alias("_key"))
    return fact.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_key"), "left_anti")


@dataclass(frozen=True)
class Checked:
    """Rows of one table with ``reasons``; ``broken`` is set up apart, as it is
    needed only if ``suspect`` holds for a row."""

    rows: DataFrame
    broken: DataFrame
    suspect: Column


def _fitted(df: DataFrame, table: Table, keep: Sequence[str] = ()) -> DataFrame:
    """Columns with declared types; values that do not fit become a reason.

    Reasons are gathered only for a row that has one: that is interpreted, and nearly all rows have none.
    """
    fields = table.schema.fields
    fitted = {f.name: f"try_cast({f.name} as {f.dataType.simpleString()})" for f in fields}
    misfits = {
        f.name: f"({f.name} is not null and {fitted[f.name]} is null)" for f in fields if not isinstance(f.dataType, T.StringType)
    }
    found = ", ".join(f"if({misfit}, 'out_of_range:{name}', null)" for name, misfit in misfits.items())
    none = "cast(array() as array<string>)"
    reasons = f"if({' or '.join(misfits.values()) or 'false'}, cast(array_compact(array({found})) as array<string>), {none})"
    return df.selectExpr(
        *[f"{value} as {name}" for name, value in fitted.items()],
        *keep,
        f"{reasons} as {REASONS}",
        f"struct({', '.join(table.columns)}) as {AS_GIVEN}",
    )


def _add_reason(condition: str, reason: str) -> Column:
    return F.expr(f"if({condition}, array_append({REASONS}, '{reason}'), {REASONS})")


def _broken(rows: DataFrame) -> DataFrame:
    return rows.where(F.size(REASONS) > 0).select(F.to_json(AS_GIVEN).alias("row"), REASONS)


def unique(df: DataFrame, key: str) -> DataFrame:
    """One row for each key, the one with the greatest content; none for a missing key."""
    rest = [c for c in df.columns if c != key]
    kept = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*rest)).alias("_kept"))
    return kept.select(*[F.col(c) if c == key else F.col(f"_kept.{c}") for c in df.columns])


def set_aside(df: DataFrame, table: Table) -> DataFrame:
    """Different rows of a dimension that another row with their key replaces, or that have no key, with ``reason``."""
    key = table.primary_key
    rows = df.select(*table.columns).dropDuplicates()
    kept = unique(df.select(*table.columns), key)
    alike = [F.col(f"_row.{c}").eqNullSafe(F.col(f"_kept.{c}")) for c in table.columns]
    beaten = rows.alias("_row").join(kept.alias("_kept"), alike, "left_anti")
    reason = F.when(F.col(key).isNull(), f"null_key:{key}").otherwise(f"duplicate_key:{key}")
    return beaten.select(*table.columns, reason.alias("reason"))


def check_dimension(df: DataFrame, table: Table) -> Checked:
    """Of rows that share a key the one with the greatest content stays, so that facts keep
    their dimension row; the others are set aside. Rows alike count once.

    One combined aggregate finds the rows to write, and whether any are to be set aside.
    """
    key = table.primary_key
    row = F.struct(*table.columns)
    per_key = df.groupBy(F.col(key).alias("_key")).agg(F.min(row).alias("_least"), F.max(row).alias("_greatest"))
    rival = (F.col("_least") != F.col("_greatest")).alias("_rival")
    rows = _fitted(per_key.select("_greatest.*", rival), table, keep=["_rival"])
    rows = rows.withColumn(REASONS, _add_reason(f"{key} is null", f"null_key:{key}"))
    beaten = set_aside(df, table)
    misfits = _broken(_fitted(unique(df.select(*table.columns), key), table))
    broken = misfits.unionByName(beaten.select(F.to_json(F.struct(*table.columns)).alias("row"), F.array("reason").alias(REASONS)))
    return Checked(rows, broken, F.col("_rival") | (F.size(REASONS) > 0))


def check_fact(df: DataFrame, table: Table, dimensions: dict[str, DataFrame]) -> Checked:
    """Marks rows that miss a dimension row. A NULL reference passes.

    The rows get the year of the calendar row that dates them; calendar dimensions carry it.
    """
    checked = _fitted(df.select(*table.columns), table)
    for column, dimension in table.foreign_keys.items():
        year = [PARTITION] if column == table.dated_by else []
        known = dimensions[dimension].select(F.col(TABLES[dimension].primary_key).alias("_key"), *year)
        checked = (
            checked.join(known, F.col(column) == F.col("_key"), "left")
            .withColumn(REASONS, _add_reason(f"{column} is not null and _key is null", f"orphan:{column}"))
            .drop("_key")
        )
    return Checked(checked, _broken(checked), F.size(REASONS) > 0)


def together(jobs: Iterable[Callable[[], R]]) -> list[R]:
    """Runs independent Spark jobs side by side, so that small ones need not
    wait for each other."""
    jobs = list(jobs)
    with ThreadPoolExecutor(max_workers=max(len(jobs), 1)) as pool:
        return list(pool.map(lambda job: job(), jobs))


#: Rows of a file of a fact, at most.
FILE_ROWS = 10_000_000


def read_stored(spark: SparkSession, path: str, table: Table, partitions: bool) -> DataFrame:
    stored = spark.read.schema(table.stored_schema).parquet(path)
    return stored if partitions else stored.select(*table.columns)


class Run:
    """The tables of one load, not part of the warehouse before ``publish``.

    ``began_with`` is the last commit at its beginning, 0 if there was none.
    """

    def __init__(self, spark: SparkSession, warehouse: str, name: str):
        self.spark = spark
        self.warehouse = warehouse.rstrip("/")
        self.name = name
        self.location = f"{self.warehouse}/runs/{name}"
        self.commits = CommitLog(spark, warehouse)
        self.began_with = max(self.commits.numbers(), default=0)
        write_text(spark, f"{self.location}/_BEGUN", "")

    def _path(self, name: str) -> str:
        return f"{self.location}/{name}"

    def _write(self, df: DataFrame, name: str, table: Table | None = None) -> None:
        """Facts by year: each file holds rows of one year and has a bounded length."""
        if table and table.dated_by:
            df.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(PARTITION).parquet(self._path(name))
        else:
            df.write.parquet(self._path(name))

    def write_log(self, df: DataFrame, name: str) -> None:
        """A table beside the star schema, such as the rule hits. It outlives the run if the run is published."""
        df.write.parquet(log_path(self.warehouse, name, self.name))

    def log(self, name: str) -> DataFrame:
        return self.spark.read.parquet(log_path(self.warehouse, name, self.name))

    def write_empty(self) -> None:
        none = lambda t: self.spark.createDataFrame([], t.stored_schema).coalesce(1)
        together(lambda t=table: self._write(none(t), t.name, t) for table in TABLES.values())

    def _store(self, table: Table, checked: Checked, on_violation: str) -> LoadResult:
        if on_violation == "fail":
            example = checked.broken.limit(1).collect()
            if example:
                raise ConstraintViolation(f"{table.name}: {example[0][REASONS]} in {example[0]['row']}")
        observed = Observation()
        sound = F.size(REASONS) == 0
        # Rows of a year come together, so that a year is a few files however many tasks there are; a
        # long one is split. Counting is above that: a stage found empty would take its counts with it.
        rows = checked.rows.hint("rebalance", PARTITION) if table.dated_by else checked.rows
        counted = rows.observe(
            observed, F.count_if(sound).alias("written"), F.count_if(checked.suspect).alias("suspect")
        )
        self._write(counted.where(sound).select(*table.stored_schema.fieldNames()), table.name, table)
        counts = observed.get
        if not counts["suspect"]:
            return LoadResult(table.name, counts["written"], 0)
        lost = Observation()
        self._write(checked.broken.observe(lost, F.count("*").alias("rows")), f"{table.name}_rejects")
        return LoadResult(table.name, counts["written"], lost.get["rows"])

    def load(self, frames: dict[str, DataFrame], on_violation: str = "quarantine") -> list[LoadResult]:
        """Writes all seven tables: the dimensions, then the facts."""

        def load_dimension(name: str) -> LoadResult:
            return self._store(TABLES[name], check_dimension(frames[name], TABLES[name]), on_violation)

        def stored(name: str) -> DataFrame:
            found = read_stored(self.spark, self._path(name), TABLES[name], False)
            if name == "days":
                found = found.join(stored("months").select("month_id", PARTITION), "month_id", "left")
            return found

        def load_fact(name: str) -> LoadResult:
            known = {d: stored(d) for d in TABLES[name].foreign_keys.values()}
            return self._store(TABLES[name], check_fact(frames[name], TABLES[name], known), on_violation)

        dimensions = together(lambda n=name: load_dimension(n) for name in DIMENSIONS)
        return dimensions + together(lambda n=name: load_fact(n) for name in FACTS)

    def publish(self, kind: str = "load", alone: bool = False) -> Commit:
        """Makes the run count. With ``alone`` only if no other was committed since it began."""
        missing = [t for t in TABLES if not exists(self.spark, f"{self._path(t)}/_SUCCESS")]
        if missing:
            raise FileNotFoundError(f"the run {self.name} lacks {missing}")
        return self.commits.add(self.name, kind, self.began_with if alone else None)

    def discard(self) -> None:
        discard(self.spark, self.warehouse, self.name)


def log_path(warehouse: str, log: str, run: str) -> str:
    return f"{warehouse}/logs/{log}/run={run}"


def discard(spark: SparkSession, warehouse: str, run: str, logs: bool = True) -> None:
    """Removes a run; with ``logs`` also what it logged."""
    delete(spark, f"{warehouse}/runs/{run}")
    for log in children(spark, f"{warehouse}/logs") if logs else []:
        delete(spark, log_path(warehouse, log, run))


class Warehouse:
    """``create=True`` starts a warehouse, empty, where there is none yet; ``restart``
    empties one that is there. Otherwise an existing warehouse is opened.

    Tables are those of the last commit at the time of a call, or of the commit given as ``at``.
    """

    def __init__(self, spark: SparkSession, location: str, create: bool = False):
        self.spark = spark
        self.location = location.rstrip("/")
        self.commits = CommitLog(spark, self.location)
        if not self.commits.numbers():
            if not create:
                raise FileNotFoundError(f"no warehouse at {self.location}")
            self.restart()

    def run_path(self, at: int | None = None) -> str:
        commit = self.commits.last() if at is None else self.commits.read(at)
        return f"{self.location}/runs/{commit.run}"

    def _path(self, name: str) -> str:
        return f"{self.run_path()}/{name}"

    def history(self) -> list[Commit]:
        """All commits, also those whose runs are gone."""
        return self.commits.all()

    def available(self) -> list[Commit]:
        """Commits whose tables can be read."""
        return commits.available(self.commits, f"{self.location}/runs")

    def restart(self) -> None:
        """Empties all tables."""
        with published(self.spark, self.location, kind="restart") as run:
            run.write_empty()

    def table(self, name: str, at: int | None = None) -> DataFrame | None:
        """A stored table, or None for a name that is none."""
        if name not in TABLES:
            return None
        return read_stored(self.spark, f"{self.run_path(at)}/{name}", TABLES[name], False)

    def tables(self, at: int | None = None, partitions: bool = False) -> dict[str, DataFrame]:
        """With ``partitions`` facts have the year that they are stored by, so that conditions on it leave out files."""
        run = self.run_path(at)
        return {name: read_stored(self.spark, f"{run}/{name}", t, partitions) for name, t in TABLES.items()}

    def rejects(self, name: str) -> DataFrame:
        """Rows of the last load that were set aside: the row as JSON, and why."""
        path = self._path(f"{name}_rejects")
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], REJECTS)
        return self.spark.read.schema(REJECTS).parquet(path)

    def log(self, name: str) -> DataFrame:
        """A table beside the star schema, of the last commit."""
        return self.spark.read.parquet(log_path(self.location, name, self.commits.last().run))

    def log_history(self, name: str) -> DataFrame | None:
        """What all loads logged, also those whose tables are gone, with the ``commit`` of each; None if none did.

        Only folders of committed runs are read, so a load that was broken off leaves no hits.
        """
        root = f"{self.location}/logs/{name}"
        logged = set(children(self.spark, root))
        of_run = {f"run={c.run}": c for c in self.commits.all() if f"run={c.run}" in logged}
        if not of_run:
            return None
        paths = [f"{root}/{folder}" for folder in of_run]
        rows = self.spark.read.option("basePath", root).parquet(*paths)
        numbers = [(c.run, c.number) for c in of_run.values()]
        known = self.spark.createDataFrame(numbers, "run string, commit int")
        return rows.join(known, "run").drop("run")

    def load(self, frames: dict[str, DataFrame], on_violation: str = "quarantine") -> list[LoadResult]:
        """Replaces all seven tables at once.

        ``quarantine`` writes the sound rows and sets the others aside; ``fail`` raises on a
        violation in any table, and nothing is replaced.
        """
        with published(self.spark, self.location, on_violation) as run:
            return run.load(frames, on_violation)

    def clean(self, retention: Retention = Retention(), now: int | None = None) -> list[str]:
        """Removes runs that ``retention`` does not keep; returns their names. Logs of committed runs stay."""
        now = commits.file_system_now(self.spark, self.location) if now is None else now
        committed = {c.run for c in self.history()}
        gone = commits.removable(self.commits, f"{self.location}/runs", retention, now)
        for run in gone:
            discard(self.spark, self.location, run, logs=run not in committed)
        return gone


def begin(spark: SparkSession, location: str) -> Run:
    return Run(spark, location, f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")


@contextmanager
def published(
    spark: SparkSession,
    location: str,
    on_violation: str = "quarantine",
    kind: str = "load",
    alone: bool = False,
    retention: Retention | None = Retention(),
) -> Iterator[Run]:
    """A run that counts if the block ends well and is removed if it does not.

    A clean-up by ``retention`` follows; None leaves everything. ``alone``: fail with
    ``Superseded`` if another load was committed meanwhile; else the last to be committed is seen.
    """
    if on_violation not in ("quarantine", "fail"):
        raise ValueError(f"on_violation: {on_violation!r}")
    run = begin(spark, location)
    try:
        yield run
        run.publish(kind, alone)
    except BaseException:
        run.discard()
        raise
    if retention:
        Warehouse(spark, location).clean(retention)
