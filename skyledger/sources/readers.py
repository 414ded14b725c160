"""The five source relations as lazy DataFrames."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import schemas
from skyledger.sources.paths import first_existing

# The names the lookup files and source tables go by.
AIRCRAFT_FILES = ("aircraft-manufacturerinfo-lookup.csv", "aircraft-manufaturerinfo-lookup.csv")
PERSONNEL_FILE = "maintenance_personnel.csv"
FLIGHTS_TABLE = '"AIMS"."flights"'
MAINTENANCE_TABLE = '"AIMS"."maintenance"'
REPORTS_TABLE = '"AMOS"."postflightreports"'


@dataclass(frozen=True)
class TableSource:
    """Files of one relation, in any format Spark reads.

    Columns go by name, whatever their order and whatever else there is; a missing one is
    an error, and the row key is taken where there is one. CSV files have a header. JSON
    leaves out what is NULL, so there a missing column is NULL, and ``row_key`` has to say
    whether the rows have a key. A line that does not fit its header or its types fails the
    read: no row is read as something else.
    """

    path: str
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    row_key: bool = False

    def load(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        reader = spark.read.format(self.format)
        if self.format == "csv":
            reader = reader.options(header="true", mode="FAILFAST", enforceSchema="false", inferSchema="false")
        if self.format == "json":
            names = [*schema.fieldNames(), *[schemas.ROW_KEY][: self.row_key]]
            reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).options(mode="FAILFAST")
        return by_name(reader.options(**self.options).load(self.path), schema)


def by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the schema with its types, and the row key where there is one."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing} among {df.columns}")
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    if schemas.ROW_KEY in df.columns:
        columns.append(F.col(schemas.ROW_KEY).cast("long").alias(schemas.ROW_KEY))
    return df.select(*columns)


@dataclass(frozen=True, repr=False)
class JdbcSource:
    """One database table, read in parallel ranges of ``partition_column``.

    ``options`` holds the URL and credentials and is never printed. The ranges are
    conditions, not numbers, so that a time without a zone can be split: half-open ranges
    between the bounds, one below, one above, and one for NULL.
    """

    options: dict[str, str]
    table: str
    partition_column: str | None = None
    lower_bound: str | None = None
    upper_bound: str | None = None
    partitions: int = 1
    fetch_size: int = 10_000

    def properties(self) -> dict[str, str]:
        rest = {k: v for k, v in self.options.items() if k != "url"}
        return rest | {"preferTimestampNTZ": "true", "fetchsize": str(self.fetch_size)}

    def predicates(self) -> list[str] | None:
        """Conditions of which every row meets exactly one; None for a read in one piece."""
        if not self.partition_column:
            return None
        if self.lower_bound is None or self.upper_bound is None:
            raise ValueError(f"{self.table}: a partitioned read needs both bounds")
        low, high = (dt.datetime.fromisoformat(b) for b in (self.lower_bound, self.upper_bound))
        if not low < high or self.partitions < 1:
            raise ValueError(f"{self.table}: no range between {low} and {high}")
        step = (high - low) / self.partitions
        edges = [low + i * step for i in range(self.partitions)] + [high]
        column, at = self.partition_column, [f"TIMESTAMP '{e.isoformat(sep=' ', timespec='microseconds')}'" for e in edges]
        inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(at[:-1], at[1:])]
        return [f"{column} < {at[0]}", *inner, f"{column} >= {at[-1]}", f"{column} IS NULL"]

    def load(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        predicates = self.predicates()
        split = {} if predicates is None else {"predicates": predicates}
        return spark.read.jdbc(self.options["url"], self.table, properties=self.properties(), **split)


def jdbc_sources(options: dict[str, str], lower_bound: str, upper_bound: str, partitions: int) -> dict[str, JdbcSource]:
    """The three database relations, split on their event time."""

    def source(table: str, column: str) -> JdbcSource:
        return JdbcSource(options, table, column, lower_bound, upper_bound, partitions)

    return {
        "flights": source(FLIGHTS_TABLE, "scheduleddeparture"),
        "maintenance": source(MAINTENANCE_TABLE, "scheduleddeparture"),
        "reports": source(REPORTS_TABLE, "reportingdate"),
    }


@dataclass(frozen=True)
class SourceConfig:
    flights: TableSource | JdbcSource
    maintenance: TableSource | JdbcSource
    reports: TableSource | JdbcSource
    lookup_folder: str  # holds the aircraft and the personnel file
    #: Lines of the lookup files that are none: ``fail`` the read, or ``set_aside`` under their own name.
    broken_lines: str = "fail"


@dataclass(frozen=True)
class LookupLines:
    """A lookup file: its ``rows``, and the lines that are ``broken`` (file, line, reason)."""

    rows: DataFrame
    broken: DataFrame


UNCLOSED, MISCOUNTED = "unclosed quote", "number of values"


def _lookup_lines(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """The columns under their new names, with the ``line`` they are from and the ``reason`` if it is broken.

    A line is broken if a quote in it is not closed (quotes within quotes are doubled) or if it has
    more or fewer values than the header.
    """
    header = spark.read.options(header="true", inferSchema="false", escape='"').csv(path).columns
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"missing columns {missing} among {header} in {path}")
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(header))]
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    schema = T.StructType([*fields, T.StructField("broken", T.StringType())]).simpleString()[7:-1].replace(":", " ")
    parsed = F.from_csv("value", schema, options).alias("parsed")
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0).select(F.col("value").alias("line"), parsed)
    value = {name: F.col(f"parsed.c{i}") for i, name in enumerate(header)}
    names = F.lit(True)
    for i, name in enumerate(header):
        names = names & F.col(f"parsed.c{i}").eqNullSafe(F.lit(name))
    reason = F.when(F.regexp_count("line", F.lit('"')) % 2 == 1, UNCLOSED).when(F.col("parsed.broken").isNotNull(), MISCOUNTED)
    chosen = [F.coalesce(value[source], F.lit("")).alias(name) for source, name in columns.items()]
    # Each file of a folder begins with the header.
    return lines.where(~names).select(*chosen, "line", reason.alias("reason"))


def read_lookup_lines(spark: SparkSession, path: str, columns: dict[str, str]) -> LookupLines:
    """A lookup file: columns by header name, all text, blanks kept as ''; broken lines apart."""
    found = _lookup_lines(spark, path, columns)
    name = F.lit(path.rsplit("/", 1)[-1]).alias("file")
    broken = found.where("reason is not null").select(name, "line", "reason")
    return LookupLines(found.where("reason is null").select(*columns.values()), broken)


def read_lookup_csv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """The rows of a lookup file; a broken line fails the read."""
    found = _lookup_lines(spark, path, columns)
    failure = F.raise_error(F.concat(F.lit("malformed line, "), F.col("reason"), F.lit(": "), F.col("line")))
    sound = F.when(F.col("reason").isNull(), True).otherwise(failure.cast("boolean"))
    return found.where(sound).select(*columns.values())


AIRCRAFT_COLUMNS = {"aircraft_reg_code": "registration", "aircraft_model": "model", "aircraft_manufacturer": "manufacturer"}
PERSONNEL_COLUMNS = {"reporteurid": "reporteurid", "airport": "airport"}


def read_aircrafts(spark: SparkSession, folder: str) -> DataFrame:
    return read_lookup_csv(spark, first_existing(spark, folder, AIRCRAFT_FILES), AIRCRAFT_COLUMNS)


def read_personnel(spark: SparkSession, folder: str) -> DataFrame:
    return read_lookup_csv(spark, first_existing(spark, folder, (PERSONNEL_FILE,)), PERSONNEL_COLUMNS)


def project(df: DataFrame, schema: T.StructType, keep_key: bool = False) -> DataFrame:
    """The used columns only, times as wall-clock times, plus the row key where
    there is one."""
    columns = [
        F.col(f.name).cast(f.dataType).alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
        for f in schema.fields
    ]
    if keep_key and schemas.ROW_KEY in df.columns:
        columns.append(F.col(schemas.ROW_KEY))
    return df.select(*columns)


def read_sources(spark: SparkSession, config: SourceConfig) -> dict[str, DataFrame]:
    """The five relations by name; with ``set_aside`` also ``broken_lines`` of the lookup files."""
    found = {
        "flights": project(config.flights.load(spark, schemas.FLIGHTS), schemas.FLIGHTS, keep_key=True),
        "maintenance": project(config.maintenance.load(spark, schemas.MAINTENANCE), schemas.MAINTENANCE, keep_key=True),
        "reports": project(config.reports.load(spark, schemas.REPORTS), schemas.REPORTS),
    }
    folder = config.lookup_folder
    if config.broken_lines == "fail":
        return found | {"aircrafts": read_aircrafts(spark, folder), "personnel": read_personnel(spark, folder)}
    if config.broken_lines != "set_aside":
        raise ValueError(f"broken_lines: {config.broken_lines!r}")
    aircrafts = read_lookup_lines(spark, first_existing(spark, folder, AIRCRAFT_FILES), AIRCRAFT_COLUMNS)
    personnel = read_lookup_lines(spark, first_existing(spark, folder, (PERSONNEL_FILE,)), PERSONNEL_COLUMNS)
    broken = aircrafts.broken.unionByName(personnel.broken)
    return found | {"aircrafts": aircrafts.rows, "personnel": personnel.rows, "broken_lines": broken}
