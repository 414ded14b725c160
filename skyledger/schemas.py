"""Declared schemas: source relations, warehouse tables, keys.

Timestamps are TIMESTAMP_NTZ everywhere: an hour of day or a difference of two
times must never depend on the session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _struct(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


_S, _I, _B = T.StringType(), T.IntegerType(), T.BooleanType()
_NTZ, _DEC = T.TimestampNTZType(), T.DecimalType(10, 2)

FLIGHTS = _struct(
    ("aircraftregistration", _S, True),
    ("scheduleddeparture", _NTZ, True),
    ("scheduledarrival", _NTZ, True),
    ("actualdeparture", _NTZ, True),
    ("actualarrival", _NTZ, True),
    ("cancelled", _B, True),
)
MAINTENANCE = _struct(
    ("aircraftregistration", _S, True),
    ("scheduleddeparture", _NTZ, True),
    ("scheduledarrival", _NTZ, True),
    ("programmed", _B, True),
)
REPORTS = _struct(
    ("aircraftregistration", _S, True),
    ("reportingdate", _NTZ, True),
    ("reporteurid", T.LongType(), True),
    ("reporteurclass", _S, True),
)

# Optional unique row key of flights and maintenance. It breaks ties between
# events with the same start; without it ties are broken by the rows' content.
ROW_KEY = "row_key"


@dataclass(frozen=True)
class Table:
    """One warehouse table: columns in order, primary key, foreign keys.

    A fact is stored by the year of the calendar row that its column ``dated_by`` refers to.
    """

    name: str
    schema: T.StructType
    primary_key: str | None = None
    foreign_keys: dict[str, str] = field(default_factory=dict)  # column -> dimension
    dated_by: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def stored_schema(self) -> T.StructType:
        """The declared columns, and that of the partitions where there are any."""
        return T.StructType([*self.schema.fields, *[T.StructField(PARTITION, _I)] * bool(self.dated_by)])


#: The column by whose values facts are partitioned.
PARTITION = "year"

_TABLES = (
    Table("days", _struct(("day_id", _S, False), ("day", _I, True), ("month_id", _S, True)), "day_id"),
    Table("months", _struct(("month_id", _S, False), ("month", _I, True), ("year", _I, True)), "month_id"),
    Table(
        "aircrafts",
        _struct(("registration", _S, False), ("model", _S, True), ("manufacturer", _S, True)),
        "registration",
    ),
    Table(
        "reporteurs",
        _struct(("reporteur_uid", _S, False), ("airport", _S, True), ("role", _S, True)),
        "reporteur_uid",
    ),
    Table(
        "daily_usage",
        _struct(
            ("registration", _S, True), ("day_id", _S, True), ("fh", _DEC, True), ("tos", _I, True), ("sto", _I, True)
        ),
        foreign_keys={"registration": "aircrafts", "day_id": "days"},
        dated_by="day_id",
    ),
    Table(
        "monthly_usage",
        _struct(
            ("registration", _S, True),
            ("month_id", _S, True),
            ("dy", _I, True),
            ("cn", _I, True),
            ("dh", _DEC, True),
            ("ados", _DEC, True),
            ("adoss", _DEC, True),
            ("adosu", _DEC, True),
            ("adis", _DEC, True),
        ),
        foreign_keys={"registration": "aircrafts", "month_id": "months"},
        dated_by="month_id",
    ),
    Table(
        "reportage_usage",
        _struct(
            ("registration", _S, True),
            ("month_id", _S, True),
            ("reporteur_uid", _S, True),
            ("reps", _I, True),
            ("mareps", _I, True),
            ("pireps", _I, True),
        ),
        foreign_keys={"registration": "aircrafts", "month_id": "months", "reporteur_uid": "reporteurs"},
        dated_by="month_id",
    ),
)

# Load order: dimensions before the facts that refer to them.
TABLES: dict[str, Table] = {t.name: t for t in _TABLES}
DIMENSIONS = tuple(t.name for t in _TABLES if t.primary_key)
FACTS = tuple(t.name for t in _TABLES if not t.primary_key)
