import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("skyledger-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        # A zone with daylight saving: wall-clock results must not notice it.
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("managed")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


FLIGHT_COLUMNS = (
    "aircraftregistration string, scheduleddeparture timestamp_ntz, scheduledarrival timestamp_ntz, "
    "actualdeparture timestamp_ntz, actualarrival timestamp_ntz, cancelled boolean"
)
MAINTENANCE_COLUMNS = (
    "aircraftregistration string, scheduleddeparture timestamp_ntz, scheduledarrival timestamp_ntz, programmed boolean"
)
REPORT_COLUMNS = "aircraftregistration string, reportingdate timestamp_ntz, reporteurid bigint, reporteurclass string"


@pytest.fixture(scope="session")
def make(spark):
    """Builds source relations from short tuples with times as text."""

    class Make:
        def flights(self, rows, keyed=True):
            """(registration, scheduled departure, scheduled arrival, actual departure, actual arrival, cancelled)"""
            data = [(r[0], *map(at, r[1:5]), r[5], *([i] if keyed else [])) for i, r in enumerate(rows)]
            return spark.createDataFrame(data, FLIGHT_COLUMNS + (", row_key bigint" if keyed else ""))

        def maintenance(self, rows, keyed=True):
            """(registration, scheduled departure, scheduled arrival, programmed)"""
            data = [(r[0], at(r[1]), at(r[2]), r[3], *([i] if keyed else [])) for i, r in enumerate(rows)]
            return spark.createDataFrame(data, MAINTENANCE_COLUMNS + (", row_key bigint" if keyed else ""))

        def reports(self, rows):
            """(registration, date, reporter id, class)"""
            return spark.createDataFrame([(r[0], at(r[1]), r[2], r[3]) for r in rows], REPORT_COLUMNS)

        def aircrafts(self, rows):
            return spark.createDataFrame(rows, "registration string, model string, manufacturer string")

        def personnel(self, rows):
            return spark.createDataFrame(rows, "reporteurid string, airport string")

    return Make()


def as_dicts(df):
    return [row.asDict(recursive=True) for row in df.collect()]
