"""Warehouse tables by name: ``spark.table("fleet.daily_usage")``, ``spark.sql``, ``tableExists``.

For each commit there are seven tables of its own, ``<table>_c<number>``, over the files of its
run, and ``<table>`` is a view of that of the last commit. Moving a view is one act of the
catalog, so a name is always there; it has the declared columns, and a fact the year that its
files are stored by, so that conditions on the year read only the files of those years. Seven
views move one after the other: a query over several tables that has to see one load, even
while another is committed, takes the names with the number, which ``names`` gives.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from skyledger.plans.commits import available
from skyledger.plans.warehouse import Warehouse
from skyledger.schemas import PARTITION, TABLES, Table
from skyledger.sources.paths import qualified

_NUMBERED = re.compile(rf"({'|'.join(TABLES)})_c(\d+)")


class WarehouseCatalog:
    """The tables of a warehouse in a database of the session's catalog."""

    def __init__(self, warehouse: Warehouse, database: str):
        self.warehouse = warehouse
        self.spark: SparkSession = warehouse.spark
        self.database = database  # letters, digits and underscores, as for any table

    def names(self, commit: int) -> dict[str, str]:
        """Full names of the tables of one commit."""
        return {t: f"{self.database}.{t}_c{commit}" for t in TABLES}

    def _place(self, path: str) -> str:
        return "'" + qualified(self.spark, path).replace("'", "\\'") + "'"

    def _create(self, table: Table, commit: int, path: str) -> None:
        name = self.names(commit)[table.name]
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.stored_schema.fields)
        parted = f"PARTITIONED BY ({PARTITION})" if table.dated_by else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parted} LOCATION {self._place(path)}")
        # Without this setting partitions are found in the folder, else they are those the catalog knows.
        if table.dated_by and self.spark.conf.get("spark.sql.hive.manageFilesourcePartitions", "true") == "true":
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")

    def sync(self) -> int:
        """Moves the names to the last commit and forgets commits whose runs are gone; returns the last commit.

        Whoever is late moves the names to what is last then, never back. Repeating it does no harm.
        """
        beside = self._place(f"{self.warehouse.location}/catalog")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION {beside}")
        done = None
        while (last := self.warehouse.commits.last()).number != done:
            run = self.warehouse.run_path(last.number)
            for table in TABLES.values():
                self._create(table, last.number, f"{run}/{table.name}")
            for t, name in self.names(last.number).items():
                self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{t} AS SELECT * FROM {name}")
            done = last.number
        self._forget({c.number for c in available(self.warehouse.commits, f"{self.warehouse.location}/runs")})
        return done

    def _forget(self, kept: set[int]) -> None:
        """Drops the entries of other commits; the files are not theirs and stay."""
        for t in self.spark.catalog.listTables(self.database):
            found = _NUMBERED.fullmatch(t.name)
            if found and int(found.group(2)) not in kept:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.database}.{t.name}")

    def tables(self, commit: int | None = None) -> dict[str, DataFrame]:
        """By name, of the last commit or the one given."""
        names = self.names(commit) if commit else {t: f"{self.database}.{t}" for t in TABLES}
        return {t: self.spark.table(name) for t, name in names.items()}
