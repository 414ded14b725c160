"""Rows per stage of a load, counted on the way.

Frames are observed where they are read or staged, so counting costs no pass of its own, and the
counts are read after the writes they belong to. What Spark repeats: a task that writes
counts once, however often it is tried, so counts of staged and written rows are exact. A task
that reads a source before a shuffle counts again if its executor is lost after it ended.
Counts of sources are therefore taken twice: ``observed``, and ``rows`` from the staged rows, which
carry how many source rows they stand for; ``observed`` beyond ``rows`` is work done twice.
"""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.plans.warehouse import LoadResult

SCHEMA = "stage string, name string, rows long, observed long"

READ, STAGED, WRITTEN, SET_ASIDE = "read", "staged", "written", "set_aside"


class StageCounts:
    def __init__(self) -> None:
        self._observed: dict[tuple[str, str], Observation] = {}

    @classmethod
    def joined(cls, *parts: StageCounts) -> StageCounts:
        """The counts of frames that were counted apart."""
        out = cls()
        for part in parts:
            out._observed |= part._observed
        return out

    def observe(self, df: DataFrame, stage: str, name: str) -> DataFrame:
        """The same rows, which are counted when they are next computed."""
        counting = self._observed[stage, name] = Observation()
        return df.observe(counting, F.count(F.lit(1)).alias("rows"))

    def observed(self, stage: str, name: str) -> int | None:
        """Waits for the frame to be computed. None where adaptive execution dropped the counting with a stage that
        it found empty."""
        try:
            return self._observed[stage, name].get["rows"]
        except Py4JJavaError:
            return None

    def table(self, spark: SparkSession, rows_read: dict[str, int], loaded: Iterable[LoadResult]) -> DataFrame:
        """stage, name, rows, observed: after all writes."""
        out = []
        for stage, name in self._observed:
            seen = self.observed(stage, name)
            out.append((stage, name, rows_read[name] if stage == READ else seen or 0, seen))
        for result in loaded:
            out += [(WRITTEN, result.table, result.written, result.written), (SET_ASIDE, result.table, result.rejected, result.rejected)]
        return spark.createDataFrame(out, SCHEMA).coalesce(1)
