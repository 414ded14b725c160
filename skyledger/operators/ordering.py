"""Positions of a whole sorted frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PART_BITS = 33  # of a number by monotonically_increasing_id, below the partition


def with_position(
    df: DataFrame, keys: Sequence[Column], stage: Callable[[DataFrame, str], DataFrame], name: str = "position"
) -> DataFrame:
    """Adds the place of each row, from 1, in the order of ``keys``; ties go by all columns, equal rows in any order.

    Rows are dealt by ranges of the order and sorted within, so no task holds more than its range,
    and rows that share a key are spread as far as they differ. A row's position is its number within its range
    plus the rows of all ranges before. ``stage`` stores the sorted rows, so that ranges do not
    change between counting and numbering. The counts, one for each range, pass through the driver.
    """
    spark = df.sparkSession
    order = [*keys, *[F.col(f"`{c}`").asc_nulls_first() for c in df.columns]]
    at = F.monotonically_increasing_id()
    ranged = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at), "ordered")
    part = F.shiftright("_at", _PART_BITS).alias("_part")
    counts = sorted(map(tuple, ranged.groupBy(part).count().collect()))
    before = accumulate((n for _, n in counts), initial=0)
    bases = spark.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "_part long, _base long")
    within = F.col("_at") - F.shiftleft("_part", _PART_BITS) + 1
    # As many rows as there are ranges.
    placed = ranged.withColumn("_part", part).join(F.broadcast(bases), "_part")
    return placed.withColumn(name, F.col("_base") + within).drop("_at", "_part", "_base")
