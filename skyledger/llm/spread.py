"""Joins whose hot keys are known beforehand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_counted(rows: DataFrame, table: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """``rows`` with their row of ``table``, which has one row for each ``key`` and in ``count`` how many rows meet it.

    ``how``: ``left`` keeps rows that meet none.

    Keys that more than one in the shuffle partitions of all counted rows meet are fewer than
    these partitions: they are broadcast, so that no task gets all rows of one. All others
    meet by shuffle. Both frames are read twice, so they should be stored; null keys meet nothing.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    total = table.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    is_hot = F.col(count) * parts > total
    hot = F.broadcast(table.where(is_hot))
    of_hot = rows.join(hot, key)
    others = rows.join(F.broadcast(table.where(is_hot).select(key)), key, "left_anti")
    return of_hot.unionByName(others.join(table.where(~is_hot), key, how))
