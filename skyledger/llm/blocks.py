"""Rows in ascending id order, in blocks of consecutive ids that tasks handle apart."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands for a null id, which comes first.
LEAST = -(1 << 63)


def block_starts(df: DataFrame, key: str = "doc_id") -> list[int]:
    """The first id of each block: ids that occur, about as many as there are shuffle partitions.

    Only these are brought to the driver. Null ids make the first block start at ``LEAST``.
    """
    blocks = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ids = F.coalesce(F.col(key).cast("long"), F.lit(LEAST))
    shares = [i / blocks for i in range(1, blocks)]
    found = df.agg(
        F.min(ids).alias("first"),
        F.percentile_approx(ids, shares, max(10_000, 20 * blocks)).alias("others") if shares else F.lit(None).alias("others"),
    ).first()
    return [] if found["first"] is None else sorted({found["first"], *(found["others"] or [])})


#: Characters of a text by which rows of one id are told apart, and rows looked at for each block.
PREFIX, LOOKED_AT = 64, 100

Bound = tuple[int, str]


def bounds(df: DataFrame, key: str = "doc_id") -> list[Bound]:
    """Where blocks start: (id, beginning of the text), ids as in ``block_starts``.

    An id, or the lack of one, that holds more than a block's share of all rows is cut by the
    beginnings of its texts as well, which a bounded sample of its rows gives: at most
    ``LOOKED_AT`` for each block reach the driver, on average, of ``PREFIX`` characters.
    """
    starts = block_starts(df, key)
    blocks = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found: list[Bound] = [(s, "") for s in starts]
    if len(starts) >= blocks or not starts:
        return found
    ids = F.coalesce(F.col(key).cast("long"), F.lit(LEAST))
    counted = df.where(ids.isin(starts)).groupBy(ids.alias("id")).agg(F.count("*").alias("rows")).collect()  # a row for each block
    share = max(1.0, df.count() / blocks)
    heavy = {r["id"]: r["rows"] for r in counted if r["rows"] > share}
    if heavy:
        rate = min(1.0, LOOKED_AT * blocks / sum(heavy.values()))
        beginning = F.substring(F.coalesce("text", F.lit("")), 1, PREFIX)
        drawn = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1 << 30)) < int(rate * (1 << 30))
        sample = df.where(ids.isin(list(heavy)) & drawn).select(ids.alias("id"), beginning.alias("beginning")).collect()
        for i, rows in heavy.items():
            seen, cuts = sorted(r["beginning"] for r in sample if r["id"] == i), int(rows // share)
            found += [(i, seen[len(seen) * c // (cuts + 1)]) for c in range(1, cuts + 1) if seen]
    return sorted(set(found))


def in_blocks(df: DataFrame, starts: list[Bound], key: str = "doc_id", heads: bool = False) -> DataFrame:
    """The rows of ``key`` and text with their ``block``, one partition for each block, sorted by id within.

    Rows with the same id are in the order of their texts, in one block or in consecutive
    ones. With ``heads`` a block also holds, after its own rows and marked ``head``, the
    first row of the next block (the last block: that of the first).
    """
    starts = starts or [(LEAST, "")]
    first_ids = np.array([i for i, _ in starts], dtype=np.int64)
    several = {i for i in first_ids.tolist() if (first_ids == i).sum() > 1}

    @F.pandas_udf("int")
    def block_of(ids: pd.Series, beginnings: pd.Series) -> pd.Series:
        own = ids.to_numpy()
        block = np.maximum(np.searchsorted(first_ids, own, side="right") - 1, 0)
        if several:
            for at in np.flatnonzero(np.isin(own, list(several))).tolist():
                block[at] = max(0, bisect_right(starts, (int(own[at]), beginnings.iat[at])) - 1)
        return pd.Series(block)

    ids = F.coalesce(F.col(key).cast("long"), F.lit(LEAST))
    beginning = F.substring(F.coalesce("text", F.lit("")), 1, PREFIX)
    out = df.withColumn("order_id", ids).withColumn("block", block_of("order_id", beginning)).withColumn("head", F.lit(False))
    if heads:
        # A block starts with a row of an id that bounds it. One row is kept of each block.
        at_bounds = out.where(F.col("order_id").isin([int(i) for i in set(first_ids.tolist())]))
        first = at_bounds.groupBy("block").agg(F.min(F.struct("order_id", "text", key)).alias("row"))
        before = F.pmod(F.col("block") - 1, F.lit(len(starts))).cast("int")
        out = out.unionByName(first.select("row.*", before.alias("block"), F.lit(True).alias("head")))
    return out.repartitionById(len(starts), "block").sortWithinPartitions("block", "head", "order_id", "text")
