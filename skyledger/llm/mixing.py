"""Mixes sources to target weights by cube-method balanced sampling.

A source's target over its size is how often each of its documents is taken on average:
so many whole times for certain, and once more with the rest as inclusion probability. The
cube method decides the rest. Its flight takes three undecided documents of a source at a
time and moves their probabilities along the null space of the two balancing constraints,
the number of documents and the number of words, until one is 0 or 1: both totals stay
exactly where they are. Blocks of a source fly apart from one another; the two documents
at most that each leaves undecided fly together in the next round, until one block of a
source is left. The landing then gives up the count of documents, keeps that of words as
far as one document allows, and rounds the last probability. Longer documents fly first,
so what is left to land is short.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.spread import join_counted
from skyledger.sources.paths import Staging

#: Documents of a block, on average.
BLOCK = 20_000
#: Documents, of all lengths, that a block keeps apart for later rounds, and that the landing decides.
LEFT, LANDING = 6, 12
#: A probability this near 0 or 1 is decided.
EXACT = 1e-9


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size, target from one row (source, source_size) for each source.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share``
    times the sum of all sizes. No target exceeds ``most`` times its source's size; what is
    over is shared out again by weight among the others. If all are at that limit the rest
    remains untaken. There is a row for each source, so the windows over them are small.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.lit([float(w) for w in weights])[F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))]
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(most))
    # Sources fill up in the order of limit / weight. One is at its limit if an even share of
    # what the fuller ones leave would not fit.
    filled = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    from_here = filled.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * float(share)
    left = total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(from_here)
    rows = rows.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("limit"))
    first_open = F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), F.col("level")))).over(Window.partitionBy())
    shared = F.coalesce(F.col("weight") * first_open["level"], F.col("limit"))
    return rows.select("source", "source_size", F.least("limit", shared).alias("target"))


def flight(sizes: np.ndarray, chances: np.ndarray, draws: np.ndarray, apart: int) -> np.ndarray:
    """Moves probabilities to 0 or 1, in the given order, and keeps the sums of chances and of chance * size.

    At most two documents are left undecided, and ``apart`` more that take no part.
    ``draws``: a number in [0, 1) for each document, used when a document joins.
    """
    size, p, u = sizes.tolist(), chances.astype(np.float64).tolist(), draws.tolist()
    live = np.flatnonzero((chances > 0) & (chances < 1))
    set_apart = set(live[np.unique(np.linspace(0, len(live) - 1, apart).round().astype(int))].tolist()) if len(live) and apart else set()
    held: list[int] = []

    def move(direction: list[float], draw: float) -> None:
        ahead = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(held, direction, strict=True) if d)
        back = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(held, direction, strict=True) if d)
        step = ahead if draw * (ahead + back) < back else -back
        for i, d in zip(held, direction, strict=True):
            p[i] = min(1.0, max(0.0, p[i] + step * d))
            if p[i] < EXACT or p[i] > 1 - EXACT:
                p[i] = float(round(p[i]))
        held[:] = [i for i in held if 0 < p[i] < 1]

    for i in live.tolist():
        if i in set_apart:
            continue
        held.append(i)
        while len(held) == 3:
            a, b, c = (size[j] for j in held)
            move([c - b, a - c, b - a] if not a == b == c else [1, -1, 0], u[i])
    if len(held) == 2 and size[held[0]] == size[held[1]]:
        move([1, -1], u[held[1]])  # both constraints hold along this line
    return np.array(p)


def landing(sizes: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Decides the few undecided documents: of all choices the nearest to the expected words, then number."""
    out = chances.copy()
    left = np.flatnonzero((chances > 0) & (chances < 1))
    choices = np.arange(1 << len(left))[:, None] >> np.arange(len(left)) & 1
    words = np.abs(choices @ sizes[left] - chances[left] @ sizes[left])
    number = np.abs(choices.sum(axis=1) - chances[left].sum())
    out[left] = choices[np.lexsort((number.round(6), words.round(6)))[0]]
    return out


def _flown(table: pa.Table, land: bool = False) -> pa.Table:
    sizes, draws = table.column("size").to_numpy(), table.column("draw").to_numpy()
    ids = table.column("doc_id").fill_null(-(1 << 63)).to_numpy()
    order = np.lexsort((ids, draws, -sizes))
    chances = np.empty(len(sizes))
    flown = flight(sizes[order], table.column("chance").to_numpy()[order], draws[order], LANDING if land else LEFT)
    chances[order] = landing(sizes[order], flown) if land else flown
    at = table.schema.get_field_index("chance")
    return table.set_column(at, "chance", pa.array(chances))


def _fly(table: pa.Table) -> pa.Table:
    return _flown(table)


def _fly_and_land(table: pa.Table) -> pa.Table:
    return _flown(table, land=True)


def mix(
    df: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, block: int = BLOCK, seed: int = 2,
    row: str | None = None,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, copies: how often each row of ``df`` is taken.

    ``row``: a stored column with a number of its own for each row, which the result then has too.

    ``df`` has doc_id, source and size, a count of words (null: 0); other columns are
    ignored. Each row is a document, also if it repeats another: equal rows are alike, so
    which of them is taken more often does not matter. Rows of a null source are a source.
    A source without words is not taken. The same input gives the same result. Rows alike that
    are more than a small share of a block are dealt to all blocks of their source.
    """
    stage = Staging(df.sparkSession)
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    size = F.coalesce(F.col("size").cast("long"), F.lit(0)).alias("size")
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size, number.cast("long").alias("row"))
    rows = stage(rows.withColumn("alike", F.xxhash64("doc_id", "source", "size", F.lit(seed))), "sizes")
    many = stage(rows.groupBy("alike").agg(F.count("*").alias("copies")).where(F.col("copies") > block // 100), "alike")
    # Only where rows are alike in numbers does a draw depend on the row.
    told_apart = F.when(F.col("copies").isNull(), F.col("alike")).otherwise(F.xxhash64("alike", "row"))
    rows = rows.withColumn("draw", F.col("alike")) if many.isEmpty() else join_counted(rows, many, "alike", "copies", "left").withColumn("draw", told_apart)
    rows = rows.withColumn("draw", F.pmod("draw", F.lit(1 << 52)) / float(1 << 52))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    sources = stage(sources, "sources")
    goals = targets(sources.select("source", "source_size"), weights, share, most)
    goals = goals.join(sources.select(F.col("source").alias("name"), "documents"), F.col("source").eqNullSafe(F.col("name")))
    goals = stage(goals.drop("name").withColumnRenamed("source", "name"), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rest = ratio - F.floor(ratio)
    decided = (rest < EXACT) | (rest > 1 - EXACT)
    flying = rows.join(goals, F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "source", "size", "row", "draw", "source_size", "target", "documents",
        F.when(decided, F.round(ratio)).otherwise(F.floor(ratio)).cast("long").alias("sure"),
        F.when(decided, 0.0).otherwise(rest).alias("chance"),
        F.ceil(F.col("documents") / block).cast("long").alias("blocks"),
    )
    done, turn = [], 0
    undecided = (F.col("chance") > 0) & (F.col("chance") < 1)
    while True:
        turn += 1
        dealt = flying.withColumn("block", F.pmod(F.xxhash64("draw", F.lit(turn)), F.col("blocks")))
        several = dealt.where("blocks > 1").groupBy("source", "block").applyInArrow(_fly, dealt.schema)
        last = dealt.where("blocks <= 1").groupBy("source", "block").applyInArrow(_fly_and_land, dealt.schema)
        flown = stage(several.unionByName(last), f"round-{turn}")
        done.append(flown.where(~undecided))
        flying = flown.where(undecided).drop("block")
        if flying.isEmpty():
            break
        flying = flying.withColumn("blocks", F.ceil((2 + LEFT) * F.col("blocks") / block).cast("long"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more.select(*out.columns))
    copies = (F.col("sure") + F.col("chance")).cast("long")
    more = [] if row is None else [F.col("row").alias(row)]
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), "source", copies.alias("copies"), *more)
