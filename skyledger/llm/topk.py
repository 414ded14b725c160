"""Exact top-k search by inner product, term at a time.

Candidate rows are packed in blocks as an inverted index: for each term (component) the
rows that have it and their weights. A block of sparse queries meets each block of
candidates once. Query by query and term by term the weighted postings are scattered into
dense arrays of scores; the k best of a block are selected by partition, and the blocks'
best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.sources.paths import Staging

#: Components of a block of candidates and of a block of queries, on average. Each block of candidates is sent to each
#: block of queries, so the latter are larger.
CANDIDATES, QUERIES = 1 << 18, 1 << 20
#: Queries scored at once.
TOGETHER = 16
#: Tasks that the pairs of blocks are dealt to, at most, beyond the shuffle partitions.
MOST_PARTS = 10_000

BLOCK = "block int, ids binary, rows binary, terms binary, offsets binary, weights binary"


def _packed(rows: DataFrame, blocks: int) -> DataFrame:
    """One row for each block: ids ascending, numbers of rows, and a vector's terms and weights where they are not zero."""

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        vectors = table.column("vector").combine_chunks()
        order = np.argsort(ids, kind="stable")
        vectors = vectors.take(pa.array(order))
        ends = vectors.offsets.to_numpy().astype(np.int64)
        values = vectors.values.to_numpy()[ends[0] : ends[-1]]
        sizes = np.diff(ends)
        terms = np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], sizes)
        there = values != 0
        offsets = np.concatenate([[0], np.cumsum(there)])[ends - ends[0]]
        return pa.table(
            {
                "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
                "ids": [ids[order].astype("<i8").tobytes()],
                "rows": [table.column("row").to_numpy()[order].astype("<i8").tobytes()],
                "terms": [terms[there].astype("<i4").tobytes()],
                "offsets": [offsets.astype("<i8").tobytes()],
                "weights": [values[there].astype("<i8").tobytes()],
            }
        )

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(pack, BLOCK)


def _arrays(row: dict, prefix: str) -> tuple[np.ndarray, ...]:
    kinds = (("ids", "<i8"), ("rows", "<i8"), ("terms", "<i4"), ("offsets", "<i8"), ("weights", "<i8"))
    return tuple(np.frombuffer(row[f"{prefix}{name}"], dtype=kind) for name, kind in kinds)


def postings(terms: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each term the rows that have it, and their weights."""
    if not len(terms):
        return {}
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.argsort(terms, kind="stable")
    found, starts = np.unique(terms[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    return {int(t): (rows[order[a:b]], weights[order[a:b]]) for t, a, b in zip(found, starts, ends, strict=True)}


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k greatest scores, ties to the smaller id; ``ids`` ascend and the row ``own`` takes no part."""
    allowed = np.flatnonzero(rows != own)
    if len(allowed) > k:
        held = scores[allowed]
        least = held[np.argpartition(held, len(held) - k)[len(held) - k]]
        above = allowed[held > least]
        allowed = np.concatenate([above, allowed[held == least][: k - len(above)]])
    return allowed[np.lexsort((ids[allowed], -scores[allowed]))]


def narrowest(queries: np.ndarray, candidates: np.ndarray, terms: int) -> np.dtype:
    """Integers that hold every sum of so many products."""
    greatest = [max(int(x.max()), -int(x.min())) if len(x) else 0 for x in (queries, candidates)]
    return np.dtype(np.int32 if greatest[0] * greatest[1] * terms < 1 << 31 else np.int64)


def _dense(found: tuple[np.ndarray, np.ndarray], count: int) -> np.ndarray | None:
    """The weights of all rows where at least half of them have the term."""
    rows, weights = found
    if 2 * len(rows) < count:
        return None
    out = np.zeros(count, dtype=weights.dtype)
    out[rows] = weights
    return out


def inverted(count: int, *vectors: np.ndarray) -> dict[int, tuple[np.ndarray | slice, np.ndarray]]:
    """Postings of ``count`` rows; those of a term that at least half of the rows have are as long as the rows."""
    found = {}
    for term, posting in postings(*vectors).items():
        whole = _dense(posting, count)
        found[term] = posting if whole is None else (slice(None), whole)
    return found


def scatter(candidates: dict, count: int, queries: dict, asked: int, number: np.dtype) -> np.ndarray:
    """Scores of some queries (rows) with ``count`` candidates, a term after the other: its postings, weighted by each
    query that has the term, are added where they belong."""
    scores = np.zeros((asked, count), dtype=number)
    product = np.empty_like(scores)
    for term, (places, by) in queries.items():
        if (found := candidates.get(term)) is None:
            continue
        rows, held = found
        if isinstance(places, slice) and isinstance(rows, slice):
            np.multiply(by[:, None], held, out=product)
            scores += product
        elif isinstance(rows, slice):
            scores[places] += by[:, None] * held
        elif isinstance(places, slice):
            scores[:, rows] += by[:, None] * held
        else:
            scores[np.ix_(places, rows)] += by[:, None] * held
    return scores


def _scored(pairs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, rows, terms, offsets, weights = _arrays(row, "")
                q_ids, q_rows, q_terms, q_offsets, q_weights = _arrays(row, "q_")
                number = narrowest(q_weights, weights, max(np.diff(offsets).max(initial=0), 1))
                index, q_weights = inverted(len(ids), terms, offsets, weights.astype(number)), q_weights.astype(number)
                for at in range(0, len(q_ids), TOGETHER):
                    some = slice(at, at + TOGETHER)
                    offsets = q_offsets[at : at + TOGETHER + 1]
                    own, asked = slice(offsets[0], offsets[-1]), len(offsets) - 1
                    group = inverted(asked, q_terms[own], offsets - offsets[0], q_weights[own])
                    scores = scatter(index, len(ids), group, asked, number)
                    kept = [best(s, ids, rows, int(q), k) for s, q in zip(scores, q_rows[some], strict=True)]
                    sizes = [len(x) for x in kept]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(q_rows[some], sizes)),
                            pa.array(np.repeat(q_ids[some], sizes)),
                            pa.array(np.concatenate([ids[x] for x in kept])),
                            pa.array(np.concatenate([s[x] for s, x in zip(scores, kept, strict=True)]).astype(np.int64)),
                        ],
                        names=["query_row", "query_id", "vec_id", "score"],
                    )

    return pairs.mapInArrow(run, "query_row long, query_id long, vec_id long, score long")


def usable(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~broken


def search(rows: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each row that ``queries`` picks.

    ``rows`` has vec_id and vector, an array of integers (a shorter one: zeros follow); a
    null vector or id takes no part. A query's candidates are all rows but itself, so rows
    that repeat an id are queries and candidates each, also of one another. Scores are 64-bit
    sums; ties go to the smaller vec_id. Without queries the result is empty. Queries and candidates
    meet in blocks of bounded size: each block of either is sent to each block of the other.
    """
    stage = Staging(rows.sparkSession)
    rows = rows.where("vec_id is not null and vector is not null")
    columns = [F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<bigint>").alias("vector")]
    rows = stage(rows.select(F.monotonically_increasing_id().alias("row"), *columns), "rows")
    length = F.size("vector")
    sizes = rows.agg(F.sum(length).alias("n"), F.sum(F.when(queries, length)).alias("q")).first()
    blocks, q_blocks = max(1, -(-(sizes["n"] or 0) // CANDIDATES)), max(1, -(-(sizes["q"] or 0) // QUERIES))
    candidates = stage(_packed(rows, blocks), "candidates").withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    asked = stage(_packed(rows.where(queries), q_blocks), "queries")
    asked = asked.select(F.col("block").alias("q_block"), *[F.col(c).alias(f"q_{c}") for c in asked.columns[1:]])
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # Each pair of blocks is work of its own; neither side has a bound, so none is broadcast.
    keys = ["block", "q_block"]
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(blocks * q_blocks, MOST_PARTS))
    pairs = candidates.repartition(parts, *keys).join(asked.repartition(parts, *keys).hint("merge"), keys)
    scored = _scored(pairs, k)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
