"""Queries and candidates are rows, whatever their ids."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from skyledger.llm import queries, topk


def brute(rows, divisor, k):
    out = []
    for i, (q_id, q) in enumerate(rows):
        if q_id is None or q_id % divisor:
            continue
        scores = [(-sum(x * y for x, y in zip(q, c)), c_id) for j, (c_id, c) in enumerate(rows) if j != i and c_id is not None]
        out += [(q_id, rank, c_id, -s) for rank, (s, c_id) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def searched(spark, rows, divisor=3, k=5):
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    return sorted(map(tuple, topk.search(df, F.col("vec_id") % divisor == 0, k).collect()))


def test_repeated_ids_with_different_vectors(spark):
    rows = [(0, [1, 0]), (0, [0, 1]), (1, [5, 0]), (2, [0, 7])]
    found = searched(spark, rows, 50)
    assert found == brute(rows, 50, 5) and found.count((0, 1, 1, 5)) == 1 and found.count((0, 1, 2, 7)) == 1


@pytest.mark.parametrize("candidates,asked", [(1 << 18, 1 << 20), (60, 40)])
def test_sparse_vectors_in_blocks(spark, monkeypatch, candidates, asked):
    monkeypatch.setattr(topk, "CANDIDATES", candidates)
    monkeypatch.setattr(topk, "QUERIES", asked)
    draw = random.Random(3)
    rows = [(draw.choice([*range(40), None]), [draw.choice([0, 0, 0, -2, 1, 3]) for _ in range(draw.randrange(9))]) for _ in range(200)]
    assert searched(spark, rows) == brute(rows, 3, 5)


def test_query_and_sql_over_repeated_ids(spark, tmp_path):
    draw = random.Random(8)
    rows = [(i % 60, [draw.uniform(-1, 1) for _ in range(6)]) for i in range(130)] + [(50, [1.0] * 6)] * 2
    table = pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32()))})
    pq.write_table(table, tmp_path / "embeddings.parquet")
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
        expected = db.sql(queries.TOP_K).fetchall()
    found = sorted(map(tuple, queries.op7_top_k(spark, str(tmp_path)).collect()))
    assert found == sorted(expected) and len(found) == 5 * 7
