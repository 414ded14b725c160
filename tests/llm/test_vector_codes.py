"""Vector codes against a brute-force version in Python's integers, and against SQL."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import difference
from skyledger.llm import hadamard, queries, topk

ROWS = "vec_id long, embedding array<float>, label int, code string, entry int, sums int, error int"


def brute(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error, sha256) of rows of (vec_id, integers, label)."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = max(1, -(-max((len(v) for _, v, _ in rows), default=0) // parts))
    wide = [list(v) + [0] * (size * parts - len(v)) for _, v, _ in rows]
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for v in wide]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def choose(c):
        distances = [[sum((x - y) ** 2 for x, y in zip(c[p], e, strict=True)) for e in books[p]] for p in range(parts)]
        return [(d.index(min(d)), min(d)) for d in distances]

    for _ in range(rounds):
        chosen = [choose(c) for c in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, x in zip(cut, chosen, strict=True) if x[p][0] == e]
                if mine:
                    books[p][e] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    found = [choose(c) for c in cut]
    errors, of_label = [sum(d for _, d in x) for x in found], {}
    for (_, _, label), error in zip(rows, errors, strict=True):
        of_label[label] = of_label.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    codes = ["".join(f"{i:02x}" for i, _ in x) for x in found]
    return [(r[0], c, e, of_label[r[2]], sha) for r, c, e in zip(rows, codes, errors, strict=True)]


def usable(rows):
    sound = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    return [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label, *_ in rows if sound(v)]


def compressed(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], ROWS).where(topk.usable(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    return hadamard.compress(df, whole, **options).collect()


def same(found, expected):
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_query_equals_sql(spark, small):
    name = "op13_vector_codes"
    found, rows, _ = difference(spark, small, queries.queries()[name], queries.oracle_sql()[name])
    assert found is None and rows == 500


def test_query_equals_brute_force(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    same(queries.op13_vector_codes(spark, small).collect(), brute(usable(rows)))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.25, 0.0], 1), (1, [0.5, -0.25, 0.0], 1), (1, [0.1, 0.2], None), (2, None, 2), (3, [nan, 1.0], 2),
        (4, [inf], 2), (5, [None, 1.0], 2), (6, [], None), (None, [1.0] * 33, 7), (None, [-1.0] * 20, None), (7, [-0.001] * 16, 1),
    ]
    same(compressed(spark, rows), brute(usable(rows)))
    same(compressed(spark, rows, parts=3, entries=2, rounds=3), brute(usable(rows), 3, 2, 3))


def test_no_rows(spark):
    assert compressed(spark, []) == [] and compressed(spark, [(1, None, 1)]) == []


def test_ties_unused_entries_and_a_hot_label(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice([0.0, 0.5, 1.0]) for _ in range(32)], None if i % 2 else i) for i in range(300)]
    same(compressed(spark, rows), brute(usable(rows)))


@pytest.mark.parametrize("length", [1, 2, 3, 4, 5, 8, 13])
def test_nearest_is_exact(length):
    draw = np.random.default_rng(length)
    parts, entries = draw.integers(-9, 9, (500, length)), draw.integers(-9, 9, (30, length))
    distances = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    index, distance = hadamard.nearest(parts, entries)
    assert (index == distances.argmin(axis=1)).all() and (distance == distances.min(axis=1)).all()


def test_transform_by_sequency():
    signs = hadamard.transformed(np.eye(8, dtype=np.int64))[:, hadamard.sequency_order(8)]
    assert ((np.diff(signs, axis=0) != 0).sum(axis=0) == np.arange(8)).all()
    assert (signs.T @ signs == 8 * np.eye(8)).all()


def test_components_too_great_for_exact_distances(spark):
    with pytest.raises(Exception, match="distances would not be exact"):
        compressed(spark, [(1, [1.0] * 64, 1), (2, [1e7] * 64, 1)])
