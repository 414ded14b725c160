import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators.ordering import with_position
from skyledger.sources.paths import Staging


def positions(spark, rows, keys, **options):
    df = spark.createDataFrame(rows, "a string, b int, position int")
    found = with_position(df, keys, Staging(spark), name="place", **options)
    return [tuple(r) for r in sorted(found.collect(), key=lambda r: r.place)]


@pytest.mark.parametrize("count", [0, 1, 7, 500])
def test_positions_are_those_of_a_sort(spark, count):
    draw = random.Random(count)
    rows = [(draw.choice(["x", "y", None]), draw.choice([None, *range(40)]), i) for i in range(count)]
    found = positions(spark, rows, [F.col("a").asc_nulls_last(), F.col("b").desc_nulls_first()])
    expected = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1] is not None, -(r[1] or 0), r[2]))
    assert found == [(*r, i) for i, r in enumerate(expected, 1)]


def test_equal_rows_have_positions_of_their_own(spark):
    found = positions(spark, [("x", 1, 1)] * 50 + [("w", 1, 1)], [F.col("a").asc()])
    assert [r[3] for r in found] == list(range(1, 52)) and found[0][0] == "w"


def test_a_hot_key_is_spread(spark):
    """Rows that share the key differ elsewhere, so no range holds them all."""
    df = spark.range(20_000).select(F.lit("hot").alias("a"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        seen = {}
        stage = Staging(spark)
        found = with_position(df, [F.col("a").asc()], lambda d, n: seen.setdefault(n, stage(d, n)))
        assert found.where("position <> id + 1").count() == 0
        sizes = [r["count"] for r in seen["ordered"].groupBy(F.shiftright("_at", 33)).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8


def test_no_window(spark):
    df = spark.createDataFrame([("x", 1)], "a string, b int")
    plan = with_position(df, [F.col("a").asc()], Staging(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
