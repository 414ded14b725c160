import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyledger.functions import numeric as n
from skyledger.functions import predicates as P
from skyledger.functions import temporal as t


def one(spark, *columns, row, schema):
    return spark.createDataFrame([row], schema).select(*columns).first()


def test_codes(spark):
    ts = F.col("ts")
    got = one(
        spark, t.day_id(ts), t.month_id(ts), t.hour_code(ts), t.slot_hour(ts),
        row=(dt.datetime(2024, 1, 5, 6, 7, 8, 900),), schema="ts timestamp_ntz",
    )
    assert tuple(got) == ("2024-1-5", "202401", "06:07:08", 6)
    got = one(spark, t.day_id(ts), t.month_id(ts), t.hour_code(ts), row=(None,), schema="ts timestamp_ntz")
    assert tuple(got) == (None, None, "[invalid date]")
    got = one(spark, t.month_id(ts), row=(dt.datetime(2024, 11, 5),), schema="ts timestamp_ntz")
    assert got[0] == "202411"


def test_dates_without_time_have_a_code(spark):
    assert one(spark, t.hour_code(F.col("d")), row=(dt.date(2024, 1, 5),), schema="d date")[0] == "00:00:00"


def test_dimension_rows(spark):
    day = F.col("d")
    got = one(spark, *t.day_columns(day), *t.month_columns(day), row=(dt.date(2024, 3, 9),), schema="d date")
    assert tuple(got) == ("2024-3-9", 9, "202403", "202403", 3, 2024)


def test_wall_clock_ignores_daylight_saving(spark):
    # 02:30 does not exist in the session zone that day.
    ts = F.col("a")
    row = (dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 0, 30))
    got = one(
        spark, t.slot_hour(ts), t.hour_code(ts), t.seconds_between(F.col("b"), ts),
        row=row, schema="a timestamp_ntz, b timestamp_ntz",
    )
    assert tuple(got) == (2, "02:30:00", Decimal("7200.000000"))


def test_seconds_between(spark):
    a, b = F.col("a"), F.col("b")
    schema = "a timestamp_ntz, b timestamp_ntz"
    start = dt.datetime(2024, 1, 1, 12)
    for end in (start + dt.timedelta(microseconds=1), start - dt.timedelta(days=400, hours=1), start):
        expected = Decimal(str((end - start).total_seconds()))
        assert one(spark, t.seconds_between(a, b), row=(start, end), schema=schema)[0] == expected
    assert one(spark, t.seconds_between(a, b), row=(start, None), schema=schema)[0] is None


@pytest.mark.parametrize("flag,dep,arr,expected", [
    (True, 1, 1, True), (False, 1, 1, False), (None, 1, 1, False), (False, None, 1, True), (None, 1, None, True),
])
def test_effective_cancellation(spark, flag, dep, arr, expected):
    when = dt.datetime(2024, 1, 1)
    row = (flag, dep and when, arr and when)
    column = P.effectively_cancelled(F.col("c"), F.col("d"), F.col("a"))
    assert one(spark, column, row=row, schema="c boolean, d timestamp_ntz, a timestamp_ntz")[0] is expected


def test_delay_is_strict(spark):
    start = dt.datetime(2024, 1, 1, 12)
    delay = P.delay_seconds(F.col("a"), F.col("b"))
    for late, delayed in ((900, False), (900.000001, True), (-5000, False)):
        row = (start, start + dt.timedelta(seconds=late))
        got = one(spark, P.is_delayed(delay), P.counted_delay(delay), row=row, schema="a timestamp_ntz, b timestamp_ntz")
        assert got[0] is delayed
        assert got[1] == (Decimal(str(late)) if delayed else 0)


def test_report_keys_and_classes(spark):
    c = F.col("c")
    got = [tuple(r) for r in spark.createDataFrame([(7, "MAREP"), (None, "PIREP"), (8, "OTHER"), (9, None)], "k bigint, c string")
           .select(P.reporter_key(F.col("k")), P.is_marep(c), P.is_pirep(c)).collect()]
    assert got == [("7", True, False), ("None", False, True), ("8", False, False), ("9", False, False)]


def test_round_double_equals_duckdb(spark):
    rng = random.Random(3)
    values = [1.005, 0.285, 1.015, 0.125, 0.135, -1.005, -0.125, 0.0, 2.5e15, 0.49999999999999994]
    values += [rng.uniform(-1000, 1000) for _ in range(20_000)] + [rng.randrange(-10**6, 10**6) / 1000 for _ in range(20_000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = {r[0]: tuple(r)[1:] for r in df.select("i", *[F.expr(n.round_double("x", d)).alias(f"r{d}") for d in (2, 3, 4)]).collect()}
    con = duckdb.connect()
    con.register("w", pd.DataFrame({"i": range(len(values)), "x": values}))
    for i, *expected in con.execute("SELECT i, round(x, 2), round(x, 3), round(x, 4) FROM w").fetchall():
        assert got[i] == tuple(expected), values[i]


def test_rounded_units_are_exact(spark):
    rng = random.Random(4)
    cases = [(1, 8), (-1, 8), (1005, 1000), (-1005, 1000), (5, -2), (0, 5), (10**24 + 1, 7), (1, 0), (0, 0)]
    cases += [(rng.randrange(-10**12, 10**12), rng.randrange(-10**4, 10**4)) for _ in range(500)]
    df = spark.createDataFrame([(str(a), str(b)) for a, b in cases], "a string, b string")
    for (num, den), row in zip(cases, df.select(F.expr(n.rounded_units("a", "b", 2))).collect()):
        if den == 0:
            assert row[0] is None
            continue
        exact = Fraction(num, den) * 100
        whole = int(abs(exact) + Fraction(1, 2))
        assert row[0] == (whole if exact >= 0 else -whole), (num, den)


def test_units_round_half_away_from_zero(spark):
    seconds = [18, 54, -18, 17.999999, 18.000001, 3618, 7]
    df = spark.createDataFrame([(Decimal(str(s)).quantize(Decimal("0.000001")),) for s in seconds], "s decimal(28,6)")
    for s, row in zip(seconds, df.select(n.as_units(F.col("s"), 3600)).collect()):
        exact = Decimal(str(s)) / 3600
        assert row[0] == exact.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def test_summed_parts_of_durations(spark):
    rng = random.Random(6)
    start = dt.datetime(2024, 3, 9, 22)
    spans = [rng.randrange(-10**13, 10**13) for _ in range(300)] + [0, 1, -1, 999_999, -1_000_000, -59_999_999]
    df = spark.createDataFrame([(start, start + dt.timedelta(microseconds=us)) for us in spans], "a timestamp_ntz, b timestamp_ntz")
    parts = t.duration_parts("x", "b - a")
    each = df.select(*[F.expr(sql).alias(name) for name, sql in parts.items()])
    assert [r.x_sec * 10**6 + r.x_us for r in each.collect()] == spans
    total = each.agg(*[F.sum(name).alias(name) for name in parts])
    got = total.select(t.seconds_of("x").alias("s"), F.expr(n.micros("x")).alias("us")).first()
    assert got.us == sum(spans) and got.s == Decimal(sum(spans)).scaleb(-6)


def test_sums_of_durations_do_not_overflow(spark):
    df = spark.range(8).selectExpr("cast(9e17 as bigint) as x_sec", "cast(9e17 as bigint) as x_us")
    total = df.agg(F.sum("x_sec").alias("x_sec"), F.sum("x_us").alias("x_us"))
    assert total.select(F.expr(n.micros("x"))).first()[0] == 8 * (9 * 10**17 * 10**6 + 9 * 10**17)
