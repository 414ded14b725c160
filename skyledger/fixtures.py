"""Source relations derived from order tables, for checks and benchmarks.

The three database relations are not available, so flights and maintenance
come from orders, reports from line items, aircraft from customers and
personnel from suppliers. Every order, line item and customer is used, and the
work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _div(x, n: int):
    return F.call_function("div", x, F.lit(n))


def _registration(number):
    return F.concat(F.lit("XY-"), number.cast("string"))


def _operations(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    # A quarter of the rows lie anywhere in the year, the others on four days, where they meet.
    spread = k % 4 == 0
    planned = F.make_timestamp_ntz(
        F.year("o_orderdate"),
        F.when(spread, 1 + _div(k, 4) % 12).otherwise(1 + 10 * (k % 2)).cast("int"),
        F.when(spread, 1 + _div(k, 48) % 28).otherwise(9 + _div(k, 2) % 2).cast("int"),
        ((k * 7) % 22).cast("int"),
        ((k * 13) % 60).cast("int"),
        F.lit(0),
    )
    return orders.select(
        _registration(_div(F.col("o_custkey"), 5)).alias("aircraftregistration"),
        planned.alias("scheduleddeparture"),
        F.make_dt_interval(hours=(1 + k % 5).cast("int")).alias("duration"),
        F.make_dt_interval(mins=((k * 11) % 45 - 10).cast("int")).alias("late"),
        "o_orderstatus",
        k.alias("row_key"),
    )


def flights(orders: DataFrame) -> DataFrame:
    k = F.col("row_key")
    start = F.col("scheduleddeparture") + F.col("late")
    end = start + F.col("duration")
    swap = k % 37 == 0
    return (
        _operations(orders)
        .where("o_orderstatus <> 'P'")
        .select(
            "aircraftregistration",
            "scheduleddeparture",
            (F.col("scheduleddeparture") + F.col("duration")).alias("scheduledarrival"),
            F.when(swap, end).otherwise(start).alias("actualdeparture"),
            F.when(k % 31 != 0, F.when(swap, start).otherwise(end)).alias("actualarrival"),
            F.when(k % 23 != 0, k % 29 == 0).alias("cancelled"),
            "row_key",
        )
    )


def maintenance(orders: DataFrame) -> DataFrame:
    k = F.col("row_key")
    return (
        _operations(orders)
        .where("o_orderstatus = 'P'")
        .select(
            "aircraftregistration",
            "scheduleddeparture",
            (F.col("scheduleddeparture") + F.col("duration")).alias("scheduledarrival"),
            F.when(k % 17 != 0, k % 3 != 0).alias("programmed"),
            "row_key",
        )
    )


def reports(lineitem: DataFrame) -> DataFrame:
    """One report for each line item; some lack the aircraft, the reporter or the class, some have a third class."""
    line, order = F.col("l_linenumber"), F.col("l_orderkey")
    report_class = (
        F.when(line == 7, "CABIN")
        .when(order % 53 == 0, None)
        .when(F.col("l_returnflag") == "N", "PIREP")
        .when(F.col("l_returnflag").isin("A", "R"), "MAREP")
    )
    return lineitem.select(
        F.when(F.col("l_partkey") % 97 != 0, _registration(_div(F.col("l_partkey"), 6))).alias("aircraftregistration"),
        F.col("l_shipdate").alias("reportingdate"),
        F.when(order % 41 != 0, F.col("l_suppkey")).alias("reporteurid"),
        report_class.alias("reporteurclass"),
    )


def aircrafts(customer: DataFrame) -> DataFrame:
    """One aircraft for five customers, from all of them.

    One number in seven is left out, so that some events are on unknown aircraft. Some
    lines come twice, some have a rival line for the same registration, some have no
    registration.
    """
    number = F.col("number")
    maker = F.when(number % 4 == 0, "Embraer").when(F.col("nation") % 4 == 0, "Boeing").otherwise("Airbus")
    lines = (
        customer.groupBy(_div(F.col("c_custkey"), 5).alias("number"))
        .agg(F.min("c_mktsegment").alias("model"), F.min("c_nationkey").alias("nation"))
        .where(number % 7 != 0)
        .select("number", _registration(number).alias("registration"), "model", maker.alias("manufacturer"))
    )
    line = lambda *values: F.struct(*[v.alias(n) for v, n in zip(values, ("registration", "model", "manufacturer"))])
    own = line(F.col("registration"), F.col("model"), F.col("manufacturer"))
    rival = line(F.col("registration"), F.lit("GLIDER"), F.lit("Boeing"))
    nameless = line(F.lit(None).cast("string"), F.col("model"), F.col("manufacturer"))
    variants = F.array_compact(
        F.array(own, F.when(number % 13 == 0, own), F.when(number % 11 == 0, rival), F.when(number % 50 == 0, nameless))
    )
    return lines.select(F.inline(variants))


def personnel(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Every supplier but one in ten, which makes reporters that the file does not list. Some ids have blanks around them."""
    key = F.col("s_suppkey").cast("string")
    return (
        supplier.where("s_suppkey % 10 <> 0")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit(" "), key, F.lit("  "))).otherwise(key).alias("reporteurid"),
            F.upper(F.substring("n_name", 1, 3)).alias("airport"),
        )
    )


def sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    table = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    return {
        "flights": flights(table("orders")),
        "maintenance": maintenance(table("orders")),
        "reports": reports(table("lineitem")),
        "aircrafts": aircrafts(table("customer")),
        "personnel": personnel(table("supplier"), table("nation")),
    }
