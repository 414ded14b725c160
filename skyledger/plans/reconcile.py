"""A warehouse KPI beside the same KPI from the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UTILIZATION = ["fh", "tos", "adoss", "adosu", "ados", "adis", "du", "dc", "dyr", "cnr", "tdr", "add"]
REPORTING = ["rrh", "rrc"]


def reconcile(warehouse: DataFrame, raw: DataFrame, measures: list[str], keys: list[str] | None = None) -> DataFrame:
    """Full outer join on the group, with both values, their difference and a status."""
    keys = keys or ["manufacturer", "year"]

    def side(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(
            *[F.col(k).cast("string").alias(k) for k in keys],
            *[F.col(m).alias(f"{m}_{suffix}") for m in measures],
            F.lit(True).alias(f"in_{suffix}"),
        )

    joined = side(warehouse, "dw").join(side(raw, "raw"), keys, "full_outer")
    status = (
        F.when(F.col("in_raw").isNull(), "only_dw").when(F.col("in_dw").isNull(), "only_raw").otherwise("both")
    )
    compared = [
        c
        for m in measures
        for c in (
            F.col(f"{m}_dw"),
            F.col(f"{m}_raw"),
            (F.col(f"{m}_dw") - F.col(f"{m}_raw")).alias(f"{m}_delta"),
        )
    ]
    return joined.select(*keys, status.alias("status"), *compared).orderBy(*keys)
