"""Connected components of a graph given as pairs of ids, by joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.sources.paths import Staging


def components(edges: DataFrame, stage: Staging, name: str = "components") -> DataFrame:
    """(id, component): the smallest id reachable from each id that has an edge in ``edges`` (a, b).

    Each round takes the least component among the neighbours' and then the component's own
    component, and is written to the shared folder. A hub's edges are reduced before they
    are shuffled by it.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.where("a <> b").distinct(), f"{name}-edges")
    labels = stage(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b")).select("id", F.least("id", "b").alias("component")),
        f"{name}-0",
    )
    number = 0
    while True:
        number += 1
        near = (
            both.join(labels, both.b == labels.id)
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        hop = labels.join(near, "id").select("id", F.col("component").alias("was"), F.least("component", "near").alias("to"))
        far = labels.select(F.col("id").alias("to"), F.col("component").alias("far"))
        hop = hop.join(far, "to").select("id", "was", F.least("to", "far").alias("component"))
        hop = stage(hop, f"{name}-{number}")
        changed = hop.where("component <> was").limit(1).count()
        stage.remove(f"{name}-{number - 1}")
        labels = hop.select("id", "component")
        if not changed:
            stage.remove(f"{name}-edges")
            return labels
