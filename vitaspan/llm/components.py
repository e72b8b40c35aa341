"""Connected components of an edge table: minimum labels with pointer jumping, on DataFrames alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaspan.session import freeze


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)`` (undirected, long); component is the smallest node reachable.

    Every round takes the smallest label among neighbours (combined on the map side), hangs roots under it, and
    halves paths by jumping to the label's label. Labels are written to the shared folder each round, so a lost
    executor repeats one round at most. Hubs are split by the skew handling of sort-merge joins. NULL ends and loops
    are ignored; an empty table gives an empty result.
    """
    clean = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    both = freeze(clean.union(clean.select("b", "a")).distinct())
    labels = freeze(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("component")))
    while True:
        own = both.join(labels, both["a"] == labels["node"]).select(F.col("b").alias("node"), F.col("component").alias("seen"))
        best = own.groupBy("node").agg(F.min("seen").alias("seen"))
        met = labels.join(best, "node").select("node", "component", F.least("component", "seen").alias("low"))
        met = freeze(met)
        # a root takes the smallest label that any of its members has met
        roots = met.groupBy(F.col("component").alias("root")).agg(F.min("low").alias("root_low"))
        hung = met.join(roots, met["component"] == roots["root"], "left").select(
            "node", F.least("low", F.coalesce("root_low", "low")).alias("up"), F.col("component").alias("old"))
        hung = freeze(hung)
        top = hung.select(F.col("node").alias("up"), F.col("up").alias("upper"))
        labels = freeze(hung.join(top, "up", "left").select("node", F.coalesce("upper", "up").alias("component"), "old"))
        if labels.where("component <> old").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
