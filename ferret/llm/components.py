"""Connected components as Spark joins.

Every node starts with its smallest neighbour. A round takes the smallest
label among neighbours, hooks a label to the smallest one that any of its
holders saw, and jumps labels one level; chains halve, so rounds grow with the
logarithm of the longest one. Rounds are written to the shared folder. Minima
are partial aggregates and joins are left to Spark's skew handling, so a hub
of many links is no hot task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of all nodes in the edges
    ``a, b`` (long, not null); nodes without an edge have no row."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    e = stored(both.filter("a <> b").distinct(), "cc-edges")
    label = e.groupBy("a").agg(F.least("a", F.min("b")).alias("l")).select(F.col("a").alias("v"), "l")
    while True:
        label = stored(label, "cc-labels")
        seen = e.join(label, F.col("b") == F.col("v")).groupBy("a").agg(F.min("l").alias("m"))
        x = label.join(seen, F.col("v") == F.col("a")).select("v", "l", "m")
        hook = x.groupBy("l").agg(F.min("m").alias("h"))
        x = stored(x.join(hook, "l").select("v", F.col("l").alias("was"), F.least("l", "m", "h").alias("l")), "cc-hooked")
        up = x.select(F.col("v").alias("u"), F.col("l").alias("lu"))
        y = stored(x.join(up, F.col("l") == F.col("u")).select("v", "was", F.col("lu").alias("l")), "cc-jumped")
        if not y.filter("l <> was").head(1):
            return y.select(F.col("v").alias("node"), F.col("l").alias("component"))
        label = y.select("v", "l")
