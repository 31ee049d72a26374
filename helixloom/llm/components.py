"""Connected components by alternating large-star and small-star steps over a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixloom.llm.shared import SharedTables


def connected_components(edges: DataFrame, store: SharedTables, keep: bool = False) -> DataFrame:
    """Columns ``node, component`` (smallest node reachable) for every node of ``edges`` (columns ``a, b``).

    Large-star hangs each node's larger neighbours on the smallest of its neighbourhood, small-star its smaller ones;
    repeated until the edges no longer change they form one star per component. Minima are partial aggregates, and both
    sides of each join are plain exchanges of stored tables, so that a node with very many edges is split by AQE.
    Self loops and repeated edges are allowed; rows with a null end are ignored.
    """
    now = store.write(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select("v", "u"))
        low = store.write(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "low")
        hung = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store.write(hung.distinct(), "large")
        store.drop(low)
        low = store.write(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = store.write(hung.union(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        store.drop(now, large, low)
        now = small
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return store.write(now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots), "components")
