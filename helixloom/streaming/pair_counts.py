"""Candidate pair counts over a stream of alignments, and windowed event counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, time_col: str, keys: list[str], width: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts per tumbling window and key; on a stream, events later than ``late`` are dropped.

    Watermarks need times with a zone; those without are read in the session's zone and given back as they came.
    """
    kind = dict(events.dtypes)[time_col]
    rows = events.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, late) if events.isStreaming else events
    counts = rows.groupBy(F.window(time_col, width).alias("w"), *keys).agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").cast(kind).alias("window_start"), *keys, "n")


def streaming_pair_support(alignments: DataFrame) -> DataFrame:
    """g_lo, g_hi, frag for mates that arrive in one micro-batch or stored table; counts follow by ``merge_counts``."""
    a, b = (alignments.where(F.col("mate") == m).select("frag", F.col("gene").alias(f"g{m}"), F.col("strand").alias(f"s{m}")) for m in (1, 2))
    both = a.join(b, "frag").where("g1 <> g2 and s1 <> s2")
    return both.select(F.least("g1", "g2").alias("g_lo"), F.greatest("g1", "g2").alias("g_hi"), "frag").distinct()


def merge_counts(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Adds the support of a batch to the counts so far."""
    counts = new.groupBy("g_lo", "g_hi").agg(F.countDistinct("frag").alias("n"))
    return counts if old is None else old.unionByName(counts).groupBy("g_lo", "g_hi").agg(F.sum("n").alias("n"))
