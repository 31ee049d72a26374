"""Ranks in a whole table without one task that holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PER_BOUND = 20


def _bucket(value: Column, bounds: list, first: int = 0) -> Column:
    """Number of bounds at most ``value``, by halving: as many comparisons as the bounds have bits."""
    if not bounds:
        return F.lit(first)
    at = len(bounds) // 2
    return F.when(value < F.lit(bounds[at]), _bucket(value, bounds[:at], first)).otherwise(_bucket(value, bounds[at + 1 :], first + at + 1))


def with_rank(df: DataFrame, order: str, name: str, buckets: int = 128) -> DataFrame:
    """Adds ``name``, the place from 0 of each row in the order of the column ``order``, whose values are distinct, not null.

    Values are cut into ``buckets`` by bounds from a sample that hashes choose, so the same rows get the same bucket however
    the input is split or computed again. The driver gets the sample (about PER_BOUND rows a bucket) and one count a bucket.
    """
    n = df.count()
    step = max(1, n // (buckets * PER_BOUND))
    sample = [r[0] for r in df.where(F.pmod(F.xxhash64(F.col(order)), F.lit(step)) == 0).select(order).orderBy(order).collect()]
    marked = df.withColumn("_b", _bucket(F.col(order), sample[PER_BOUND :: PER_BOUND][: buckets - 1]))
    sizes = dict(marked.groupBy("_b").count().collect())
    before, total = [], 0
    for b in range(buckets):
        before.append(total)
        total += sizes.get(b, 0)
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(order))
    return marked.withColumn(name, F.get(F.array(*[F.lit(x).cast("bigint") for x in before]), F.col("_b")) + inside - 1).drop("_b")
