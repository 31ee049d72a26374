"""Splitting groups of any size into pairs of bounded blocks, so that members meet without one task holding a group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_tiles(df: DataFrame, member: Column, size: Column, block: int) -> DataFrame:
    """Adds ``blk``, ``ti <= tj``: a member of block b of its group's n = ceil(size/block) blocks goes to n block pairs."""
    n = F.ceil(size / F.lit(block)).cast("int")
    df = df.withColumn("blk", F.pmod(F.xxhash64(member), n).cast("int"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    return df.withColumn("ti", F.least("blk", "other")).withColumn("tj", F.greatest("blk", "other")).drop("other")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal integer ``keys``, from batches of a partition that is sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        bounds = [0, *cut.tolist(), batch.num_rows]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            key = tuple(int(c[lo]) for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def map_tiles(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Applies ``fn`` to the rows of each tile; many small tiles share a task."""

    def apply(batches):
        for table in runs(batches, keys):
            out = fn(table)
            if out is not None and out.num_rows:
                yield out

    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInArrow(apply, schema)
